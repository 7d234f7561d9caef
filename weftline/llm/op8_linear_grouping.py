"""Packing token sequences by linear grouping, with best fit for what is small.

Only lengths decide a packing, and there are at most CAPACITY of them. So the
corpus is encoded and cut in parallel, the histogram of lengths, a bounded
table, is solved on the driver, and the solution, runs of equal sequences, is
dealt out to the pieces by their number within their length:

1. large lengths, in descending order, are cut into groups of equal
   cardinality, and each is rounded up to the largest of its group;
2. configurations of these few sizes are optimised by column generation on the
   cutting-stock programme; whole multiples of the solution are kept;
3. actual pieces take the places of their group's rounded size;
4. what is over, then the small lengths, go by best fit, largest first.

Runs keep every step independent of the number of pieces. Numbers within a
length come from hashed buckets, so that a length that a third of all pieces
share is dealt to as many tasks as any other.

Defined results: a null text is empty, and an empty one is its end id alone; a
very long text is cut whole, without a bound on its pieces; which of the pieces
of one length goes where follows their rows; rows with the same key are documents
of their own; an empty table gives no
rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tokens
from .common import work_folder, written
from .op1_chunk_store import _arrow

#: Tokens of a sequence; the share of it above which a length is large; groups of large lengths; buckets of pieces of a length.
CAPACITY, LARGE, GROUPS, BUCKETS = 4096, 1 / 3, 48, 256


def _cut(path: str, end_id: int, capacity: int, key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = tokens.raw_ids(path, tokens.bare_pieces), np.array([end_id], "<u4").tobytes()
        names, kinds = ["doc", "number", "piece", "start", "length", "ids_crc32"], [key_type, pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            out = [[] for _ in names]
            for doc, number, text in zip(*[batch.column(c).to_pylist() for c in ("doc", "number", "text")]):
                raw = encode(text or "") + end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    for column, value in zip(out, (doc, number, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return run


def cut_pieces(df: DataFrame, key: str, text: str, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(doc, number, piece, start, length, ids_crc32) of every piece of every row's whole text."""
    kind = df.schema[key].dataType
    rows = df.select(F.col(key).alias("doc"), F.monotonically_increasing_id().alias("number"), F.col(text).alias("text"))
    return rows.mapInArrow(_cut(path, end_id, capacity, _arrow(kind)), f"doc {kind.simpleString()}, number long, piece int, start long, length long, ids_crc32 long")


def configurations(sizes: list[int], demand: list[float], capacity: int, rounds: int = 400) -> list[tuple[float, list[int]]]:
    """(how often, how many of each size) of a basic solution of the cutting-stock programme, by column generation."""
    k, size = len(sizes), np.array(sizes)
    basis = np.diag(capacity // size).astype(float)
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        x, dual = inverse @ np.array(demand, float), np.ones(k) @ inverse
        # The most valuable filling of a sequence, item by item.
        order = np.flatnonzero(dual > 1e-12)
        value, back = dual[order], size[order]
        # best[capacity + c]: the value of room c; what lies before stands for rooms below zero.
        best, took = np.full(2 * capacity + 1, -np.inf), np.full(capacity + 1, -1)
        best[capacity : capacity + size.min()] = 0
        for c in range(int(size.min()), capacity + 1):
            gain = best[capacity + c - back] + value
            i = int(gain.argmax())
            best[capacity + c], took[c] = (gain[i], order[i]) if gain[i] > best[capacity + c - 1] + 1e-12 else (best[capacity + c - 1], -1)
        if best[2 * capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if took[c] < 0:
                c -= 1
                continue
            column[took[c]] += 1
            c -= sizes[took[c]]
        move = inverse @ column
        ratio = [x[i] / move[i] if move[i] > 1e-9 else np.inf for i in range(k)]
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
    x = np.linalg.inv(basis) @ np.array(demand, float)
    return [(max(0.0, float(x[i])), basis[:, i].round().astype(int).tolist()) for i in range(k)]


class Bins:
    """Runs of sequences with the same contents, by what room they have: (how many, contents as [(length, how many), ...])."""

    def __init__(self, capacity: int):
        self.capacity, self.room = capacity, defaultdict(list)

    def add(self, n: int, items: list[tuple[int, int]]) -> None:
        if n > 0:
            self.room[self.capacity - sum(a * b for a, b in items)].append((n, items))

    def fit(self, length: int, n: int) -> None:
        """Best fit of n pieces of a length: the fullest sequence with room takes as many as go in, then the next."""
        for room in sorted(r for r in self.room if r >= length):
            each = room // length
            while n and self.room[room]:
                bins, items = self.room[room].pop()
                full = min(bins, n // each)
                self.add(full, [*items, (length, each)])
                n -= full * each
                if (rest := bins - full) and n:  # fewer than `each` are over
                    self.add(1, [*items, (length, n)])
                    rest, n = rest - 1, 0
                if rest:
                    self.room[room].append((rest, items))
            if not n:
                break
        if n:
            each = self.capacity // length
            self.add(n // each, [(length, each)])
            if n % each:
                self.add(1, [(length, n % each)])


def solve(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs of sequences for so many pieces of each length."""
    bins, left = Bins(capacity), {}
    big = sorted((n for n in histogram if capacity * large < n < capacity), reverse=True)
    bins.add(histogram.get(capacity, 0), [(capacity, 1)])
    total = sum(histogram[n] for n in big)
    grouped: list[list[list[int]]] = []  # of each group, runs [length, how many] in descending order
    if total:
        per = -(-total // groups)
        run: list[list[int]] = []
        space = per
        for n in big:
            rest = histogram[n]
            while rest:
                take = min(rest, space)
                run.append([n, take])
                rest, space = rest - take, space - take
                if not space:
                    grouped.append(run)
                    run, space = [], per
        if run:
            grouped.append(run)
        # Groups that round up to the same size are one size of the programme.
        merged: dict[int, list[list[int]]] = {}
        for g in grouped:
            merged.setdefault(g[0][0], []).extend(g)
        sizes = list(merged)
        demand = [sum(c for _, c in merged[s]) for s in sizes]
        for often, column in configurations(sizes, demand, capacity):
            often = int(often + 1e-6)
            if not often:
                continue
            slots = [s for s, m in zip(sizes, column) for _ in range(m)]
            often = min([often, *(sum(c for _, c in merged[s]) // slots.count(s) for s in set(slots))])
            if often <= 0:
                continue
            # Each slot takes its group's next pieces; runs end where any slot's length changes.
            runs = []
            for s in slots:
                need, own = often, []
                while need:
                    head = merged[s][0]
                    take = min(need, head[1])
                    own.append([head[0], take])
                    head[1] -= take
                    need -= take
                    if not head[1]:
                        merged[s].pop(0)
                runs.append(own)
            done = 0
            while done < often:
                step = min(r[0][1] for r in runs)
                counts: dict[int, int] = {}
                for r in runs:
                    counts[r[0][0]] = counts.get(r[0][0], 0) + 1
                    r[0][1] -= step
                    if not r[0][1]:
                        r.pop(0)
                bins.add(step, sorted(counts.items(), reverse=True))
                done += step
        for runs in merged.values():
            for n, c in runs:
                left[n] = left.get(n, 0) + c
    for n, c in histogram.items():
        if n <= capacity * large:
            left[n] = left.get(n, 0) + c
    for n in sorted(left, reverse=True):
        if left[n]:
            bins.fit(n, left[n])
    return [x for room in sorted(bins.room) for x in bins.room[room]]


def segments(runs: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first number within the length, first sequence, pieces in each sequence, offset), in order."""
    given: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for bins, items in runs:
        offset = 0
        for length, each in items:
            rows.append((length, given[length], sequence, each, offset))
            given[length] += bins * each
            offset += length * each
        sequence += bins
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _placed(plan: np.ndarray, fields: list[str]):
    def run(batches):
        key = (plan[:, 0] << 44) + plan[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = plan[np.searchsorted(key, (length << 44) + rank, "right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in fields], pa.array(sequence), pa.array(offset)], [*fields, "sequence_id", "offset"])

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Give every piece (doc, number, piece, start, length, ...) a sequence and an offset in it. ``pieces`` is read thrice, so pass a written one."""
    # At most `capacity` rows.
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = segments(solve(histogram, capacity, groups))
    bucketed = pieces.withColumn("bucket", F.pmod(F.xxhash64("number", "piece"), F.lit(BUCKETS)).cast("int"))
    counts = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    nth = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("number", "piece")) - 1
    ranked = bucketed.withColumn("nth", nth).join(bases, ["length", "bucket"]).withColumn("rank", (F.col("base") + F.col("nth")).cast("long"))
    fields = ["doc", "number", "piece", "start", "length", "ids_crc32"]
    ranked = ranked.select(*fields, "rank")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name in fields)
    return ranked.mapInArrow(_placed(plan, fields), f"{kinds}, sequence_id long, offset long")


def pack_documents(df: DataFrame, key: str, text: str, path: str, end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """(doc, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every row's whole text."""
    folder = work_folder(df.sparkSession)
    pieces = written(cut_pieces(df, key, text, path, end_id, capacity), f"{folder}/pieces")
    return pack(pieces, capacity).drop("number")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pack_documents(docs, "doc_id", "text", tokens.vocabulary("word_bpe_49k.json")).withColumnRenamed("doc", "doc_id")
