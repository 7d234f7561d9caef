"""Alignment of two tokenizers' ids of the same text, by the bytes that they cover.

Every byte of a text has a label: whether a token of A ends there, one of B,
both or none. A regular expression cuts the string of labels behind each place
where both end; what a span counts of either label is how many tokens of A and
of B stand for the same bytes, a group. Within a group each stretch between two
labelled bytes lies in one token of A and one of B: these are the links, all
pairs of tokens that overlap.

A text is encoded once. Its links, each distinct pair of ids with its number,
are written; tasks add up how many documents hold each pair, in sorted arrays
of a bounded size, before the counts are shuffled. To score the links, the most
frequent pairs (FREQUENT at most, by a bound on their counts) go to all tasks,
and all others are joined, so nothing is left out and no pair that a third of
all documents hold is shuffled.

Defined results: a null or empty text, and one whose joined bytes of A or of B
differ from a blank and the text, has no tokens, zeros and an empty digest; a
very long text is aligned whole in one task; rows with the same id, or equal
rows, are documents of their own and count each; ties of the highest count all
count as best; an empty table gives none; further columns are ignored, whatever
their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import work_folder, written

#: Pairs that go to all tasks at most; pairs that a task adds up before it sends them on.
FREQUENT, HELD = 400_000, 2_000_000
#: Bytes that found stretches may take, length from which one is not kept, bytes that an entry takes besides, and stretches looked up at once.
KEPT, LONG, ENTRY, BLOCK = 192 << 20, 256, 420, 65_536
#: Steps of the bound on counts for each doubling.
STEPS = 16

_SPAN = re.compile(rb"[.ab]*x")
#: Labels of a byte as they are in the string: none, the end of a token of A, of B, of both.
_LABELS = np.frombuffer(b".abx", np.uint8)


class _Counts(dict):
    """(tokens of A, tokens of B) of a span of labels."""

    def __missing__(self, span: bytes) -> tuple[int, int]:
        found = span.count(b"a") + 1, span.count(b"b") + 1
        if len(self) < 100_000 and len(span) <= 64:
            self[span] = found
        return found


@lru_cache(maxsize=1)
def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others in order from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteSide:
    """Ids of the tokenizers library's byte-level vocabulary; special tokens' strings are text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Plain words by the library's model alone, all else by the whole tokenizer.
        self.pieces = tokens.Pieces(path, list)
        self.pieces.tokenizer = self.tokenizer
        size, back = self.tokenizer.get_vocab_size(), _byte_level()
        self.bytes = [b""] * size
        for name, k in self.tokenizer.get_vocab().items():
            self.bytes[k] = bytes(back[c] for c in name) if all(c in back for c in name) else name.encode()

    def encode(self, stretches: list[str]) -> list[list[int]]:
        """Ids of stretches with the blank before them, if they have one."""
        return self.pieces.encoded(stretches)


class PieceSide:
    """Ids of a sentencepiece model, which puts the blank before the text itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        name, size = self.model.id_to_piece, self.model.get_piece_size()
        self.bytes = [bytes([int(name(k)[3:5], 16)]) if self.model.is_byte(k) else name(k).replace("▁", " ").encode() for k in range(size)]
        self.blank = self.model.piece_to_id("▁")
        line = self.model.encode("\n")
        # Whether no piece goes on into a blank or over a line feed, so that stretches are encoded on their own.
        self.apart = not any("▁" in name(k).lstrip("▁") or "\n" in name(k) for k in range(size)) and len(line) == 2 and line[0] == self.blank
        self.before = line

    def encode(self, stretches: list[str]) -> list[list[int]]:
        """The same; what does not begin with a blank is encoded behind a line feed, whose ids are left out."""
        found = self.model.encode([x[1:] if x[0] == " " else "\n" + x for x in stretches], num_threads=1)
        out = []
        for x, ids in zip(stretches, found):
            if x[0] == " ":
                # A blank on its own; the model gives no ids for an empty text.
                ids = [self.blank] if x == " " else ids
            elif ids[:2] != self.before:
                raise ValueError(f"the model joins {x!r} with the line feed before it")
            else:
                ids = ids[2:]
            out.append(ids)
        return out


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteSide(a_path), PieceSide(b_path)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in s.bytes], np.int64) for s in (self.a, self.b))
        self.width = len(self.b.bytes)
        # A token as it is written in a digest: its id and what follows it, within its side of a group, at its end, or at that of a stretch.
        self.names = [b"%d%s" % (k, end) for k in range(len(self.a.bytes)) for end in (b",", b"|")] + [b"%d%s" % (k, end) for k in range(self.width) for end in (b",", b";", b"\n")]
        self.counts = _Counts()
        self.store = _store(len(self.a.bytes) * self.width)
        self.young: dict = {}
        self.old: dict = {}
        self.held = 0

    def stretches(self, text: str) -> list[str]:
        """A blank and the text, cut where both sides end whatever the text is."""
        return [x for x in tokens.spaced_pieces(" " + text) if x] if self.b.apart else [" " + text]

    def _ends(self, ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each token ends, and each stretch by its number of tokens."""
        ends = np.cumsum(sizes[ids])
        return ends, np.concatenate([[0], ends])[np.cumsum(counts)]

    def align(self, stretches: list[bytes], a: list[list[int]], b: list[list[int]]) -> list | None:
        """Of each stretch (tokens of A, of B, groups, links, `a1,a2|b1;a3|b2,b3`), all worked out at once; null if the tokens do not spell the stretches."""
        whole, stops = b"".join(stretches), np.cumsum([len(x) for x in stretches])
        n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        a_ids, b_ids = (np.array([k for x in side for k in x], np.int64) for side in (a, b))
        (a_ends, a_stops), (b_ends, b_stops) = self._ends(a_ids, self.a_sizes, n_a), self._ends(b_ids, self.b_sizes, n_b)
        if (a_stops != stops).any() or (b_stops != stops).any() or any(b"".join([side.bytes[k] for k in ids.tolist()]) != whole for side, ids in ((self.a, a_ids), (self.b, b_ids))):
            return None
        labels = np.zeros(len(whole), np.uint8)
        labels[a_ends - 1] |= 1
        labels[b_ends - 1] |= 2
        groups = np.array([self.counts[span] for span in _SPAN.findall(_LABELS[labels].tobytes())], np.int64).reshape(-1, 2)
        at = np.flatnonzero(labels)
        in_a, in_b = labels[at] & 1, labels[at] >> 1
        links = (a_ids[np.cumsum(in_a, dtype=np.int64) - in_a] * self.width + b_ids[np.cumsum(in_b, dtype=np.int64) - in_b]).astype(self.store).tobytes()
        # Groups in order, the ids of A and then those of B; what follows an id is told by its name: the last of a stretch ends a line.
        of_a, of_b = groups[:, 0], groups[:, 1]
        a_after, b_after = np.cumsum(of_a), np.cumsum(of_b)
        a_end, b_end = np.zeros(len(a_ids), np.int64), np.zeros(len(b_ids), np.int64)
        a_end[a_after - 1], b_end[b_after - 1] = 1, 1
        b_end[np.cumsum(n_b) - 1] = 2
        names = np.empty(len(a_ids) + len(b_ids), np.int64)
        names[np.arange(len(a_ids)) + np.repeat(b_after - of_b, of_a)] = 2 * a_ids + a_end
        names[np.arange(len(b_ids)) + np.repeat(a_after, of_b)] = 2 * len(self.a.bytes) + 3 * b_ids + b_end
        spelt = b"".join([self.names[k] for k in names.tolist()])[:-1].split(b"\n")
        n_groups = np.diff(np.searchsorted(np.flatnonzero(labels == 3), stops), prepend=0)
        cuts = (np.searchsorted(at, stops) * np.dtype(self.store).itemsize).tolist()
        return list(zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), [links[x:y] for x, y in zip([0, *cuts], cuts)], spelt))

    def _found(self, stretches: list[str]) -> list:
        if not stretches:
            return []
        raw, a, b = [x.encode() for x in stretches], self.a.encode(stretches), self.b.encode(stretches)
        found = self.align(raw, a, b)
        # One of them is not spelt by its tokens; false stands for it.
        return found if found is not None else [(self.align([x], [i], [j]) or [False])[0] if i and j else False for x, i, j in zip(raw, a, b)]

    def of(self, stretches: list[str]) -> list:
        """(tokens of A, of B, groups, links, their spelling) of each stretch; false where tokens do not spell it."""
        if len(stretches) > BLOCK:
            return [x for lo in range(0, len(stretches), BLOCK) for x in self.of(stretches[lo : lo + BLOCK])]
        if 2 * self.held > KEPT:
            self.old, self.young, self.held = self.young, {}, 0
        values = list(map(self.young.get, stretches))
        if None not in values:
            return values
        extra, new = {}, []
        for x in {x for x, v in zip(stretches, values) if v is None}:
            if (v := self.old.get(x)) is not None:
                self.young[x] = v
                self.held += ENTRY + len(x)
            else:
                new.append(x)
        for x, v in zip(new, self._found(new)):
            if len(x) > LONG:
                extra[x] = v
            else:
                self.young[x] = v
                self.held += ENTRY + len(x) + (len(v[3]) + len(v[4]) if v else 0)
        young = self.young
        return [v if v is not None else young[x] if x in young else extra[x] for x, v in zip(stretches, values)]


def _store(size: int) -> str:
    return "<u4" if size <= 1 << 32 else "<u8"


def _aligned(a_path: str, b_path: str):
    names = ["row", "key", "n_a", "n_b", "n_groups", "n_links", "sha", "pairs", "times"]
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = tokens.shared((a_path, b_path, "align"), lambda: Aligner(a_path, b_path))

        def row(found: list):
            if not found or False in found:
                return 0, 0, 0, 0, "", b"", b""
            n_a, n_b, n_groups, links, spelt = zip(*found)
            links = np.frombuffer(b"".join(links), aligner.store).astype(np.int64)
            pairs, times = np.unique(links, return_counts=True)
            return sum(n_a), sum(n_b), sum(n_groups), len(links), hashlib.sha256(b";".join(spelt)).hexdigest(), np.diff(pairs, prepend=0).astype(aligner.store).tobytes(), times.astype("<u4").tobytes()

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                cut = [aligner.stretches(t.as_py()) if t.as_py() else [] for t in part.column("text")]
                found = aligner.of([x for own in cut for x in own])
                ends = np.cumsum([len(own) for own in cut]).tolist()
                rows = [row(found[x:y]) for x, y in zip([0, *ends], ends)]
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("key"), *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)]], names)

    return run


def _pairs(raw: bytes, store: str) -> np.ndarray:
    """Pairs in ascending order, kept as the differences between them."""
    return np.cumsum(np.frombuffer(raw, store).astype(np.int64))


def _held(store: str):
    """How many of a task's documents hold each pair, in parts of a bounded size."""

    def run(batches):
        keys, sums, new, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

        def merged():
            found, n = np.unique(np.concatenate(new), return_counts=True) if new else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            both, where = np.unique(np.concatenate([keys, found]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, where, np.concatenate([sums, n]))
            return both, total

        out = lambda k, n: (pa.RecordBatch.from_arrays([pa.array(k[a : a + 100_000]), pa.array(n[a : a + 100_000])], ["pair", "n"]) for a in range(0, len(k), 100_000))
        for batch in batches:
            for raw in batch.column("pairs").to_pylist():
                new.append(_pairs(raw, store))
                waiting += len(new[-1])
                if waiting >= HELD:
                    keys, sums = merged()
                    new, waiting = [], 0
                    if len(keys) >= HELD:
                        yield from out(keys, sums)
                        keys = sums = np.zeros(0, np.int64)
        yield from out(*merged())

    return run


def _scored(frequent, store: str, rest: bool):
    """(row, best, sum) of the links whose pairs are among the frequent ones, or (row, pair, times) of the others."""

    def run(batches):
        known, n, best = (np.frombuffer(x, t) for x, t in zip(frequent.value, ("<i8", "<i8", "?")))
        for batch in batches:
            out = []
            for row, pairs, times in zip(*[batch.column(c).to_pylist() for c in ("row", "pairs", "times")]):
                own, often = _pairs(pairs, store), np.frombuffer(times, "<u4").astype(np.int64)
                at = np.searchsorted(known, own)
                on = np.zeros(len(own), bool)
                inside = at < len(known)
                on[inside] = known[at[inside]] == own[inside]
                if rest:
                    out.append((np.full(int((~on).sum()), row), own[~on], often[~on]))
                else:
                    at = at[on]
                    out.append(([row], [int(often[on][best[at]].sum())], [int((often[on] * n[at]).sum())]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], ["row", "pair", "times"] if rest else ["row", "best", "sum"])

    return run


def align_documents(df: DataFrame, key: str, text: str, a_path: str, b_path: str, folder: str, frequent: int = FREQUENT) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row; what the corpus holds of each pair is in ``pairs`` below ``folder``."""
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"row long, key {kind}, n_a long, n_b long, n_groups long, n_links long, sha string, pairs binary, times binary"
    aligned = written(rows.mapInArrow(_aligned(a_path, b_path), schema), f"{folder}/aligned")
    b_size = PieceSide(b_path).model.get_piece_size()
    store = _store(ByteSide(a_path).tokenizer.get_vocab_size() * b_size)
    sums = written(aligned.select("pairs").mapInArrow(_held(store), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), f"{folder}/sums")
    # A row for each id of A, as many as its vocabulary has.
    highest = sums.groupBy(F.floor(F.col("pair") / b_size).alias("a")).agg(F.max("n").alias("most"))
    pairs = sums.withColumn("a", F.floor(F.col("pair") / b_size)).join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    pairs = written(pairs.withColumn("step", F.floor(F.log2("n") * STEPS).cast("int")), f"{folder}/pairs")
    # Counts by step, some hundreds of rows: from which step on the pairs are few enough to go to all tasks.
    least, held = 1 << 30, 0
    for step, n in sorted(pairs.groupBy("step").count().collect(), reverse=True):
        held += n
        if held > frequent:
            break
        least = step
    top = pairs.where(F.col("step") >= least).select("pair", "n", "best").toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast([top.column(k).to_numpy().astype(t).tobytes() for k, t in (("pair", "<i8"), ("n", "<i8"), ("best", "?"))])
    links = aligned.select("row", "pairs", "times")
    found = links.mapInArrow(_scored(shared, store, False), "row long, best long, sum long")
    other = links.mapInArrow(_scored(shared, store, True), "row long, pair long, times long").join(pairs.where(F.col("step") < least), "pair")
    other = other.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best"), F.sum(F.col("times") * F.col("n")).alias("sum"))
    total = found.unionByName(other).groupBy("row").agg(F.sum("best").alias("n_best"), F.sum("sum").alias("count_sum"))
    return aligned.select("row", "key", "n_a", "n_b", "n_groups", "n_links", "sha").join(total, "row").select("key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("sha").alias("groups_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return align_documents(docs, "doc_id", "text", tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("piece_bpe_32k.model"), work_folder(spark)).withColumnRenamed("key", "doc_id")
