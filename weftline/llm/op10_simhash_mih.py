"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint has 64 bits and links to those at no more than 3 differing bits.
Of two segments of 32 bits, at least one then differs in at most one bit. So
every distinct fingerprint is stored under both its segments and looks up, in
each, the Hamming ball of radius 1; of two segments that differ in one bit,
the one that has a zero there finds the other, so only those members of a
ball are looked up. What meets under a key is verified over all 64 bits.

Equal fingerprints are one before the search. Under a key, links are followed
by a search from fingerprint to fingerprint among those not reached yet, and
only the edges of that search's trees leave the task: never all pairs. Keys
with more than CROWD stored fingerprints, and those that these look up, are
divided once more, by halves of the other segment in the same way; what then
still shares a key has at most 2 ** 16 distinct fingerprints for each key one bit
away.

Defined results: a text without words (or null) has fingerprint zero and links
like any other; a very long text's shingles are all counted, some 65,536 at a
time; a bit set in exactly half of the hashes is 0; rows with the same key are
documents of their own; a component's id is the smallest key in it, null only if
all its keys are; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import connected_components, work_folder, written
from .op1_chunk_store import _arrow

#: Differing bits of a link, words of a shingle, seed of the hash, and stored fingerprints under a key from which it is divided.
BITS, SHINGLE, SEED, CROWD = 3, 3, 42, 4096


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the hashes of the shingles, repeats included; as a signed 64-bit integer."""
    from xxhash import xxh64_digest

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        shingles: Iterator = iter((joined,))
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[: n - 1]])
        shingles = (joined[a:b] for a, b in zip(starts.tolist(), (ends[shingle - 1 :] - 1).tolist()))
    digests = np.frombuffer(b"".join(map(xxh64_digest, shingles, repeat(seed))), np.uint8).reshape(-1, 8)
    ones = sum(np.unpackbits(digests[k : k + 65_536], axis=1).sum(axis=0, dtype=np.int64) for k in range(0, n, 65_536))
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _fingerprints(key_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.release()
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            prints = [fingerprint(t or b"") for lo in range(0, len(texts), 256) for t in texts.slice(lo, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key").cast(key_type), pa.array(prints, pa.int64()), batch.column("text_hash")], ["key", "fp", "text_hash"])

    return run


def fingerprints(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, fp, text_hash) of every row."""
    kind = df.schema[key].dataType
    return df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash")).mapInArrow(_fingerprints(_arrow(kind)), f"key {kind.simpleString()}, fp long, text_hash long")


def _rows(k: list, fp: list, stored: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(k).astype(np.int64)), pa.array(np.concatenate(fp)), pa.array(np.concatenate(stored))], ["k", "fp", "stored"])


def _ball(batches):
    """Each fingerprint under both segments, and what it looks up there: keys are (segment number, segment)."""
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        for lo in range(0, len(fp), 20_000):
            part = fp[lo : lo + 20_000]
            k, f, s = [], [], []
            for number in (0, 1):
                segment = (part >> (32 * number)) & 0xFFFFFFFF
                k.append(segment | (number << 32)), f.append(part), s.append(np.ones(len(part), bool))
                for bit in range(32):
                    zero = (segment >> bit) & 1 == 0
                    k.append(segment[zero] | (number << 32) | (1 << bit)), f.append(part[zero]), s.append(np.zeros(int(zero.sum()), bool))
            yield _rows(k, f, s)


def _divided(batches):
    """Rows of crowded keys under the halves of their other segment: (key, half number, half) folded into 64 bits."""
    for batch in batches:
        key, fp, stored = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "fp", "stored"))
        for lo in range(0, len(fp), 20_000):
            pk, pf, ps = key[lo : lo + 20_000], fp[lo : lo + 20_000], stored[lo : lo + 20_000]
            other = np.where(pk >> 32 == 0, pf >> 32, pf) & 0xFFFFFFFF
            k, f, s = [], [], []
            for half in (0, 1):
                sub = (other >> (16 * half)) & 0xFFFF
                base = (pk << 17) | (half << 16)
                k.append(base | sub), f.append(pf), s.append(ps)
                for bit in range(16):
                    k.append(base | (sub ^ (1 << bit))), f.append(pf), s.append(np.zeros(len(pf), bool))
            yield _rows(k, f, s)


def trees(fp: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Edges of trees that span the components of distinct fingerprints under links."""
    left, edges = fp, []
    while len(left) > 1:
        reach, left = [left[0]], left[1:]
        while reach and len(left):
            at = reach.pop()
            near = np.bitwise_count((left ^ at).view(np.uint64)) <= bits
            if near.any():
                found = left[near].tolist()
                edges.extend((at, b) for b in found)
                reach.extend(found)
                left = left[~near]
    return edges


def _links(batches):
    """Tree edges under each key of rows that come sorted by key."""

    def links(k, fp, stored):
        if not len(k):
            return
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        sizes = np.diff(np.r_[starts, len(k)])
        meets = (sizes > 1) & (np.add.reduceat(stored.astype(np.int64), starts) > 0)
        edges = []
        for at, n in zip(starts[meets].tolist(), sizes[meets].tolist()):
            edges.extend(trees(np.unique(fp[at : at + n])))
            if len(edges) > 100_000:
                yield edges
                edges = []
        if edges:
            yield edges

    def batch_of(edges):
        a = np.array(edges, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], ["a", "b"])

    held: list = []
    for batch in batches:
        k, fp, stored = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "fp", "stored"))
        if not len(k):
            continue
        if held and held[-1][0][-1] == k[-1]:  # the last key goes on
            held.append((k, fp, stored))
            continue
        held.append((k, fp, stored))
        k, fp, stored = (np.concatenate(c) for c in zip(*held))
        last = int(np.searchsorted(k, k[-1]))
        yield from map(batch_of, links(k[:last], fp[:last], stored[:last]))
        held = [(k[last:], fp[last:], stored[last:])]
    if held:
        yield from map(batch_of, links(*(np.concatenate(c) for c in zip(*held))))


def edges(distinct: DataFrame, crowd: int = CROWD, folder: str | None = None) -> DataFrame:
    """(a, b): links that span the components of distinct fingerprints (column fp). ``distinct`` is read twice, so pass a written one."""
    rows = distinct.select("fp").mapInArrow(_ball, "k long, fp long, stored boolean")
    ends = F.explode(F.array(F.col("fp").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("fp", 32).bitwiseOR(1 << 32))).alias("k")
    crowded = distinct.select(ends).groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("k")
    # What is stored there also looks up the keys with one bit more, which are divided as well.
    one = lambda bit: F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    more = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda bit: F.col("k").bitwiseOR(one(bit)))
    crowded = crowded.select(F.explode(F.concat(F.array("k"), more)).alias("k")).distinct()
    if folder:
        crowded = written(crowded, f"{folder}/crowded")
    found = []
    if not crowded.isEmpty():
        # Plain joins: a crowded key is what Spark divides as skew.
        dense = rows.join(crowded, "k").select("k", "fp", "stored").mapInArrow(_divided, "k long, fp long, stored boolean")
        found.append(dense)
        rows = rows.join(crowded, "k", "left_anti")
    out = None
    for part in [rows, *found]:
        met = part.repartition("k").sortWithinPartitions("k").mapInArrow(_links, "a long, b long")
        out = met if out is None else out.unionByName(met)
    return out


def near_rows(df: DataFrame, key: str, text: str, crowd: int = CROWD) -> DataFrame:
    """(key, text_hash, fp, root, component_id) of every row of ``df``; the root, a fingerprint, tells components apart whatever their keys."""
    spark = df.sparkSession
    folder = work_folder(spark)
    docs = written(fingerprints(df, key, text), f"{folder}/fingerprints")
    distinct = written(docs.groupBy("fp").agg(F.min("key").alias("first")), f"{folder}/distinct")
    roots = connected_components(spark, edges(distinct, crowd, folder), f"{folder}/components")
    of = distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("first").alias("component_id"))
    of = written(of.join(least, "root").select("fp", "root", "component_id"), f"{folder}/of")
    # Equal fingerprints may be a third of all rows: a plain inner join, which Spark splits where it is skewed.
    return docs.join(of, "fp").select("key", "text_hash", "fp", "root", "component_id")


def near_groups(df: DataFrame, key: str, text: str, crowd: int = CROWD) -> DataFrame:
    """(key, fingerprint, component_id) of every row of ``df``."""
    return near_rows(df, key, text, crowd).select("key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_groups(docs, "doc_id", "text").withColumnRenamed("key", "doc_id")
