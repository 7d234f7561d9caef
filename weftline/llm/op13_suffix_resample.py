"""Importance resampling towards a target's distribution of hashed n-grams.

Each task turns a block of its texts into word ids and sorts the suffixes of
their sequence, words of a document being fenced off from the next one's. In
that order equal runs of words are neighbours: a run of suffixes that share at
least k words (by their longest common prefixes) holds all occurrences of one
k-gram of the block. It is hashed once, and its bucket is scattered back to the
places where it occurs. Documents keep the buckets of their features, two bytes
a feature; the texts are read once.

Buckets are counted in tasks, then over all; a bucket's gain is the logarithm
of its likelihood in the target over that in the source. A document's weight
adds up the gains of its features, and the highest weights plus a Gumbel draw,
which follows from the id and a seed, are kept: a sample without replacement in
proportion to the weights' exponentials.

Defined results: a null or empty text has no features, the weight 0 and no
rank; very long texts are a block of their own; equal scores go by the smaller
id, null ids last (their draw is that of the word "null"), and repeated rows are
drawn each on its own, in any order; an empty table gives none, and an empty
target one without features; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import running
from . import tokens
from .common import strings, work_folder, written

#: Longest n-gram, buckets, percent that are drawn, least words of a document that may be drawn, seed.
GRAMS, BUCKETS, PERCENT, LEAST, SEED = 1, 10_000, 10, 20, 2024
#: Words of a block of texts that are sorted together.
BLOCK = 1 << 19

#: Upper-case ASCII letters become lower-case ones; what is no word character becomes a blank.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    """Lower-cased runs of digits, ASCII letters and all characters beyond ASCII."""
    return text.translate(_FOLD).split()


def suffix_order(ids: np.ndarray, depth: int) -> np.ndarray:
    """The places of a sequence in the order of the ``depth`` or more ids from each on, by doubling; what is beyond the end comes first."""
    rank, width = np.unique(ids, return_inverse=True)[1].astype(np.int64) + 1, 1
    while width < depth:
        after = np.zeros_like(rank)
        after[:-width] = rank[width:]
        rank = np.unique(rank * (int(rank.max(initial=0)) + 1) + after, return_inverse=True)[1].astype(np.int64) + 1
        width *= 2
    return np.argsort(rank, kind="stable")


def common_prefixes(ids: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Of each suffix in order, how many ids it shares with the one before it, ``depth`` at most."""
    lcp, same = np.zeros(len(order), np.int64), np.ones(max(len(order) - 1, 0), bool)
    padded = np.concatenate([ids, np.full(depth, -1, ids.dtype)])
    for k in range(depth):
        ahead = padded[order + k]
        same &= (ahead[1:] == ahead[:-1]) & (ahead[1:] >= 0)
        lcp[1:] += same
    return lcp


def block_buckets(documents: list[list[bytes]], grams: int, buckets: int) -> list[np.ndarray]:
    """The buckets of each document's features: all runs of 1 to ``grams`` words, repeats included."""
    known: dict[bytes, int] = {}
    fenced: list[int] = []
    # A fence is an id that is met once, so that no common prefix goes beyond it.
    for n, own in enumerate(documents):
        fenced.extend([known.setdefault(w, len(known)) for w in own])
        fenced.append(-2 - n)
    ids, names = np.array(fenced, np.int64), list(known)
    order = suffix_order(ids, grams)
    lcp = common_prefixes(ids, order, grams)
    ends = np.cumsum([len(own) + 1 for own in documents])
    # How many words there are from each place to its document's fence.
    left = np.repeat(ends, [len(own) + 1 for own in documents]) - 1 - np.arange(len(ids)) if documents else np.zeros(0, np.int64)
    found: list[list[np.ndarray]] = [[] for _ in documents]
    for k in range(1, grams + 1):
        heads = np.flatnonzero((lcp < k) & (left[order] >= k))
        starts = order[heads]
        # Hashed once for each run; its members follow its head in the order.
        hashed = np.fromiter((zlib.crc32(b" ".join([names[i] for i in ids[p : p + k]])) % buckets for p in starts.tolist()), np.int64, len(starts)) if k > 1 else np.fromiter((zlib.crc32(names[i]) % buckets for i in ids[starts].tolist()), np.int64, len(starts))
        enough = left[order] >= k
        run = np.cumsum((lcp < k) & enough) - 1
        scattered = np.full(len(ids), -1, np.int64)
        scattered[order[enough]] = hashed[run[enough]]
        for n, (a, b) in enumerate(zip([0, *ends], ends - 1)):
            own = scattered[a:b]
            found[n].append(own[own >= 0])
    return [np.concatenate(x) for x in found]


def _featured(grams: int, buckets: int):
    """(row, key, n_words, n_features, buckets) of texts."""
    store = "<u2" if buckets <= 1 << 16 else "<u4"
    names = ["row", "key", "n_words", "n_features", "buckets"]

    def flush(batch: pa.RecordBatch, lo: int, hi: int, block: list[list[bytes]]) -> pa.RecordBatch:
        made = block_buckets(block, grams, buckets)
        part = batch.slice(lo, hi - lo)
        return pa.RecordBatch.from_arrays([part.column("row"), part.column("key"), pa.array([len(x) for x in block], pa.int64()), pa.array([len(x) for x in made], pa.int64()), pa.array([x.astype(store).tobytes() for x in made], pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.release()
        for batch in batches:
            lo, held, block = 0, 0, []
            for at, text in enumerate(strings(batch.column("text"))):
                block.append(words(text))
                held += len(block[-1])
                if held >= BLOCK:
                    yield flush(batch, lo, at + 1, block)
                    lo, held, block = at + 1, 0, []
            if block:
                yield flush(batch, lo, batch.num_rows, block)

    return run


def features(df: DataFrame, key: str, text: str, grams: int = GRAMS, buckets: int = BUCKETS) -> DataFrame:
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_featured(grams, buckets), f"row long, key {df.schema[key].dataType.simpleString()}, n_words long, n_features long, buckets binary")


def bucket_counts(featured: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds; a row for each bucket comes to the driver, at any size of the table."""
    store = "<u2" if buckets <= 1 << 16 else "<u4"

    def counted(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(x or b"" for x in batch.column("buckets").to_pylist()), store), minlength=buckets)
        on = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int64()), pa.array(total[on], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in featured.select("buckets").mapInArrow(counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A thousand times the logarithm of each bucket's likelihood in the target over that in the source, a count added to each, rounded down."""
    s_all, t_all, n = int(source.sum()), int(target.sum()), len(source)
    one = lambda s, t: math.floor(1000 * math.log(float(t + 1) * float(s_all + n) / (float(s + 1) * float(t_all + n))))
    return np.array([one(s, t) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weighed(gain: np.ndarray):
    store = "<u2" if len(gain) <= 1 << 16 else "<u4"

    def run(batches):
        for batch in batches:
            weights = [int(gain[np.frombuffer(x, store)].sum()) for x in batch.column("buckets").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("row", "key", "n_words", "n_features")], pa.array(weights, pa.int64())], ["row", "key", "n_words", "n_features", "weight"])

    return run


def resample(df: DataFrame, key: str, text: str, target: DataFrame, target_text: str, folder: str, percent: int = PERCENT, least: int = LEAST, grams: int = GRAMS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(key, n_features, weight, score, rank) of every row; those drawn have ranks 1, 2, 3 and so on, the others none."""
    kind = df.schema[key].dataType.simpleString()
    source = written(features(df, key, text, grams, buckets), f"{folder}/features")
    goal = features(target.select(F.lit(0).alias("key"), F.col(target_text).alias("text")), "key", "text", grams, buckets)
    gain = gains(bucket_counts(source, buckets), bucket_counts(goal, buckets))
    weighed = source.mapInArrow(_weighed(gain), f"row long, key {kind}, n_words long, n_features long, weight long")
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))
    scored = written(weighed.withColumn("score", F.col("weight") + noise), f"{folder}/scored")
    able = scored.where(F.col("n_words") >= least).select("row", "key", "score")
    most = able.count() * percent // 100
    ranked = running(able, [F.desc("score"), F.asc_nulls_last("key"), F.asc("row")], None, "before", f"{folder}/ranked")
    ranks = ranked.where(F.col("before") < most).select("row", (F.col("before") + 1).cast("long").alias("rank"))
    return scored.join(ranks, "row", "left").select("key", "n_features", "weight", F.col("score").cast("long").alias("score"), "rank")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    return resample(docs, "doc_id", "text", target, "text", work_folder(spark)).withColumnRenamed("key", "doc_id")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
#: The CRC is worked out byte by byte, once for each distinct word.
ORACLE_SQL = f"""WITH crc_table AS (SELECT list(list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t FROM range(256) r(n)),
  feature AS (SELECT 'd' AS side, doc_id, unnest({_WORDS}) AS word FROM documents UNION ALL SELECT 'b', item_id, unnest({_WORDS}) FROM benchmark),
  hashed AS (SELECT word, xor(list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INT, 2))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {BUCKETS} AS bucket FROM (SELECT DISTINCT word FROM feature), crc_table),
  placed AS (SELECT side, doc_id, bucket FROM feature JOIN hashed USING (word)),
  total AS (SELECT count(*) FILTER (side = 'd') AS s_all, count(*) FILTER (side = 'b') AS t_all FROM placed),
  gain AS (SELECT bucket, floor(1000 * ln((count(*) FILTER (side = 'b') + 1)::DOUBLE * (any_value(s_all) + {BUCKETS})::DOUBLE / ((count(*) FILTER (side = 'd') + 1)::DOUBLE * (any_value(t_all) + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM placed, total GROUP BY bucket),
  weighed AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM placed JOIN gain USING (bucket) WHERE side = 'd' GROUP BY doc_id),
  scored AS (SELECT d.doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight, (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score FROM documents d LEFT JOIN weighed USING (doc_id)),
  able AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= {LEAST})
SELECT s.doc_id, n_features, weight, score, CASE WHEN rank <= n * {PERCENT} // 100 THEN rank END AS rank FROM scored s LEFT JOIN able USING (doc_id)"""
