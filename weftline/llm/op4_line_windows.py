"""Line deduplication by overlapping windows of consecutive lines.

Every WINDOW lines in a row that hold a word have a 128-bit hash. A window that
occurs more than once, in whatever documents, stays where it comes first, in
ascending order of the key, then of the text's hash, then of the place. All
later occurrences cover their lines; covered places are merged, and those
lines go. Lines outside repeated windows always stay.

All of it is built-in functions: one shuffle finds the first places, a second
brings them to the windows (a plain inner join, which Spark splits where a
passage is very common), and only places go back to the documents.

Defined results: a null text is empty; texts of fewer than WINDOW lines stay
as they are; a very long text's windows are rows like any others; of windows that
tie in their key, the text's hash and then the place in it decide; rows that repeat key and text are one document and are treated
alike; a null key comes first; an empty table gives no rows; further columns
are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK

WINDOW = 3


def windows(rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, th, pos, h): the windows of texts with columns key, th and text."""
    lines = F.split("text", "\n")

    def hashes(split):
        at = F.sequence(F.lit(0), F.size(split) - window)
        joined = F.transform(at, lambda i: F.array_join(F.slice(split, i + 1, F.lit(window)), "\n"))
        return F.transform(joined, lambda w: F.when(w.rlike(f"[^{BLANK}]"), F.unhex(F.md5(w.cast("binary")))))

    long = rows.where(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) >= window - 1)
    hashed = F.element_at(F.transform(F.array(lines), hashes), 1)
    return long.select("key", "th", F.posexplode(hashed).alias("pos", "h")).where(F.col("h").isNotNull())


def repeated_places(found: DataFrame) -> DataFrame:
    """(key, th, pos) of all windows but the first of their kind."""
    place = F.struct("key", "th", "pos")
    first = found.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "first")
    met = found.join(first, "h")
    return met.where(~place.eqNullSafe(F.col("first"))).select("key", "th", "pos")


def dedup_lines(df: DataFrame, key: str, text: str, window: int = WINDOW) -> DataFrame:
    """(key, n_lines, n_removed, text) of every row of ``df``, texts without the lines of later occurrences."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    places = repeated_places(windows(rows, window)).groupBy(F.col("key").alias("k"), F.col("th").alias("t")).agg(F.collect_set("pos").alias("starts"))
    met = rows.join(places, F.col("key").eqNullSafe(F.col("k")) & (F.col("th") == F.col("t")), "left")
    lines = F.split("text", "\n")
    covered = F.array_distinct(F.flatten(F.transform("starts", lambda p: F.sequence(p, p + (window - 1)))))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
    # ``lines`` once: each line of what stays is looked up in the split text.
    left = F.element_at(F.transform(F.array(F.struct(lines.alias("l"), kept.alias("k"))), lambda x: F.array_join(F.transform(x["k"], lambda i: F.get(x["l"], i)), "\n")), 1)
    met = met.withColumn("covered", covered)
    return met.select(
        "key", F.size(lines).cast("long").alias("n_lines"), F.when(F.col("starts").isNull(), 0).otherwise(F.size("covered")).cast("long").alias("n_removed"), F.when(F.col("starts").isNull(), F.col("text")).otherwise(left).alias("text")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_lines(docs, "doc_id", "text").withColumnRenamed("key", "doc_id")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents
), w AS (
  SELECT doc_id, i, l[i + 1] || chr(10) || l[i + 2] || chr(10) || l[i + 3] AS w
  FROM (SELECT doc_id, l, unnest(range(0, len(l) - 2)) AS i FROM d WHERE len(l) >= 3)
), r AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS nth
  FROM w WHERE regexp_matches(w, '[^\\x20\\x09-\\x0D]')
), c AS (
  SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM r WHERE nth > 1
), x AS (
  SELECT doc_id, i, l[i + 1] AS line FROM (SELECT doc_id, l, unnest(range(0, len(l))) AS i FROM d)
), s AS (
  SELECT x.doc_id, count(*) AS n_lines, count(c.i) AS n_removed,
         coalesce(string_agg(x.line, chr(10) ORDER BY x.i) FILTER (WHERE c.i IS NULL), '') AS text
  FROM x LEFT JOIN c ON x.doc_id = c.doc_id AND x.i = c.i GROUP BY x.doc_id
)
SELECT doc_id, n_lines, n_removed, text FROM s
"""
