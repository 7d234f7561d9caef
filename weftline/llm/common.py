"""What the operators share: the shared work folder, written intermediates, ordered prefix sums and components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The ASCII white space of the contracts, for Java regular expressions and for SQL.
BLANK = "\\x20\\x09-\\x0D"


def work_folder(spark: SparkSession) -> str:
    """A new folder below the one that the cluster names in spark.checkpoint.dir.

    All executors see that folder. Only where the setting is absent, as in a
    local test session, a temporary folder of this machine stands in for it.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="weftline-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/weftline-{uuid.uuid4().hex}"


#: With this, Spark deletes a query's shuffle files as soon as it has ended, which else wait until the driver collects its garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Cut the lineage: write ``df`` to ``path`` in the shared folder and read it back; nothing else of it stays on disk."""
    spark, names = df.sparkSession, list(partition_by)
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    before = spark.conf.get(CLEANED, "false")
    spark.conf.set(CLEANED, "true")
    try:
        (writer.partitionBy(*names) if names else writer).parquet(path)
    finally:
        spark.conf.set(CLEANED, before)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate that no later plan reads."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def exclusive_prefix(df: DataFrame, order: str, value: str, out: str, ties: Iterable[str] = (), buckets: int = 256) -> DataFrame:
    """Sum of ``value`` over all rows before a row in ascending ``order`` (nulls first), without one task that sees all rows.

    Quantiles of ``order`` cut the rows into at most ``buckets`` + 2 ranges. The
    totals of the ranges, a bounded number of rows, are summed first; each
    range then runs its own window. ``df`` is read twice, so pass one that is
    written. Rows with equal ``order`` follow ``ties``.
    """
    cuts = sorted({int(x) for x in df.approxQuantile(order, [i / buckets for i in range(1, buckets)], 0.25 / buckets)}) if buckets > 1 else []
    key = F.lit(0)
    if cuts:
        marks = F.array(*[F.lit(c).cast("long") for c in cuts])
        # The number of cuts below the value, by its place among them.
        key = F.size(F.filter(marks, lambda c: c < F.col(order))) + 1
    ranged = df.withColumn("_range", F.when(F.col(order).isNull(), F.lit(0)).otherwise(key))
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range: at most buckets + 1 rows, whatever the input.
    bases = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy(F.col(order).asc_nulls_first(), *ties).rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.join(F.broadcast(bases), "_range")
        .withColumn(out, (F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).cast("long"))
        .drop("_range", "_base")
    )


def strings(column) -> Iterator[bytes]:
    """The UTF-8 bytes of an Arrow string column; nulls are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    return (x or b"" for x in column.to_pylist())


def connected_components(spark: SparkSession, edges: DataFrame, folder: str, rounds: int = 40) -> DataFrame:
    """The least node of each node's component, for the nodes that edges (a, b) name; rows (node, root).

    Alternating large-star and small-star steps on the edge table, each written
    to the shared folder. Each step takes the least neighbour by a partial
    aggregate and joins it back, so that a node with very many edges never
    sits in one task; the number of steps grows with the logarithm of the
    longest path. Nothing but a count comes to the driver.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{folder}/edges0")
    last = None
    for step in range(1, rounds + 1):
        # Large star: the larger neighbours of each node go to the least of its neighbours and itself.
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.distinct(), f"{folder}/edges{step}l")
        # Small star: the smaller neighbours of each node, and itself, go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").where("a <> b")
        edges = written(small.distinct(), f"{folder}/edges{step}s")
        sign = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))).first()
        remove(spark, f"{folder}/edges{step}l")
        if step > 1:
            remove(spark, f"{folder}/edges{step - 1}s")
        if sign == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        last = sign
    raise RuntimeError("components did not settle; raise `rounds`")
