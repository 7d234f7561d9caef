"""A queue of experiments: cases that are scored once each, whatever happens to the run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import readers, result_log


def results(spark: SparkSession, log: str, schema) -> DataFrame:
    """What the log holds; no rows where there is none yet."""
    result_log.register(spark)
    return spark.read.format("result_log").schema(schema).load(log) if readers.exists(spark, log) else spark.createDataFrame([], schema)


def remaining(cases: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Cases that the log does not hold; keys may be null, fractions are told apart to eight digits."""
    place = lambda df, c: F.round(c, 8) if dict(df.dtypes)[c] in ("double", "float") else F.col(c)
    seen = done.select(*[place(done, k).alias(f"_{k}") for k in keys]).distinct()
    same = F.lit(True)
    for k in keys:
        same &= place(cases, k).eqNullSafe(F.col(f"_{k}"))
    return cases.join(seen, same, "left_anti")


def finished(cases: DataFrame, done: DataFrame, experiment: str, keys: list[str]) -> DataFrame:
    """(experiment, cases, left, finished): which experiments have all their cases in the log and are to be skipped."""
    left = remaining(cases, done, keys).groupBy(F.col(experiment).alias("_e")).agg(F.count("*").alias("left"))
    total = cases.groupBy(experiment).agg(F.count("*").alias("cases"))
    met = total.join(left, F.col(experiment).eqNullSafe(F.col("_e")), "left").drop("_e")
    return met.withColumn("left", F.coalesce("left", F.lit(0))).withColumn("finished", F.col("left") == 0)


def run(spark: SparkSession, folder: str, schema, score: Callable[[DataFrame], DataFrame], log: str, checkpoint: str, keys: list[str], files_per_batch: int = 1) -> None:
    """Score the cases of new files below ``folder`` that the log lacks, a batch at a time, and log the results."""
    result_log.register(spark)
    cases = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)

    def batch(rows: DataFrame, number: int) -> None:
        scored = score(rows.dropDuplicates(keys))
        new = remaining(scored, results(spark, log, scored.schema), keys)
        new.write.format("result_log").option("path", log).option("batch", f"queue-{number:012d}").mode("append").save()

    cases.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
