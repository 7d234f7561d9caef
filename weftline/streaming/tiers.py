"""Incremental work on shards: each run takes what is new, and a chunk that is complete is not made again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import packing, tiers


def shard_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 1, bytes_per_batch: int | None = None) -> DataFrame:
    """New files, so many at a time, or if given up to so many bytes of them (one at least)."""
    limit = ("maxBytesPerTrigger", bytes_per_batch) if bytes_per_batch else ("maxFilesPerTrigger", files_per_batch)
    return spark.readStream.schema(schema).option(*limit).parquet(folder)


def run(spark: SparkSession, folder: str, schema, out: str, checkpoint: str, spec: dict, chunk_docs: int, files_per_batch: int = 1, run_id: str = "", texts: str | None = None, bytes_per_batch: int | None = None, whole: bool = False) -> None:
    """All shards that are new: tiers, chunks in each shard, their texts below ``texts``, and a manifest row for each chunk that is not there yet.

    Texts are written before the manifest row that declares their chunk
    complete, each chunk in a folder of its own (language, tier, hash of the
    shard's path, chunk), which a batch that is run again replaces.

    A batch that is run again after a failure finds the chunks it had finished
    and leaves them alone; numbers of chunks come from rows' places in their
    shard, so they are the same each time. A chunk is known by its shard's path
    and language, tier, number and run; a shard's number is a hash of its path,
    so names may repeat and decide nothing. A manifest without paths is an error.
    With ``whole`` the manifest counts blank texts too, and texts as they are.
    """

    def batch(df: DataFrame, _epoch: int) -> None:
        rows = df.withColumn("shard", F.pmod(F.xxhash64("_path"), F.lit(10_000)).cast("int")).withColumn("tier", tiers.assign("token_count", spec)).withColumnRenamed("_path", "path").withColumn("run", F.lit(run_id))
        cut = packing.chunks(rows, ["path", "lang", "tier"], "_row", chunk_docs)
        made = packing.chunk_manifest(cut, run_id=run_id, keys=("path", "run"), whole=whole)
        try:
            done = spark.read.schema(made.schema).parquet(out)
            if done.where("path is null").limit(1).count():
                raise ValueError(f"{out} has chunks without their shards' paths; start a new folder")
            made = packing.pending(made, done, "path", "lang", "tier", "chunk", "run")
        except Exception as error:  # noqa: BLE001
            if "PATH_NOT_FOUND" not in str(error):
                raise
        if texts:
            parts = ["lang", "tier", "file", "chunk"]
            new = cut.join(made.select("path", "lang", "tier", "chunk"), ["path", "lang", "tier", "chunk"], "left_semi").where(F.length(T.strip("text")) > 0)
            new = new.withColumn("file", F.lower(F.hex(F.xxhash64("path")))).select(*parts, "text")
            new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).json(texts)
        made.write.mode("append").parquet(out)

    stream = shard_stream(spark, folder, schema, files_per_batch, bytes_per_batch).select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def event_windows(events: DataFrame, length: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Counts and sums by type in windows of event time; works on streams and on tables."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return rows.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of each user that end after a gap."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n")
