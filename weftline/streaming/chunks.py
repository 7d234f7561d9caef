"""Chunks of a stream of shards, by buffers in keyed state.

Each shard, language and tier has a buffer of documents. A buffer that holds a
chunk's worth sends it on; what is left goes when the shard is over. The buffer
and the number of the next chunk are state that outlives a batch and a restart,
so a shard may come in any number of batches, and a chunk is sent once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import text as T
from ..operators import tiers
from ..sources import shards

#: The state store that list state needs.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OUT = "shard string, lang string, tier string, chunk int, row bigint, text string, token_count bigint"
ROW = ["row", "text", "token_count"]


class Buffers(StatefulProcessor):
    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", "row bigint, text string, token_count bigint")
        self.chunk = handle.getValueState("chunk", "chunk int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = pd.concat(list(rows), ignore_index=True)
        over = bool(came["last"].any())
        came = came.loc[~came["last"], ROW].sort_values("row")
        held = list(self.rows.get()) if self.rows.exists() else []
        if held:
            came = pd.concat([pd.DataFrame(held, columns=ROW), came], ignore_index=True)
        chunk = self.chunk.get()[0] if self.chunk.exists() else 0
        cut = len(came) if over else len(came) // self.size * self.size
        if cut:
            sent = came.iloc[:cut].assign(chunk=chunk + np.arange(cut) // self.size, **dict(zip(("shard", "lang", "tier"), key)))
            yield sent[["shard", "lang", "tier", "chunk", *ROW]]
        if over:
            self.rows.clear()
            self.chunk.clear()
            return
        left = came.iloc[cut:]
        if len(left):
            self.rows.put([(int(r), t, int(n)) for r, t, n in zip(left["row"], left["text"], left["token_count"])])
        else:
            self.rows.clear()
        self.chunk.update((chunk + cut // self.size,))

    def close(self) -> None:
        pass


def chunked(rows: DataFrame, spec: dict, size: int) -> DataFrame:
    """A stream of ``shards.SCHEMA`` as rows of complete chunks; blank texts take their places and go later, as in batch work."""
    every = F.array(*map(F.lit, spec))
    # The end of a shard goes to the buffers of all its tiers.
    tier = F.explode(F.when(F.col("last"), every).otherwise(F.array(tiers.assign("token_count", spec))))
    counted = rows.withColumn("token_count", F.when(F.col("last"), 0).otherwise(T.resolve_tokens("text", "token_count"))).withColumn("tier", tier)
    keyed = counted.select("shard", "lang", "tier", "row", "text", "token_count", "last").groupBy("shard", "lang", "tier")
    return keyed.transformWithStateInPandas(Buffers(size), OUT, "Append", "None")


def run(spark: SparkSession, folder: str, out: str, checkpoint: str, spec: dict, size: int, groups: int = 64, langs: str = "", batches: int | None = None, least: int = 0) -> DataFrame:
    """Chunk all shards that are new, or so many batches of them; rows of all complete chunks so far, each once. A batch has so many row groups, and more until they have ``least`` bytes."""
    spark.conf.set(*PROVIDER)
    shards.register(spark)
    stream = spark.readStream.format("corpus_shards").option("groupsPerBatch", groups).option("bytesPerBatch", least).option("langs", langs).option("after", shards.progress(checkpoint)).load(folder)
    # A state store is committed for each partition and batch, so a new query has no more of them than the cluster has cores.
    stores, cores = spark.conf.get("spark.sql.shuffle.partitions"), spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", min(int(stores), cores))
    try:
        query = chunked(stream, spec, size).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", stores)
    try:
        if batches is None:
            query.processAllAvailable()
        else:
            import time

            while query.exception() is None and (query.lastProgress is None or query.lastProgress["batchId"] + 1 < batches):
                time.sleep(0.2)
    finally:
        query.stop()
    return spark.read.schema(OUT).parquet(out)
