"""Chunks and bundles of documents in order. Bundling is a fold; ``folds`` runs it by ranges of the order, without texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..session import scratch
from . import folds


def chunks(df: DataFrame, keys: list[str], order: str, size: int) -> DataFrame:
    """Columns rn and chunk: numbers of rows in order within the keys, by a size."""
    rn = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("rn", rn).withColumn("chunk", F.floor((F.col("rn") - 1) / size).cast("int"))


def chunk_manifest(df: DataFrame, text: str = "text", tokens: str = "token_count", run_id: str = "", keys: tuple[str, ...] = (), whole: bool = False) -> DataFrame:
    """A row for each chunk, and by further ``keys``; blank texts have taken their places and are left out of the sums, which are over stripped texts. With ``whole`` all rows count, and texts as they are."""
    full, kept = (F.lit(True), F.col(text)) if whole else (F.length(T.strip(text)) > 0, T.strip(text))
    sums = df.groupBy("lang", "shard", "tier", "chunk", *keys).agg(F.count_if(full).alias("docs"), F.coalesce(F.sum(F.when(full, F.coalesce(tokens, F.lit(0)))), F.lit(0)).alias("source_token_count"), F.coalesce(F.sum(F.when(full, F.octet_length(kept))), F.lit(0)).alias("bin_bytes"))
    return sums.withColumn("name", T.chunk_name("lang", "shard", "chunk", "tier", run_id))


def pending(manifest: DataFrame, done: DataFrame, *key: str) -> DataFrame:
    """Chunks that are not among the completed names, or the completed values of ``key``."""
    key = key or ("name",)
    return manifest.join(done.select(*key).distinct(), list(key), "left_anti")


def bundles(df: DataFrame, group: str, order: str, tokens: str, target: int, partial: bool = False, most: int | None = None, block: int | None = None, ranges: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """(group, order, *keys, tokens, bundle, full) of the documents that end up in a bundle.

    A document is never cut: what goes beyond the target stays in its bundle.
    The last one, below the target, is dropped unless ``partial``; at most
    ``most`` bundles a group are kept. Documents that tie in their order go by
    ``keys`` and then by their tokens. ``block`` starts anew after so many
    documents of a group, with bundles numbered in each block.
    """
    laid = folds.laid_out(df, group, [order, *keys], tokens, target, scratch(df.sparkSession), ranges)
    if block:
        first = laid.groupBy("g").agg(F.min("place").alias("_first")).withColumnRenamed("g", "_g")  # a row a group
        laid = laid.join(first, F.col("g").eqNullSafe(F.col("_g"))).withColumn("k", F.floor((F.col("place") - F.col("_first")) / block))
        # A block is a group of its own, folded whole.
        made = laid.withColumns({"_name": F.col("g"), "g": F.concat_ws("/", F.coalesce("g", F.lit("")), F.col("k").cast("string"))}).drop("_first", "_g")
        out = folds.batched(made, target).withColumn("g", F.col("_name"))
    else:
        out = folds.batched(laid, target)
    out = out if partial else out.where("full")
    out = out if most is None else out.where(F.col("batch") < most)
    return out.select(F.col("g").alias(group), *[F.col(f"o{k}").alias(c) for k, c in enumerate((order, *keys))], F.col("t").alias(tokens), F.col("batch").alias("bundle"), "full")


def bundles_many(df: DataFrame, group: str, order: str, tokens: str, targets: list[int], each: int, partial: bool = False, ranges: int | None = None) -> DataFrame:
    """Bundles for several targets at once: each document goes to the next target, in turn, that lacks bundles."""
    folder = scratch(df.sparkSession)
    laid = folds.laid_out(df, group, [order], tokens, max(targets) * len(targets), f"{folder}/rows", ranges)
    used = folds.in_turn(laid, targets, each, folder)
    sums = F.sum("t").over(Window.partitionBy("g", "target", "batch"))
    out = laid.join(used, "place").withColumn("full", sums >= F.col("target"))
    out = out if partial else out.where("full")
    return out.select(F.col("g").alias(group), F.col("o0").alias(order), F.col("t").alias(tokens), F.col("target").alias("target_tokens"), F.col("batch").alias("bundle"), "full")


BOUNDARY = "===== DOCUMENT BOUNDARY ====="


def bundle_rows(assigned: DataFrame, docs: DataFrame, group: str, order: str, tokens: str, target: int, split: str = "train", prefix: str = "pack", text: str = "text", source: str = "source") -> DataFrame:
    """The bundle's text, each document under a header, and what it was made of."""
    # Rows that tie are numbered on both sides, so that each meets one of the other's.
    tied = Window.partitionBy(group, order, "_t")
    count = F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(0)), F.lit(0)).alias("_t")
    left = assigned.select(group, order, count, "bundle", "full").withColumn("_n", F.row_number().over(tied.orderBy("bundle")))
    right = docs.select(F.col(group).alias(group), F.col(order), count, F.col(text).alias("_text"), F.col(source).alias("_source")).withColumn("_n", F.row_number().over(tied.orderBy(F.xxhash64("_source", "_text"))))
    same = F.col("l._n") == F.col("r._n")
    for name in (group, order, "_t"):
        same &= F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    joined = left.alias("l").join(right.alias("r"), same).select(*[f"l.{c}" for c in (group, order, "_t", "bundle", "full")], "_text", "_source")
    did = T.doc_id("_source", order, "_text")
    header = F.concat(F.lit(f"\n\n{BOUNDARY}\nlanguage: "), F.col(group), F.lit("\nsource: "), F.col("_source"), F.lit("\ndoc_id: "), did, F.lit("\nsource_tokens: "), F.col("_t").cast("string"), F.lit("\n===== CONTENT =====\n"))
    item = F.struct(F.col(order).alias("o"), F.concat(header, T.strip("_text")).alias("part"), F.struct(did.alias("doc_id"), F.col("_source").alias("source"), F.col(order).cast("string").alias("local_id"), F.col("_t").alias("token_count")).alias("doc"))
    packed = joined.groupBy(group, "bundle").agg(F.array_sort(F.collect_list(item)).alias("items"), F.sum("_t").alias("estimated_tokens"), F.bool_and("full").alias("full"))
    return packed.select(
        F.concat(T.strip(F.array_join(F.transform("items", lambda x: x["part"]), "\n")), F.lit("\n")).alias("text"), F.col(group).alias("lang"), F.lit(split).alias("split"), F.lit("constructed_long_document_clm").alias("task"),
        T.pack_id(prefix, split, group, F.lit(target), "bundle").alias("pack_id"), F.lit(target).cast("long").alias("target_tokens"), "estimated_tokens", (F.col("estimated_tokens") / target).alias("fill_ratio"),
        F.size("items").cast("long").alias("source_doc_count"), F.transform("items", lambda x: x["doc"]).alias("source_docs"), (~F.col("full")).alias("partial"),
    )


def batches(df: DataFrame, order: str, size: str, most_rows: int, most_bytes: int = 0, ranges: int | None = None) -> DataFrame:
    """Column batch: a batch ends when it holds so many rows, or so many bytes if that is above 0."""
    laid = folds.laid_out(df, None, [order], size, most_bytes, scratch(df.sparkSession), ranges)
    return folds.batched(laid, most_bytes, most_rows).select(F.col("o0").alias(order), F.col("t").alias(size), "batch")
