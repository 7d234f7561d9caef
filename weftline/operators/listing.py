"""Shards and files: listings, limits, estimates and language coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import col, human_bytes, skip_ranges
from .sampling import first_per_group


def select_shards(listing: DataFrame, n: int) -> DataFrame:
    """The first n shards of each language by path; all if n is 0."""
    return first_per_group(listing, "lang", "path", n)


def without_skipped(shards: DataFrame, skips: str) -> DataFrame:
    """Shards (lang, shard) that a list such as ``fr:24,en:20-22`` does not name."""
    named = shards.sparkSession.range(1).select(F.inline(skip_ranges(F.lit(skips)))).distinct()
    return shards.join(F.broadcast(named), ["lang", "shard"], "left_anti")  # the list is an argument


def estimate(listing: DataFrame, overhead: float = 1.1) -> DataFrame:
    """Files and sizes by language and in total (null), with the space to have free."""
    sums = listing.rollup("lang").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.min_by("size", F.struct("path", "lang")).alias("first_bytes"))
    return sums.withColumns({"gb": F.round(F.col("bytes") / 1e9, 9), "need_gb": F.round(F.col("bytes") * overhead / 1e9, 9), "readable": human_bytes("bytes")})


def completed_names(files: DataFrame, path: str = "path") -> DataFrame:
    """Names of completed chunks by their manifests' file names."""
    return files.select(F.regexp_extract(path, r"manifests/(?:.*/)?([^/]+)\.json$", 1).alias("name")).where("name <> ''").distinct()


def token_pairs(files: DataFrame, suffix: str = "_text_document") -> DataFrame:
    """(lang, prefix, bin_bytes) of token files that have an index beside them."""
    stem = F.regexp_replace("name", r"\.(bin|idx)$", "")
    bins = files.where(F.col("name").endswith(f"{suffix}.bin")).select(stem.alias("prefix"), F.col("size").alias("bin_bytes"))
    idx = files.where(F.col("name").endswith(".idx")).select(stem.alias("prefix"))
    return bins.join(idx, "prefix", "left_semi").select(F.regexp_replace("prefix", f"{suffix}$", "").alias("lang"), "prefix", "bin_bytes")


def present(files: DataFrame, least: int = 1024) -> DataFrame:
    """Files of more than so many bytes: smaller ones are what a failed run left."""
    return files.where(F.col("size") > least)


def without_prefix(files: DataFrame, prefix: str = "test_", name: str = "name", total: str = "size") -> DataFrame:
    return files.where(~F.col(name).startswith(prefix) & (F.col(total) > 0))


def of_lang(files: DataFrame, lang, name: str = "name") -> DataFrame:
    """Files whose names hold the language between underscores."""
    return files.where(F.col(name).contains(F.concat(F.lit("_"), col(lang), F.lit("_"))))


def parse_names(files: DataFrame, tiers: list[str], name: str = "name") -> DataFrame:
    """(lang, tier, ext) of file names; others go."""
    pattern = rf"^([a-z]+)_({'|'.join(tiers)})_text_document\.(bin|idx)$"
    return files.where(F.col(name).rlike(pattern)).withColumns({n: F.regexp_extract(name, pattern, k) for k, n in enumerate(("lang", "tier", "ext"), 1)})


def missing_coverage(missing: DataFrame, adapters: DataFrame) -> DataFrame:
    """Of each missing language, the adapters that have it."""
    have = adapters.groupBy("lang").agg(F.array_sort(F.collect_set("adapter")).alias("adapters"))
    return missing.join(have, "lang", "left").withColumn("adapters", F.coalesce("adapters", F.array().cast("array<string>")))


def category_sizes(files: DataFrame, category: str = "category", size: str = "size") -> DataFrame:
    """GB to two digits and share of each category, largest first."""
    from pyspark.sql.window import Window

    sums = files.groupBy(category).agg(F.sum(size).alias("bytes"))
    return sums.select(category, F.round(F.col("bytes") / 1e9, 2).alias("gb"), F.round(100 * F.col("bytes") / F.sum("bytes").over(Window.partitionBy()), 6).alias("pct")).orderBy(F.desc("gb"), category)
