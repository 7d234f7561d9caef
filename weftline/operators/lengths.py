"""Canonical documents, length filters and length statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T

# Context lengths of coverage reports.
CONTEXTS = (4096, 8192, 16384, 32768, 65536, 131072)


def canonicalize(df: DataFrame, text: str = "text", count: str | None = None, other: str | None = None, min_chars: int = 1, policy: str = "source") -> DataFrame:
    """Stripped texts of at least so many characters, with token counts."""
    tokens = T.resolve_tokens(text, count, other, policy)
    return df.withColumns({"token_count": tokens, text: T.strip(text)}).where(F.length(text) >= min_chars)


def conversion_summary(df: DataFrame, lang: str = "lang", tokens: str = "token_count", size: str = "n_bytes") -> DataFrame:
    """Documents, tokens, MB and share of tokens by language, and in total (language null)."""
    sums = df.rollup(lang).agg(F.count("*").alias("docs"), F.sum(tokens).alias("tokens"), F.round(F.sum(size) / 1e6, 6).alias("mb"), F.grouping(lang).alias("is_total"))
    # A row for each language: the window is over that table.
    total = F.max(F.when(F.col("is_total") == 1, F.col("tokens"))).over(Window.partitionBy())
    return sums.withColumn("share", F.round(F.try_divide(F.col("tokens"), total), 9))


def filter_long(df: DataFrame, tokens: str, least: int, most: int | None = None) -> DataFrame:
    """Rows of least to most tokens, both included."""
    keep = F.col(tokens) >= least
    return df.where(keep if most is None else keep & (F.col(tokens) <= most))


def filter_summary(df: DataFrame, lang: str, tokens: str, least: int, most: int | None = None) -> DataFrame:
    """What a length filter takes and keeps, in one pass."""
    keep = F.col(tokens) >= least if most is None else F.col(tokens).between(least, most)
    kept = df.groupBy(lang).agg(F.count("*").alias("in_docs"), F.count_if(keep).alias("out_docs"), F.sum(tokens).alias("in_tokens"), F.coalesce(F.sum(F.when(keep, F.col(tokens))), F.lit(0)).alias("out_tokens"))
    return kept.withColumn("kept_pct", F.round(F.coalesce(F.try_divide(100 * F.col("out_docs"), F.col("in_docs")), F.lit(0.0)), 6))


def nearest_rank(df: DataFrame, group: str, value: str, percents=(50, 90)) -> DataFrame:
    """Counts, sums, ends, and of each percent p the value at place min(int(n p / 100), n - 1) in order.

    Values are counted first, so each group's window runs over its distinct
    lengths, not its rows.
    """
    counts = df.groupBy(group, value).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(group).orderBy(value))
    total = F.sum("_n").over(Window.partitionBy(group))
    ranked = counts.withColumns({"_upto": upto, "_total": total})
    place = lambda p: F.least(F.floor(F.col("_total") * p / 100), F.col("_total") - 1)
    return ranked.groupBy(group).agg(
        F.sum("_n").alias("docs"), F.sum(F.col(value) * F.col("_n")).alias("total_tokens"), F.min(value).alias("min_tokens"),
        *[F.min(F.when(F.col("_upto") > place(p), F.col(value))).alias(f"p{p}") for p in percents], F.max(value).alias("max_tokens"),
    )


def interpolated(df: DataFrame, groups: list[str], value: str, percents=(50, 90)) -> DataFrame:
    """The same with percentiles between neighbours, cut to integers."""
    q = F.percentile(value, [p / 100 for p in percents])
    return df.groupBy(*groups).agg(F.count("*").alias("docs"), F.sum(value).alias("total_tokens"), F.min(value).alias("min_tokens"), *[q[k].cast("long").alias(f"p{p}") for k, p in enumerate(percents)], F.max(value).alias("max_tokens"))


def coverage(df: DataFrame, group: str, value: str, contexts=CONTEXTS) -> DataFrame:
    """Of each context length: documents and tokens that reach it, its share of documents, and sequences it fills."""
    at = [F.struct(F.lit(t).cast("long").alias("context"), F.count_if(F.col(value) >= t).alias("docs"), F.coalesce(F.sum(F.when(F.col(value) >= t, F.col(value))), F.lit(0)).alias("tokens")) for t in contexts]
    rows = df.groupBy(group).agg(F.count("*").alias("_all"), F.array(*at).alias("_at")).select(group, "_all", F.inline("_at"))
    return rows.select(group, "context", "docs", F.round(100 * F.try_divide(F.col("docs"), F.col("_all")), 6).alias("docs_pct"), "tokens", F.floor(F.col("tokens") / F.col("context")).alias("sequences"))


def histogram(df: DataFrame, value: str, edges: list[int]) -> DataFrame:
    """Rows and share of each range between edges, the lower one included."""
    bucket = F.when(F.col(value) < edges[0], F.lit(f"<{edges[0]}"))
    for a, b in zip(edges, edges[1:]):
        bucket = bucket.when(F.col(value) < b, F.lit(f"{a}-{b}"))
    counts = df.groupBy(bucket.otherwise(F.lit(f">={edges[-1]}")).alias("bucket")).agg(F.count("*").alias("docs"), F.sum(value).alias("tokens"))
    return counts.withColumn("docs_pct", F.round(100 * F.col("docs") / F.sum("docs").over(Window.partitionBy()), 6))


def long_share(df: DataFrame, source: str, value: str, contexts) -> DataFrame:
    """Share of each source's tokens in documents that reach each length."""
    return df.groupBy(source).agg(*[F.coalesce(F.try_divide(F.coalesce(F.sum(F.when(F.col(value) >= t, F.col(value))), F.lit(0)), F.sum(value)), F.lit(0.0)).alias(f"share_{t}") for t in contexts])


def effective_fraction(shares: DataFrame, weights: DataFrame, source: str, contexts) -> DataFrame:
    """Mean of the shares by mixture weights; a source that could not be read adds nothing, and its weight counts."""
    joined = weights.join(shares, source, "left")
    return joined.agg(*[F.round(F.try_divide(F.sum(F.col("weight") * F.coalesce(f"share_{t}", F.lit(0.0))), F.sum("weight")), 9).alias(f"fraction_{t}") for t in contexts])
