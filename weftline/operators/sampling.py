"""Limits and samples. Chance is the order of a seeded hash, which any engine repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ordered import hash_key, prefix_by_hash, prefix_by_value


def first_per_group(df: DataFrame, group: str, order, n: int) -> DataFrame:
    """The first n rows of each group; Spark keeps no more than n of a group before it shuffles."""
    w = Window.partitionBy(group).orderBy(*(order if isinstance(order, (list, tuple)) else [order]))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn") if n > 0 else df


def first(df: DataFrame, order, n: int) -> DataFrame:
    """The first n rows of all."""
    return df.orderBy(*(order if isinstance(order, (list, tuple)) else [order])).limit(n)


def token_budget(df: DataFrame, key: str, tokens: str, budget: int, seed: int, least: int = 0, most: int | None = None) -> DataFrame:
    """Eligible rows in hash order for as long as the sum before a row is below the budget; the last may go beyond it."""
    keep = F.col(tokens) >= least
    eligible = df.where(keep if most is None else keep & (F.col(tokens) <= most)).withColumn("_h", hash_key(seed, key))
    return prefix_by_hash(eligible, "_h", tokens, "tokens_before").where(F.col("tokens_before") < budget).drop("_h")


def per_group(df: DataFrame, group: str, key: str, n: int, seed: int) -> DataFrame:
    """At most n rows of each group, by hash order."""
    return first_per_group(df.withColumn("_h", hash_key(seed, key)), group, "_h", n).drop("_h")


def char_prefix(df: DataFrame, order: str, chars: str, most: int) -> DataFrame:
    """Rows in order up to the one that goes beyond so many characters."""
    return prefix_by_value(df, order, chars, "chars_before").where(F.col("chars_before") <= most)


def top(df: DataFrame, by: str, n: int, ties: str) -> DataFrame:
    return df.orderBy(F.desc(by), ties).limit(n)
