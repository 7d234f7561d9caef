"""Mixture weights. Tables here hold a row for each source or chunk, so windows over all of them are small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window



def _total(c) -> Column:
    return F.sum(c).over(Window.partitionBy())


def tempered(sizes: DataFrame, size: str = "bin_bytes", alpha: float = 0.3, floor: float = 0.005) -> DataFrame:
    """Weights by size to the power alpha, sizes of 0 staying 0, then raised to a floor and brought to sum 1 once.

    After that last step a weight may be below the floor. Without any size all weights are 0.
    """
    p = F.coalesce(F.try_divide(F.col(size).cast("double"), _total(size)), F.lit(0.0))
    out = sizes.withColumn("natural_p", p)
    out = out.withColumn("_r", F.when(F.col("natural_p") > 0, F.pow("natural_p", F.lit(float(alpha)))).otherwise(0.0))
    out = out.withColumn("weight", F.coalesce(F.try_divide(F.col("_r"), _total("_r")), F.lit(0.0)))
    if floor > 0:
        raised = out.withColumn("_f", F.greatest("weight", F.lit(float(floor)))).withColumn("_some", _total(size) > 0)
        out = raised.withColumn("weight", F.when(F.col("_some"), F.col("_f") / _total("_f")).otherwise(0.0)).drop("_f", "_some")
    return out.drop("_r")


def tier_proportional(chunks: DataFrame, tiers: DataFrame, size: str = "bin_bytes") -> DataFrame:
    """A tier's weight by bytes within it; an absent tier's weight goes to no other."""
    joined = chunks.join(F.broadcast(tiers.select("tier", F.col("weight").alias("_w"))), "tier")  # a row for each tier of the specification
    inside = F.sum(size).over(Window.partitionBy("tier"))
    return joined.withColumns({"natural_p": F.coalesce(F.try_divide(F.col(size), _total(size)), F.lit(0.0)), "weight": F.coalesce(F.try_divide(F.col("_w") * F.col(size), inside), F.lit(0.0))}).drop("_w")


def uniform_present(entries: DataFrame, tiers: DataFrame) -> DataFrame:
    """A tier's weight in equal parts to the languages that have it."""
    joined = entries.select("lang", "tier").distinct().join(F.broadcast(tiers.select("tier", F.col("weight").alias("_w"))), "tier")
    return joined.withColumn("weight", F.col("_w") / F.count("*").over(Window.partitionBy("tier"))).drop("_w")


def uniform_all(entries: DataFrame, tiers: DataFrame, budget: float = 1.0, renormalize: bool = True) -> DataFrame:
    """A tier's weight by the number of all languages; what is missing is left out, and the rest brought to sum 1."""
    present = entries.select("lang", "tier").distinct()
    n = present.agg(F.count_distinct("lang").alias("_n"))
    out = present.join(F.broadcast(tiers.select("tier", F.col("weight").alias("_w"))), "tier").join(F.broadcast(n)).withColumn("weight", F.lit(budget) * F.col("_w") / F.col("_n")).drop("_w", "_n")
    return out.withColumn("weight", F.col("weight") / _total("weight")) if renormalize else out


def families(parts: list[DataFrame], name: str = "name") -> DataFrame:
    """Union of weighted parts, brought to sum 1."""
    out = parts[0].select(name, "weight")
    for part in parts[1:]:
        out = out.unionByName(part.select(name, "weight"))
    return out.withColumn("weight", F.col("weight") / _total("weight"))


def proportional(sizes: DataFrame, size: str, budget: float = 1.0) -> DataFrame:
    return sizes.withColumn("weight", F.coalesce(F.lit(budget) * F.try_divide(F.col(size), _total(size)), F.lit(0.0)))


def blend(a: DataFrame, b: DataFrame, share: float, name: str = "name") -> DataFrame:
    """Two pools whose weights each sum to 1, scaled to share and 1 - share."""
    both = a.select(name, (F.col("weight") * share).alias("weight")).unionByName(b.select(name, (F.col("weight") * (1 - share)).alias("weight")))
    return both.groupBy(name).agg(F.sum("weight").alias("weight"))


def boosted(weights: DataFrame, name: str, which: str, times: float, floor: float) -> DataFrame:
    """One source's weight times a factor, all raised to a floor, brought to sum 1."""
    raised = weights.withColumn("weight", F.greatest(F.col("weight") * F.when(F.col(name) == which, times).otherwise(1.0), F.lit(floor)))
    return raised.withColumn("weight", F.col("weight") / _total("weight"))


def explicit(sizes: DataFrame, name: str, weights: dict[str, float]) -> DataFrame:
    """Given weights of the sources that are there, brought to sum 1; others are 0."""
    given = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    out = sizes.withColumn("weight", F.coalesce(given[F.col(name)].cast("double"), F.lit(0.0)))
    return out.withColumn("weight", F.coalesce(F.try_divide(F.col("weight"), _total("weight")), F.lit(0.0)))


def data_path(weights: DataFrame, prefix: str = "prefix", weight: str = "weight", digits: int = 6, order: str | None = None) -> DataFrame:
    """One string of weights and prefixes, by descending weight (equal ones by prefix), or by another column."""
    first = F.col(order) if order else -F.col(weight)
    item = F.format_string(f"%.{digits}f %s", F.col(weight), F.col(prefix))
    return weights.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(first.alias("o"), F.col(prefix).alias("p"), item.alias("s")))), lambda x: x["s"]), " ").alias("data_path"))


def parse_data_path(df: DataFrame, c: str = "data_path") -> DataFrame:
    """Rows (pos, weight, prefix) of such strings, also as DATA="..." within a script."""
    text = F.when(F.col(c).rlike('(?s)DATA="'), F.regexp_extract(c, r'(?s)DATA="([^"]*)"', 1)).otherwise(F.col(c))
    items = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    starts = F.when(F.size(items) < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(items) - 2, F.lit(2)))
    pairs = F.transform(starts, lambda i: F.struct(F.get(items, i).cast("double").alias("weight"), F.get(items, i + 1).alias("prefix")))
    return df.select(F.posexplode(pairs).alias("pos", "_x")).select("pos", "_x.*")


def manifest(weights: DataFrame, name: str = "lang", alpha: float = 0.3, floor: float = 0.005) -> DataFrame:
    """One JSON document with all sources."""
    entry = F.struct(F.col(name).alias("key"), F.struct("prefix", "bin_bytes", "natural_p", "weight").alias("value"))
    return weights.agg(F.to_json(F.struct(F.lit(alpha).alias("alpha"), F.lit(floor).alias("floor"), F.sum("bin_bytes").alias("total_bin_bytes"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("languages"))).alias("manifest"))


def rewrite_paths(manifests: DataFrame, folder: str, suffix: str = "_text_document", c: str = "manifest") -> DataFrame:
    """The manifest with all prefixes below another folder."""
    schema = "alpha double, floor double, total_bin_bytes bigint, languages map<string, struct<prefix string, bin_bytes bigint, natural_p double, weight double>>"
    parsed = manifests.withColumn("_m", F.from_json(c, schema))
    moved = F.transform_values("_m.languages", lambda k, v: v.withField("prefix", F.concat(F.lit(f"{folder}/"), k, F.lit(suffix))))
    return parsed.withColumn(c, F.to_json(F.struct("_m.alpha", "_m.floor", "_m.total_bin_bytes", moved.alias("languages")))).drop("_m")


def table_lines(weights: DataFrame, name: str = "lang") -> DataFrame:
    """A report line for each source: MB, natural and mixture per cent, prefix."""
    line = F.concat(F.rpad(F.col(name), 12, " "), F.format_string(" %10.1f %8.2f%% %8.2f%% %s", F.col("bin_bytes") / 1e6, 100 * F.col("natural_p"), 100 * F.col("weight"), F.col("prefix")))
    return weights.orderBy(F.desc("weight"), name).select(line.alias("value"))
