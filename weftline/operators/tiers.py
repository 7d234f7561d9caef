"""Length tiers: specifications, assignment and counts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Lower bound, upper bound (not included) and weight of each preset's tiers.
PRESETS = {
    "lc16k": {"16k_plus": (16384, None, 0.5), "4_16k": (4096, 16384, 0.3), "under4k": (0, 4096, 0.2)},
    "lc128k": {
        "128k_plus": (131072, None, 0.25), "64_128k": (65536, 131072, 0.25), "32_64k": (32768, 65536, 0.20),
        "16_32k": (16384, 32768, 0.15), "4_16k": (4096, 16384, 0.10), "under4k": (0, 4096, 0.05),
    },
    "lc256k": {
        "256k_plus": (262144, None, 0.20), "128_256k": (131072, 262144, 0.25), "64_128k": (65536, 131072, 0.20),
        "32_64k": (32768, 65536, 0.15), "16_32k": (16384, 32768, 0.10), "4_16k": (4096, 16384, 0.07), "under4k": (0, 4096, 0.03),
    },
}
#: The first preset with bounds by 16, for short documents.
SMALL = {"1k_plus": (1024, None, 0.5), "256_1k": (256, 1024, 0.3), "under256": (0, 256, 0.2)}


def normalize(spec: dict) -> dict:
    """Checked tiers whose weights sum to 1. A tier is (least, most or None, weight) or a mapping with min, max, weight."""
    rows = {}
    for name, t in spec.items():
        least, most, weight = (t.get("min", 0), t.get("max"), t["weight"]) if isinstance(t, dict) else t
        least = int(least or 0)
        if least < 0 or (most is not None and int(most) <= least) or weight < 0:
            raise ValueError(f"tier {name!r}: bounds or weight are out of range")
        rows[name] = (least, None if most is None else int(most), float(weight))
    total = sum(w for _, _, w in rows.values())
    if total <= 0:
        raise ValueError("tier weights sum to 0")
    return {k: (a, b, w / total) for k, (a, b, w) in rows.items()}


def load(spark: SparkSession, path: str | None = None, preset: str = "lc16k") -> dict:
    """The tiers of a JSON document, on any path that Spark reads, or of a preset."""
    if path is None:
        if preset not in PRESETS:
            raise ValueError(f"no preset {preset!r}; there are {', '.join(PRESETS)}")
        return normalize(PRESETS[preset])
    return normalize(json.loads(spark.read.text(path, wholetext=True).first()[0]))


def chunk_sizes(text: str | None, spec: dict) -> dict[str, int]:
    """Documents of a chunk by tier, from items tier=number; unknown tiers and numbers below 1 are errors."""
    sizes = {}
    for item in filter(None, (x.strip() for x in (text or "").split(","))):
        tier, _, number = (x.strip() for x in item.partition("="))
        if tier not in spec or not number.isdigit() or int(number) < 1:
            raise ValueError(f"{item!r} is no tier=number of {', '.join(spec)}")
        sizes[tier] = int(number)
    return sizes


def ordered(spec: dict) -> list[tuple]:
    """Tiers by (least, name), descending: the first that fits is taken."""
    return sorted(((n, *t) for n, t in spec.items()), key=lambda t: (t[1], t[0]), reverse=True)


def frame(spark: SparkSession, spec: dict) -> DataFrame:
    return spark.createDataFrame([(n, a, b, w) for n, (a, b, w) in spec.items()], "tier string, min_tokens long, max_tokens long, weight double")


def assign(tokens: str, spec: dict, strict: bool = True) -> Column:
    """The tier of a token count, upper bounds not included; a count that no tier takes is an error, or null."""
    out = None
    for name, least, most, _ in ordered(spec):
        fits = F.col(tokens) >= least if most is None else (F.col(tokens) >= least) & (F.col(tokens) < most)
        out = F.when(fits, F.lit(name)) if out is None else out.when(fits, F.lit(name))
    return out.otherwise(F.raise_error(F.concat(F.lit("no tier takes "), F.col(tokens).cast("string")))) if strict else out


def summary(spec: dict) -> str:
    text = lambda a, b: f">={a}" if b is None else f"<{b}" if not a else f"{a}-{b}"
    return ", ".join(f"{n}: {text(a, b)}" for n, a, b, _ in ordered(spec))


def counts_by_lang(df: DataFrame, lang: str, tier: str, names: list[str]) -> DataFrame:
    """Documents of each tier and their share, a row for each language."""
    wide = df.groupBy(lang).agg(F.count("*").alias("docs"), *[F.count_if(F.col(tier) == n).alias(n) for n in names])
    return wide.withColumns({f"{n}_pct": F.round(100 * F.col(n) / F.col("docs"), 6) for n in names})


def unknown_tiers(chunks: DataFrame, spec: dict) -> DataFrame:
    """Tiers of earlier chunks that the specification lacks: a run must not go on with these."""
    return chunks.select("tier").distinct().where(~F.col("tier").isin(list(spec)))


def tier_report(chunks: DataFrame) -> DataFrame:
    """Chunks and GiB by language and tier with totals."""
    return chunks.rollup("lang", "tier").agg(F.count("*").alias("chunks"), F.round(F.sum("bin_bytes") / F.lit(2.0**30), 9).alias("gib"))


def share_of_rows(df: DataFrame, group: str) -> DataFrame:
    counts = df.groupBy(group).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
