"""Source adapters: a name, the languages it has, and how to fetch one. Offline, an adapter reads local files."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import languages


@dataclass(frozen=True)
class Adapter:
    name: str
    supported: dict[str, str]
    fetch: Callable[[SparkSession, str], DataFrame]
    gated: bool = False
    note: str = field(default="", compare=False)


REGISTRY: dict[str, Adapter] = {}


def register(adapter: Adapter) -> Adapter:
    REGISTRY[adapter.name] = adapter
    return adapter


def local(name: str, folder: str, supported: dict[str, str] | None = None) -> Adapter:
    """An adapter over Parquet files in a folder for each subset."""
    supported = supported or languages.ADAPTERS["web"]
    return register(Adapter(name, supported, lambda spark, lang: spark.read.parquet(f"{folder}/{supported[lang]}")))


def listed(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a.name, len(a.supported), a.gated) for a in REGISTRY.values()], "adapter string, languages int, gated boolean")


def fetch(spark: SparkSession, adapter: str, langs: list[str], out: str, min_chars: int = 50, max_docs: int | None = None, overwrite: bool = False) -> list[dict]:
    """Canonical rows of each language below ``out``; what one of them has in the way does not stop the others."""
    source, done = REGISTRY[adapter], []
    for lang in langs:
        if lang not in source.supported:
            done.append({"lang": lang, "skipped": "unsupported"})
            continue
        try:
            df = source.fetch(spark, lang)
            have = df.columns
            rows = df.select(T.strip("text").alias("text"), T.resolve_tokens("text", "token_count" if "token_count" in have else None, "tokens" if "tokens" in have else None, "source").alias("token_count")).where(F.length("text") >= min_chars)
            rows = rows.limit(max_docs) if max_docs else rows
            rows.write.mode("overwrite" if overwrite else "ignore").json(f"{out}/lang={lang}")
            stats = spark.read.schema("text string, token_count long").json(f"{out}/lang={lang}").agg(F.count("*"), F.sum(F.length("text")), F.sum("token_count")).first()
            done.append({"lang": lang, "docs": stats[0], "chars": stats[1] or 0, "tokens_approx": stats[2] or 0})
        except Exception as error:  # noqa: BLE001
            done.append({"lang": lang, "error": f"{type(error).__name__}: {str(error)[:300]}"})
    return done
