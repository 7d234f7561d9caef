"""Whole runs, composed of operators: what a user of the command line does step by step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions import tokenize as tok
from ..operators import languages, lengths, listing, mixture, packing, tiers
from ..sources import readers
from ..streaming import tiers as streaming


def estimate(spark: SparkSession, folder: str, langs: str | None = None) -> DataFrame:
    """Files and sizes of the languages asked for; a file's language is its folder's name."""
    asked, _ = languages.parse(langs)
    files = readers.listing(spark, folder).withColumn("lang", F.element_at(F.split("path", "/"), -2))
    return listing.estimate(files.where(F.col("lang").isin(asked)).select("lang", "path", "size"))


def convert(spark: SparkSession, paths, out: str, lang: str, max_docs_per_lang: int = 0) -> DataFrame:
    """Stripped, canonical JSON Lines of one language; returns docs, tokens and MB. The limit counts rows before blank ones go."""
    rows = readers.parquet(spark, paths)
    rows = rows.limit(max_docs_per_lang) if max_docs_per_lang else rows
    kept = lengths.canonicalize(rows, count="token_count", policy="sum").withColumn("lang", F.lit(lang))
    sinks.jsonl(kept, out, mode="append")
    return lengths.conversion_summary(readers.jsonl(spark, f"{out}/lang={lang}").withColumn("n_bytes", F.octet_length("text")).withColumn("lang", F.lit(lang)))


def filter_long(spark: SparkSession, folder: str, out: str, least: int = 8192, most: int | None = None) -> DataFrame:
    """Long documents of all languages; returns what came in and went out."""
    from ..functions.text import resolve_tokens

    rows = readers.jsonl(spark, folder).where("text is not null").withColumn("n", resolve_tokens("text", "token_count"))
    sinks.jsonl(lengths.filter_long(rows, "n", least, most).drop("n"), out)
    return lengths.filter_summary(rows, "lang", "n", least, most)


def tokenize(spark: SparkSession, folder: str, out: str, tokenizer: str = "bytes") -> DataFrame:
    """Token ids of canonical JSON Lines, by language."""
    rows = tok.tokenize(readers.jsonl(spark, folder).where("text is not null"), tokenizer=tokenizer)
    rows.select("lang", "tokens", "n_tokens").write.partitionBy("lang").parquet(out)
    return spark.read.parquet(out).groupBy("lang").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))


def mix(sizes: DataFrame, prefix: str, alpha: float = 0.3, floor: float = 0.005, weights: dict[str, float] | None = None) -> DataFrame:
    """Weights of languages by size, or as given, with prefixes for the data path."""
    out = mixture.explicit(mixture.tempered(sizes, alpha=1.0, floor=0), "lang", weights) if weights else mixture.tempered(sizes, alpha=alpha, floor=floor)
    return out.withColumn("prefix", F.concat(F.lit(f"{prefix}/"), "lang", F.lit("_text_document")))


def bundle(docs: DataFrame, langs: list[str], target: int, least: int = 0, most: int = 0, partial: bool = False, per_lang: int | None = None) -> DataFrame:
    """Rows of documents bundled up to a target, from flexible rows."""
    kept = readers.bundle_eligible(docs, langs, least, most).withColumn("ord", F.concat_ws("/", "source", "local_id"))
    assigned = packing.bundles(kept, "lang", "ord", "token_count", target, partial=partial, most=per_lang)
    return packing.bundle_rows(assigned, kept, "lang", "ord", "token_count", target)


def stream(spark: SparkSession, folder: str, out: str, checkpoint: str, preset: str = "lc16k", chunk_docs: int = 10_000, run_id: str = "", texts: str | None = None, bytes_per_batch: int | None = None, whole: bool = False) -> DataFrame:
    """Chunks of new shards by length tier, their texts below ``texts`` if given, and the mixture over all chunks so far; with ``whole`` blank texts count too, and texts as they are. Earlier chunks with other tiers are an error before anything is written."""
    spec = tiers.normalize(tiers.PRESETS[preset])
    if readers.exists(spark, out):
        if strangers := [r["tier"] for r in tiers.unknown_tiers(spark.read.parquet(out), spec).limit(10).collect()]:
            raise ValueError(f"chunks with tiers that {preset} lacks: {strangers}")
    streaming.run(spark, folder, "lang string, text string, token_count long", out, checkpoint, spec, chunk_docs, run_id=run_id, texts=texts, bytes_per_batch=bytes_per_batch, whole=whole)
    chunks = spark.read.parquet(out)
    return mixture.tier_proportional(chunks, tiers.frame(spark, spec))


def run(spark: SparkSession, paths, work: str, lang: str, long_only: bool = False, least: int = 8192) -> DataFrame:
    """Convert, filter if asked to, tokenize and weigh."""
    convert(spark, paths, f"{work}/jsonl", lang)
    source = f"{work}/jsonl"
    if long_only:
        filter_long(spark, source, f"{work}/long", least)
        source = f"{work}/long"
    sizes = tokenize(spark, source, f"{work}/tokens").select("lang", (4 * F.col("tokens")).alias("bin_bytes"))
    return mix(sizes, f"{work}/tokens")
