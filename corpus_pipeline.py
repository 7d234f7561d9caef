"""From raw documents to packed training sequences, in five stages.

Each stage takes all that the one before it kept, written as Parquet and read
again. All but the last return the columns of the documents as they came, of
any number and name. Rows are told apart by id, text and what else a verdict
rests on, so rows that repeat an id with other texts are judged on their own,
and so are rows without an id. Null and empty texts are judged as empty ones,
very long ones whole; an empty table passes through all stages as such.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.llm import op3_mcd_rules, op5_crf_quality, op6_grace_dedup, op8_linear_grouping, op10_simhash_mih, tokens
from weftline.llm.common import work_folder, written


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, learnt from the labelled ones, scores as good."""
    model = op5_crf_quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = _unused(docs, "score")
    return op5_crf_quality.score(docs, "text", model, name).where(F.col(name) >= op5_crf_quality.GOOD).drop(name)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the base limits and near their language's and source's robust estimate."""
    judged = op3_mcd_rules.judge(docs, "doc_id", "text")
    # Rows that agree in all of these have one verdict.
    gone = judged.where(~F.col("kept")).select("key", "lang", "source", "text_hash").distinct()
    same = docs["doc_id"].eqNullSafe(gone["key"]) & (F.xxhash64(docs["text"]) == gone["text_hash"])
    for name in ("lang", "source"):
        same &= F.coalesce(docs[name].cast("string"), F.lit("")) == gone[name]
    return docs.join(gone, same, "left_anti")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts; of rows that repeat a document, one."""
    kept = op6_grace_dedup.exact_groups(docs, "doc_id", "text").where("kept").select("key", "text_sha256")
    sha, nth = _unused(docs, "text_sha256"), _unused(docs, "nth")
    named = docs.withColumn(sha, op6_grace_dedup.text_sha256("text"))
    stay = named.join(kept, named["doc_id"].eqNullSafe(kept["key"]) & (named[sha] == kept["text_sha256"]), "left_semi")
    once = F.row_number().over(Window.partitionBy("doc_id", sha).orderBy(F.length("text").desc()))
    return stay.withColumn(nth, once).where(F.col(nth) == 1).drop(sha, nth)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document with the smallest id; of several texts with that id, one."""
    rows = op10_simhash_mih.near_rows(docs, "doc_id", "text")
    first = F.min(F.struct(F.col("key").isNull().alias("last"), "key", "text_hash")).alias("first")
    kept = rows.groupBy("root").agg(first).select("first.key", "first.text_hash").distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["key"]) & (F.xxhash64(docs["text"]) == kept["text_hash"]), "left_semi")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each in its sequence."""
    packed = op8_linear_grouping.pack_documents(docs, "doc_id", "text", tokens.vocabulary("word_bpe_49k.json"))
    return packed.withColumnRenamed("doc", "doc_id")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: The classifier, the estimates and the packing are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over all documents."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), work_folder(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"{folder}/{k}-{name}")
    return docs
