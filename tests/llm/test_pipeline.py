"""The pipeline's stages on whole tables: what each keeps, and that a folder without the subpackage still imports."""

import os
import shutil
import subprocess
import sys

import corpus_pipeline
from weftline.llm import op5_crf_quality, op6_grace_dedup, op10_simhash_mih

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    docs = docs.unionByName(docs.limit(5))  # repeated rows
    labels = spark.read.parquet(f"{data}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        path = str(tmp_path / str(k))
        stage(spark, docs, data).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "packing":
            assert docs.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
            continue
        assert docs.columns == before.columns and docs.exceptAll(before).count() == 0
        if name == "quality_classifier":
            ids = docs.toPandas()["doc_id"]
            known = labels[labels.index.isin(ids)]
            assert (known == 1).mean() > 0.97 and len(known) >= 0.97 * (labels == 1).sum()
        if name == "exact_dedup":
            assert docs.count() == before.select(op6_grace_dedup.text_sha256("text")).distinct().count()
        if name == "near_dedup":
            groups = op10_simhash_mih.near_groups(before, "doc_id", "text").toPandas()
            assert set(docs.toPandas()["doc_id"]) == set(groups["component_id"])
    assert op5_crf_quality.GOOD == 0.3 and corpus_pipeline.run(spark, data).count() > 0


ROWS = [
    (1, "good words in a line " * 30, "en", "a"), (1, "good words in a line " * 30, "en", "b"), (2, None, "en", "a"), (3, "", None, "a"), (None, "no id here " * 20, "de", None), (None, "no id here " * 20 + "x", "de", None),
    (4, "word " * 60_000, "en", "a"), (5, "tie one two three", "en", "a"), (5, "tie one two three", "en", "a"), (5, "another text of that id", "en", "a"),
]


def edge_docs(spark):
    extra = ("score", "text_sha256", "key", "nth", "root", "text_hash")
    names = "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in extra)
    return spark.createDataFrame([(*r, *(["x"] * len(extra))) for r in ROWS], names)


def test_stages_on_edge_rows(spark, data):
    """Each stage by itself on null, empty and long texts, repeats, ids with several texts, null ids and clashing names; and on no rows."""
    docs = edge_docs(spark)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, data)
        assert stage(spark, docs.where("false"), data).count() == 0
        if name == "packing":
            pieces = got.collect()
            assert sum(r["start"] == 0 for r in pieces) == len(ROWS)
            continue
        assert got.columns == docs.columns and got.exceptAll(docs).count() == 0
        kept = [(r["doc_id"], r["text"], r["source"]) for r in got.collect()]
        if name == "exact_dedup":
            assert len(kept) == 7 and sum(i == 5 for i, _, _ in kept) == 2 and sum(not t for _, t, _ in kept) == 1
        if name == "near_dedup":
            fp = {t: op10_simhash_mih.fingerprint((t or "").encode()) for _, t, _ in kept}
            assert len(set(fp.values())) == len(fp) and {i for i, _, _ in kept} >= {1, 2, 4, 5}


def test_verdicts_are_of_rows(spark, data, monkeypatch):
    """Of two rows with one id and text, that of the source whose estimate rejects it goes, the other stays."""
    docs = edge_docs(spark)
    judged = docs.selectExpr("doc_id as key", "coalesce(lang, '') as lang", "coalesce(source, '') as source", "xxhash64(text) as text_hash", "not (doc_id <=> 1 and source = 'a') as kept")
    monkeypatch.setattr(corpus_pipeline.op3_mcd_rules, "judge", lambda *_: judged)
    got = corpus_pipeline.quality_rules(spark, docs, data).collect()
    assert len(got) == len(ROWS) - 1 and [r["source"] for r in got if r["doc_id"] == 1] == ["b"]


def test_the_rest_stands_alone(tmp_path):
    for name in ("weftline", "__spark_entry__.py"):
        src = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(src) else shutil.copy)(src, tmp_path / name)
    shutil.rmtree(tmp_path / "weftline/llm")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)
