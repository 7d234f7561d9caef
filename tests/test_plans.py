"""Whole runs on small files."""

from pyspark.sql import functions as F

from weftline.functions import tokenize as tok
from weftline.plans import corpus


def test_run_and_stream(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = [(" é text " * 10, 5000), ("  ", 3), ("b" * 80, None), ("long " * 50, 9000)]
    spark.createDataFrame(rows, "text string, token_count long").coalesce(1).write.parquet(src)
    mixed = corpus.run(spark, src, str(tmp_path / "work"), "de", long_only=True, least=4096).collect()
    assert [(r["lang"], r["weight"]) for r in mixed] == [("de", 1.0)] and mixed[0]["prefix"].endswith("/tokens/de_text_document")
    assert spark.read.parquet(str(tmp_path / "work/tokens")).count() == 2
    spark.createDataFrame([("de", *r) for r in rows], "lang string, text string, token_count long").withColumn("token_count", F.coalesce("token_count", F.lit(1))).write.parquet(str(tmp_path / "in"))
    weights = corpus.stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")).groupBy("tier").agg(F.round(F.sum("weight"), 6).alias("w")).collect()
    assert {r["tier"]: r["w"] for r in weights} == {"4_16k": 0.3, "under4k": 0.2}


def test_stream_stops_before_it_writes(spark, tmp_path):
    import pytest

    out = str(tmp_path / "out")
    spark.createDataFrame([("de", "text", 5)], "lang string, text string, token_count long").write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("strange",)], "tier string").write.parquet(out)
    with pytest.raises(ValueError, match="strange"):
        corpus.stream(spark, str(tmp_path / "in"), out, str(tmp_path / "ck"))
    assert spark.read.parquet(out).count() == 1 and not (tmp_path / "ck").exists()


def test_tokenizer_registry(spark):
    tok.register("lengths", lambda: lambda texts: [[len(w) for w in t.split()] for t in texts])
    got = tok.tokenize(spark.createDataFrame([("ab c",), (None,)], "text string"), tokenizer="lengths", end=0, least=1).collect()
    assert [r["tokens"] for r in got] == [[2, 1, 0], [0]]


def test_bundle(spark):
    docs = spark.createDataFrame([("a " * 9, "de", 6, "s", str(i), "d") for i in range(5)], "text string, lang string, token_count long, source string, local_id string, doc_id string")
    got = corpus.bundle(docs, ["de"], 10, partial=True).orderBy("pack_id").collect()
    assert [(r["source_doc_count"], r["partial"]) for r in got] == [(2, False), (2, False), (1, True)]
    assert got[0]["text"].count("===== DOCUMENT BOUNDARY =====") == 2
