"""Chunks' texts in a file each, against Spark's own reader and writer."""

import pytest
from pyspark.sql import functions as F

from weftline import sinks


def test_chunk_texts(spark, tmp_path):
    odd = ['a"b\\', "x\ny z", "é 日", "  ", None, "t" * 200_000]
    langs = ["en", "a=b/c%d", "é ñ", "", None]
    rows = [(lang, "t" + str(k % 2), k // 3, k % 2, f"{t}" if t is None or not t.strip() else f"{t}{k}") for k, t in enumerate(odd * 2) for lang in langs]
    rows = [(lang, tier, shard, chunk, None if text == "None" else text) for lang, tier, shard, chunk, text in rows]
    df = spark.createDataFrame(rows, "lang string, tier string, shard long, chunk int, text string").repartition(3)
    mine, plain = f"{tmp_path}/mine", f"{tmp_path}/plain"
    sinks.chunk_texts(df, mine)
    df.where(F.trim("text") != "").write.partitionBy("lang", "tier", "shard", "chunk").json(plain)
    kinds = "text string, lang string, tier string, shard long, chunk int"
    rows_of = lambda x: sorted(map(tuple, x.select("text", "lang", "tier", "shard", "chunk").collect()), key=str)
    want = rows_of(spark.read.schema(kinds).json(plain))
    assert len(want) == 40
    assert rows_of(spark.read.schema(kinds).json(mine)) == rows_of(sinks.chunk_rows(spark, mine)) == rows_of(sinks.chunk_rows(spark, plain)) == want
    assert {p.relative_to(mine).parent for p in tmp_path.joinpath("mine").rglob("*.json")} == {p.relative_to(plain).parent for p in tmp_path.joinpath("plain").rglob("*.json")}
    with pytest.raises(FileExistsError):
        sinks.chunk_texts(df, mine)
    sinks.chunk_texts(df, mine, "append")
    assert len(rows_of(sinks.chunk_rows(spark, mine))) == 80
    assert not list(tmp_path.joinpath("mine").rglob("*.tmp"))


def test_no_rows(spark, tmp_path):
    sinks.chunk_texts(spark.createDataFrame([("en", "t", 1, 1, " ")], "lang string, tier string, shard long, chunk int, text string"), f"{tmp_path}/none")
    assert sinks.chunk_rows(spark, f"{tmp_path}/none").count() == 0
