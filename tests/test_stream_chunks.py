"""Shards as a data source, and chunks by keyed state that survive a restart."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import tiers
from weftline.sources import files, shards
from weftline.streaming import chunks

SPEC = tiers.normalize({"long": (50, None, 1.0), "short": (0, 50, 1.0)})


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Five shards of several row groups each, one of them empty."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    root = tmp_path_factory.mktemp("shards")
    for k, (lang, n) in enumerate([("de", 130), ("de", 0), ("en", 7), ("en", 95), ("fr", 60)]):
        (root / f"lang={lang}").mkdir(exist_ok=True)
        rows = [(f"{lang} {k} {i} " + "é" * (i * 37 % 300), None if i % 3 else i) for i in range(n)]
        pq.write_table(pa.table({"text": pa.array([r[0] for r in rows], pa.string()), "token_count": pa.array([r[1] for r in rows], pa.int64()), "more": pa.array([0] * n)}), root / f"lang={lang}" / f"{k}.parquet", row_group_size=20)
    return str(root)


def expected(spark, folder, size):
    rows = spark.read.format("corpus_shards").load(folder).where("not last").collect()
    places, out = Counter(), set()
    for r in sorted(rows, key=lambda r: (r["shard"], r["row"])):
        n = r["token_count"] if r["token_count"] and r["token_count"] > 0 else max(1, len(r["text"]) // 4)
        key = (r["shard"], r["lang"], "long" if n >= 50 else "short")
        out.add((*key, places[key] // size, r["row"], r["text"], n))
        places[key] += 1
    return out


def test_shards_as_a_table(spark, folder):
    shards.register(spark)
    rows = spark.read.format("corpus_shards").load(folder)
    assert rows.rdd.getNumPartitions() == 7 + 1 + 1 + 5 + 3 and rows.where("last").count() == 5
    assert rows.where("not last").groupBy("lang").count().collect() and rows.where("not last").count() == 292
    one = rows.where("lang = 'en' and not last").orderBy("shard", "row").collect()
    assert [r["row"] for r in one] == [*range(7), *range(95)] and one[3]["text"].startswith("en 2 3 ")
    assert {r["lang"] for r in spark.read.format("corpus_shards").option("langs", "fr, de").load(folder).collect()} == {"fr", "de"}


def test_chunks_are_sent_once_over_a_restart(spark, folder, tmp_path):
    shards.register(spark)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    part = chunks.run(spark, folder, out, checkpoint, SPEC, 13, groups=3, batches=2).count()
    got = chunks.run(spark, folder, out, checkpoint, SPEC, 13, groups=3).collect()
    assert 0 < part < len(got) == 292
    assert {tuple(r) for r in got} == expected(spark, folder, 13)
    # Nothing is new, so nothing is sent again.
    assert chunks.run(spark, folder, out, checkpoint, SPEC, 13, groups=3).count() == 292


def test_a_shard_may_be_a_folder_of_parts(spark, tmp_path):
    """Rows are numbered over the parts, only the last one ends the shard, and a batch of small row groups goes on until it has its bytes."""
    rows = spark.range(400).select(F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), (F.col("id") + 1).alias("token_count"), F.lit("de").alias("lang"), F.lit("all.parquet").alias("shard"))
    folder = str(tmp_path / "in")
    rows.repartitionByRange(4, "token_count").sortWithinPartitions("token_count").write.partitionBy("lang", "shard").parquet(folder)
    shards.register(spark)
    got = spark.read.format("corpus_shards").load(folder).collect()
    assert len({r["shard"] for r in got}) == 1 and {r["lang"] for r in got} == {"de"} and sum(r["last"] for r in got) == 1
    assert sorted((r["row"], r["token_count"]) for r in got if not r["last"]) == [(i, i + 1) for i in range(400)]
    for least, batches in ((0, 4), (1 << 30, 1)):
        made = chunks.run(spark, folder, f"{tmp_path}/out{least}", f"{tmp_path}/checkpoint{least}", SPEC, 13, groups=1, least=least)
        assert sorted((r["tier"], r["chunk"], r["row"]) for r in made.collect()) == sorted([("short", i // 13, i) for i in range(49)] + [("long", (i - 49) // 13, i) for i in range(49, 400)])
        assert len(files.below(f"{tmp_path}/checkpoint{least}/commits")) >= batches
        assert sum(p.rpartition("/")[2].isdigit() for p in files.below(f"{tmp_path}/checkpoint{least}/commits")) in (batches, batches + 1)


def test_a_streams_partitions_have_row_groups_that_follow_one_another(spark, folder, monkeypatch):
    """A batch has a task for so many bytes, not for each row group, and the same rows."""
    import json

    stream = shards._Stream({"path": folder, "after": json.dumps({"shard": "", "group": 0})})
    one, end = {"shard": "", "group": 0}, stream.latestOffset()
    parts = stream.partitions(one, end)
    assert len(parts) < 16 and sum(p.n for p in parts) == 7 + 1 + 5 + 3 + 1 and sum(p.last for p in parts) == 5
    rows = [r for p in parts for b in stream.read(p) for r in b.to_pylist()]
    assert [(r["shard"], r["row"], r["last"]) for r in rows] == [(r["shard"], r["row"], r["last"]) for g in shards._Reader({"path": folder}).partitions() for b in shards._rows(g) for r in b.to_pylist()]
    # Row groups beyond the bytes are partitions of their own; a batch that begins or ends in a file has its own row groups only.
    monkeypatch.setattr(shards, "SPAN", 1)
    assert len(stream.partitions(one, end)) == 17
    monkeypatch.undo()
    shard = stream.shards.names()[0]
    part = stream.partitions({"shard": shard, "group": 2}, {"shard": shard, "group": 5})
    assert [(p.group, p.n, p.first, p.last) for p in part] == [(2, 3, 40, False)]


def test_state_stores_are_as_many_as_cores_at_most(spark, folder, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        got = chunks.run(spark, folder, f"{tmp_path}/out", f"{tmp_path}/checkpoint", SPEC, 13, groups=30)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "50" and got.count() == 292
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stores = {p.split("/state/0/")[1].split("/")[0] for p in files.below(f"{tmp_path}/checkpoint") if "/state/0/" in p}
    assert 0 < sum(map(str.isdigit, stores)) <= spark.sparkContext.defaultParallelism
