"""Operators whose semantics go beyond their queries: edges, folds, sources, sinks and streams."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline import sinks
from weftline.operators import evaluation, lengths, listing, mixture, packing, retrieval, tiers, vectors
from weftline.operators.ordered import prefix_by_value
from weftline.sources import adapters, indexed, readers
from weftline.streaming import tiers as streaming


def test_tier_bounds_and_gaps(spark):
    spec = tiers.normalize(tiers.PRESETS["lc16k"])
    rows = spark.createDataFrame([(0,), (4095,), (4096,), (16383,), (16384,)], "t long")
    assert [r[0] for r in rows.select(tiers.assign("t", spec)).collect()] == ["under4k", "under4k", "4_16k", "4_16k", "16k_plus"]
    gap = {"a": (0, 10, 1.0), "b": (20, None, 1.0)}
    with pytest.raises(Exception, match="no tier takes"):
        spark.createDataFrame([(15,)], "t long").select(tiers.assign("t", gap)).collect()
    overlap = {"a": (0, 100, 1.0), "b": (50, 100, 1.0)}
    assert spark.createDataFrame([(60,)], "t long").select(tiers.assign("t", overlap)).first()[0] == "b"
    for bad in ({"a": (5, 5, 1.0)}, {"a": (-1, None, 1.0)}, {"a": (0, None, 0.0)}):
        with pytest.raises(ValueError):
            tiers.normalize(bad)
    assert tiers.summary(spec) == "16k_plus: >=16384, 4_16k: 4096-16384, under4k: <4096"


def test_filter_includes_both_ends(spark):
    rows = spark.createDataFrame([(9,), (10,), (20,), (21,)], "t long")
    assert [r[0] for r in lengths.filter_long(rows, "t", 10, 20).collect()] == [10, 20]


def test_nearest_rank_takes_the_upper_middle(spark):
    rows = spark.createDataFrame([("a", v) for v in (4, 1, 3, 2)] + [("b", 7)], "g string, v long")
    got = {r["g"]: (r["p50"], r["p90"]) for r in lengths.nearest_rank(rows, "g", "v").collect()}
    assert got == {"a": (3, 4), "b": (7, 7)}


@pytest.mark.parametrize("sizes, alpha, floor", [([10, 0, 30], 0.3, 0.005), ([0, 0], 0.3, 0.005), ([5, 15], 0.0, 0.0), ([1, 999], 1.0, 0.2)])
def test_tempered(spark, sizes, alpha, floor):
    got = [r["weight"] for r in mixture.tempered(spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i int, bin_bytes long"), alpha=alpha, floor=floor).orderBy("i").collect()]
    total = sum(sizes)
    if not total:
        assert got == [0, 0]
        return
    r = [(s / total) ** alpha if s else 0 for s in sizes]
    w = [x / sum(r) for x in r]
    if floor:
        w = [max(x, floor) for x in w]
        w = [x / sum(w) for x in w]
    assert np.allclose(got, w)


def fold(tokens, target):
    out, total, bundle = [], 0, 0
    for t in tokens:
        total += t
        out.append(bundle)
        if total >= target:
            total, bundle = 0, bundle + 1
    return out, bundle


@pytest.mark.parametrize("tokens", [[5], [100], [3, 3, 4, 9, 1, 10, 2], [1] * 37, [0, 0, 10, 0], []])
def test_bundles_are_the_fold(spark, tokens):
    df = spark.createDataFrame([("x", i, t) for i, t in enumerate(tokens)], "lang string, o long, t long")
    want, full = fold(tokens, 10)
    got = packing.bundles(df, "lang", "o", "t", 10, partial=True).orderBy("o").collect()
    assert [r["bundle"] for r in got] == want and [r["full"] for r in got] == [b < full for b in want]
    assert packing.bundles(df, "lang", "o", "t", 10).count() == sum(b < full for b in want)
    assert packing.bundles(df, "lang", "o", "t", 10, most=1).count() == sum(b < min(full, 1) for b in want)


def test_bundles_in_blocks_and_many_targets(spark):
    df = spark.createDataFrame([("x", i, 4) for i in range(20)], "lang string, o long, t long")
    assert packing.bundles(df, "lang", "o", "t", 8, block=5).count() == 16
    got = packing.bundles_many(df, "lang", "o", "t", [4, 8], 2).groupBy("target_tokens").agg(F.count("*"), F.count_distinct("bundle")).orderBy("target_tokens").collect()
    assert [tuple(r) for r in got] == [(4, 2, 2), (8, 4, 2)]


def test_prefix_sums(spark):
    rows = spark.createDataFrame([(i * 7 % 101, i) for i in range(101)], "o long, v long")
    got = prefix_by_value(rows, "o", "v", "p", 8).orderBy("o").collect()
    total = 0
    for r in got:
        assert r["p"] == total
        total += r["v"]


def test_swapped_trial_has_the_truth_once(spark):
    row = spark.createDataFrame([(["a", "b", "c", "d", "e"], "b")], "v array<string>, t string")
    for swapped in (False, True):
        got = row.select(retrieval.trial("v", "t", 3, 4, swapped).alias("x")).first()["x"]
        assert len(set(got["candidates"])) == len(got["candidates"]) == 4
        assert got["candidates"][got["true_idx"]] == got["true_value"] and (got["true_value"] == "b") != swapped


def test_curriculum(spark):
    cases = retrieval.grid(spark, 16, ["en", "de", "fr", "es"], [1024])
    got = retrieval.curriculum(cases, retrieval.template_frame(spark), seed=1).collect()
    for r in got:
        assert r["text"].count(f"{r['answer']}") >= 1 and abs(r["estimated_tokens"] - 1024) < 600
        if r["task"] == "single_key":
            assert r["text"].count(r["answer"]) == 2  # in the evidence and in the answer
        if r["task"] == "aggregation":
            assert r["text"].count("[ALERT]") == int(r["answer"])
    assert {r["task"] for r in got} == set(retrieval.TASKS)
    ids = spark.range(1).select(retrieval.byte_example(F.lit("x" * 50), F.lit("EV"), F.lit("y"), F.lit("Q?"), 40)).first()[0]
    assert len(ids) == 40 and ids[-1] == 1


def test_causal_topk_is_brute_force(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(-2, 3, (40, 5)).astype(float)
    df = spark.createDataFrame([(i, [float(x) for x in v[i]]) for i in range(40)], "id long, v array<float>")
    got = {}
    for r in vectors.topk(df, "id", "v", 3, pad=True).collect():
        got.setdefault(r["query"], {})[r["rank"]] = r["key"]
    for q in range(40):
        order = sorted(range(q + 1), key=lambda k: (-(v[q] @ v[k]), k))[:3]
        assert [got[q][k] for k in (1, 2, 3)] == order + [-1] * (3 - len(order))
    pattern = vectors.layer_pattern(spark.createDataFrame([(0, 0.9), (1, 0.2), (2, 0.8), (3, 0.1)], "l int, m double"), "l", "m", 0.5)
    assert pattern.first()[0] == "SFSF"


def test_scores_and_choice(spark):
    df = spark.createDataFrame([("the code is 1234567", ["7654321", "1234567"], 1)], "p string, c array<string>, true_idx int")
    assert evaluation.forced_choice(evaluation.score_candidates(df, "p", "c", evaluation.byte_overlap)).first()["correct"]


def test_readers(spark, tmp_path):
    path = str(tmp_path / "a.jsonl")
    with open(path, "w") as f:
        f.write('{"text": "é", "token_count": 3}\n\n{"text": "b"\n{"text": "c", "token_count": 5.5}\n')
    got = readers.jsonl(spark, path, "text string, token_count string").where("text is not null").collect()
    assert [r["text"] for r in got] == ["é", "c"]
    with pytest.raises(Exception):
        readers.jsonl(spark, path, strict=True).collect()
    flex = readers.flexible(spark.createDataFrame([(" x ", None, 4, "/d/fr_0.parquet"), ("", "yy", None, "/d/none.parquet")], "text string, content string, tokens long, path string"), ["fr"], "path").orderBy("text").collect()
    assert [(r["text"], r["lang"], r["token_count"]) for r in flex] == [("x", "fr", 4), ("yy", "unknown", 1)]
    assert readers.flexible(spark.range(2), []).count() == 0


def test_index_round_trip(spark, tmp_path):
    indexed.register(spark)
    out = str(tmp_path / "tok")
    rows = [([1, 2, 3],), ([],), ([70000],), ([5, 6],)]
    spark.createDataFrame(rows, "tokens array<int>").coalesce(2).write.format("indexed_tokens").mode("append").save(out)
    got = spark.read.format("indexed_tokens").option("tokens", "true").load(out)
    assert sorted(r["tokens"] or [] for r in got.collect()) == sorted(r[0] for r in rows)
    kind, lengths_, offsets = indexed.read_index(indexed.write_index([3, 0, 2]))
    assert kind == np.int32 and lengths_.tolist() == [3, 0, 2] and offsets.tolist() == [0, 12, 12]
    with pytest.raises(ValueError):
        indexed.read_index(b"x" * 60)


def test_listing_and_package(spark, tmp_path):
    bins, mix = tmp_path / "bin", tmp_path / "mix"
    bins.mkdir(), mix.mkdir()
    for name, n in (("de_text_document.bin", 5), ("de_text_document.idx", 1), ("fr_text_document.bin", 9)):
        (bins / name).write_bytes(b"x" * n)
    files = readers.listing(spark, str(bins))
    assert [(r["lang"], r["bin_bytes"]) for r in listing.token_pairs(files).collect()] == [("de", 5)]
    (mix / "data_mix.json").write_text("{}")
    table = sinks.package(spark, str(bins), str(mix), str(tmp_path / "out"), {"a": 1})
    assert sorted(table) == ["bin/de_text_document.bin", "bin/de_text_document.idx", "bin/fr_text_document.bin", "manifests/build_info.json", "mix/data_mix.json"]
    assert json.loads((tmp_path / "out/manifests/checksums.json").read_text()) == table


def test_waiting_and_commits():
    assert [sinks.wait_seconds(m, 3) for m in ("429 Retry after 12 seconds", "rate limit, about 1 hour", "503 Service Unavailable", "429", "no such file")] == [42, 3700, 360, 180, None]
    failures, waits = iter(["429", "504 Gateway Timeout"]), []

    def upload():
        if (m := next(failures, None)) is not None:
            raise RuntimeError(m)

    assert sinks.commit(upload, sleep=waits.append) == 3 and waits == [60, 240]
    with pytest.raises(RuntimeError):
        sinks.commit(lambda: (_ for _ in ()).throw(RuntimeError("gone")))


def test_specs(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"a": {"min": 10, "weight": 3}, "b": {"max": 10, "weight": 1}}')
    assert tiers.load(spark, str(tmp_path / "t.json")) == {"a": (10, None, 0.75), "b": (0, 10, 0.25)}
    assert tiers.chunk_sizes("a=3, b=4,", {"a": 0, "b": 0}) == {"a": 3, "b": 4}
    for bad in ("c=1", "a", "a=0"):
        with pytest.raises(ValueError):
            tiers.chunk_sizes(bad, {"a": 0})


def test_bundle_files_and_merge(spark, tmp_path):
    indexed.register(spark)
    rows = spark.createDataFrame([("t1", "de", 8), ("t2", "de", 8), ("t3", "fr", 16)], "text string, lang string, target_tokens long")
    got = sinks.bundle_files(rows, str(tmp_path), "p", "train", {"kept_docs": 3})
    assert got["counts"] == {"de_8": 2, "fr_16": 1} and json.loads((tmp_path / "p_train_manifest.json").read_text())["kept_docs"] == 3
    sinks.merged(spark.createDataFrame([([1, 2],), ([3],)], "tokens array<int>"), str(tmp_path / "m"))
    assert sum(n.endswith(".idx") for n in os.listdir(tmp_path / "m")) == 1


def test_adapters(spark, tmp_path):
    spark.createDataFrame([("a" * 60,), ("short",), (None,)], "text string").write.parquet(str(tmp_path / "src/deu_Latn"))
    adapters.local("disk", str(tmp_path / "src"))
    got = adapters.fetch(spark, "disk", ["de", "fr", "xx"], str(tmp_path / "out"))
    assert got[0] == {"lang": "de", "docs": 1, "chars": 60, "tokens_approx": 15} and "error" in got[1] and got[2]["skipped"] == "unsupported"
    assert adapters.listed(spark).count() == 1


def test_stream_takes_each_shard_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    spec = tiers.normalize({"long": (10, None, 1.0), "short": (0, 10, 1.0)})
    schema = "lang string, text string, token_count long"

    def shard(k):
        rows = [("de", f"text {k} {i}" if i % 5 else " ", i) for i in range(20)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    shard(0)
    streaming.run(spark, src, schema, out, ck, spec, 4)
    first = {tuple(r) for r in spark.read.parquet(out).select("name", "docs").collect()}
    shard(1)
    streaming.run(spark, src, schema, out, ck, spec, 4)
    rows = spark.read.parquet(out).select("name", "docs").collect()
    assert len(rows) == 2 * len(first) == len({r["name"] for r in rows}) and first <= {tuple(r) for r in rows}
    assert sum(r["docs"] for r in rows) == 32
    streaming.run(spark, src, schema, out, str(tmp_path / "ck2"), spec, 4)  # all over again: nothing is made twice
    assert spark.read.parquet(out).count() == len(rows)


def test_stream_writes_texts_and_takes_up_where_it_failed(spark, tmp_path):
    src, out, texts = (str(tmp_path / x) for x in ("src", "out", "texts"))
    spec = tiers.normalize({"long": (10, None, 1.0), "short": (0, 10, 1.0)})
    schema = "lang string, text string, token_count long"
    spark.createDataFrame([("de", f"text {i}" if i % 5 else " ", i) for i in range(20)], schema).coalesce(1).write.parquet(src)
    read = lambda: sorted(r[0] for r in spark.read.schema("text string").json(texts).collect())
    want = sorted(f"text {i}" for i in range(20) if i % 5)
    streaming.run(spark, src, schema, out, str(tmp_path / "ck"), spec, 4, texts=texts)
    assert read() == want
    # The manifest of a killed run is gone, its texts are there: the next run replaces them.
    import shutil

    shutil.rmtree(out)
    streaming.run(spark, src, schema, out, str(tmp_path / "ck2"), spec, 4, texts=texts)
    assert read() == want and spark.read.parquet(out).agg(F.sum("docs")).first()[0] == len(want)


def test_stream_keeps_shards_whose_numbers_collide(spark, tmp_path):
    src, out = (str(tmp_path / x) for x in ("src", "out"))
    spec = tiers.normalize({"long": (10, None, 1.0), "short": (0, 10, 1.0)})
    schema = "lang string, text string, token_count long"
    spark.createDataFrame([("de", "text", 5)], schema).coalesce(1).write.parquet(f"{tmp_path}/one")
    file = next((tmp_path / "one").glob("*.parquet"))
    # Two paths of one number, found by the numbers of many.
    names = spark.range(2000).select(F.format_string("p%d.parquet", "id").alias("name"))
    head = spark.read.parquet(f"{tmp_path}/one").select("_metadata.file_path").first()[0].rsplit("/one/", 1)[0]
    number = F.pmod(F.xxhash64(F.concat(F.lit(f"{head}/src/"), "name")), F.lit(10_000))
    pair = names.groupBy(number).agg(F.array_sort(F.collect_list("name")).alias("names")).where("size(names) > 1").first()["names"][:2]
    for k, name in enumerate(pair):
        (tmp_path / "src").mkdir(exist_ok=True)
        (tmp_path / "src" / name).write_bytes(file.read_bytes())
        streaming.run(spark, src, schema, out, str(tmp_path / "ck"), spec, 4)
        rows = spark.read.parquet(out).collect()
        assert len(rows) == k + 1 == sum(r["docs"] for r in rows) and len({r["shard"] for r in rows}) == 1
    streaming.run(spark, src, schema, out, str(tmp_path / "ck2"), spec, 4)
    assert spark.read.parquet(out).count() == 2


def test_event_stream_is_the_table(spark, data, tmp_path):
    events = spark.read.parquet(f"{data}/events.parquet")
    want = streaming.event_windows(events, "1 day").count()
    os.makedirs(tmp_path / "in")
    events.orderBy("ts").coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "in/a"))
    stream = streaming.event_windows(spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")), "1 day")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("by_day").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("by_day").count() == want
