"""Sources and sinks beyond their queries: logs that commit once, ranges of files, failures, many files, numbered lines."""

import hashlib
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from weftline import sinks
from weftline.plans import experiments, tokenizing
from weftline.sources import files, indexed, readers, result_log

LOG = "i long, g string"


def rows_of(spark, log):
    return sorted((r["i"], r["g"]) for r in experiments.results(spark, log, LOG).collect())


def test_a_batch_that_runs_again_leaves_one_copy(spark, tmp_path):
    """The stream's own note that a batch is done is lost, as when the driver stops between the log's commit and it."""
    result_log.register(spark)
    src, log, checkpoint = (str(tmp_path / x) for x in ("src", "log", "checkpoint"))
    rows = [(i, "ab"[i % 2] if i % 5 else None) for i in range(40)]
    spark.createDataFrame(rows, LOG).repartition(4).write.parquet(src)

    def run():
        stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 2).parquet(src)
        stream.writeStream.format("result_log").option("path", log).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

    run()
    want = sorted(map(tuple, rows), key=str)
    assert sorted(rows_of(spark, log) if all(g for _, g in rows) else [(r["i"], r["g"]) for r in experiments.results(spark, log, LOG).collect()], key=str) == want
    before = len(files.below(f"{log}/data"))
    last = max(os.listdir(f"{checkpoint}/commits"), key=lambda n: int(n) if n.isdigit() else -1)
    for name in (last, f".{last}.crc"):
        os.unlink(f"{checkpoint}/commits/{name}")
    run()
    assert sorted([(r["i"], r["g"]) for r in experiments.results(spark, log, LOG).collect()], key=str) == want
    assert len(files.below(f"{log}/data")) == before


def test_commits_are_whole_or_nothing(spark, tmp_path):
    result_log.register(spark)
    log = str(tmp_path / "log")
    frame = lambda *r: spark.createDataFrame(list(r), LOG)
    for batch, rows in (("a", [(1, "x"), (2, "x")]), ("b", [(3, "y")]), ("a", [(1, "x"), (2, "x")])):
        frame(*rows).write.format("result_log").option("path", log).option("batch", batch).mode("append").save()
    frame((9, "z")).where("false").write.format("result_log").option("path", log).option("batch", "none").mode("append").save()
    assert rows_of(spark, log) == [(1, "x"), (2, "x"), (3, "y")]
    with pytest.raises(Exception):
        frame((4, "x"), (0, "x")).repartition(2).select((F.col("i") / F.when(F.col("i") != 0, 1).otherwise(F.raise_error("gone").cast("int"))).cast("long").alias("i"), "g").write.format("result_log").option("path", log).option("batch", "c").mode("append").save()
    # A file that no commit names is not read.
    shutil.copy(files.below(f"{log}/data")[0], f"{log}/data/stray.parquet")
    assert rows_of(spark, log) == [(1, "x"), (2, "x"), (3, "y")]
    assert rows_of(spark, str(tmp_path / "none")) == []


def test_queue_knows_fractions_and_nulls(spark):
    cases = spark.createDataFrame([("a", 0.1, 1), ("a", 0.30000000004, 1), (None, 0.5, 2), ("b", 0.7, 2)], "g string, depth double, e int")
    done = spark.createDataFrame([("a", 0.1), ("a", 0.3), ("b", 0.7)], "g string, depth double")
    assert [(r["g"], r["depth"]) for r in experiments.remaining(cases, done, ["g", "depth"]).collect()] == [(None, 0.5)]
    assert sorted((r["e"], r["cases"], r["left"], r["finished"]) for r in experiments.finished(cases, done, "e", ["g", "depth"]).collect()) == [(1, 2, 0, True), (2, 2, 1, False)]


@pytest.mark.parametrize("piece", [1, 7, 1000])
def test_lines_of_ranges(tmp_path, piece):
    """Each line is in the range in which it begins, whatever the ranges."""
    rng = random.Random(piece)
    for k in range(30):
        data = b"".join(rng.choice([b"", b"a", b"bc" * rng.randint(0, 20)]) + rng.choice([b"\n", b"\n\n", b"\r\n"]) for _ in range(rng.randint(0, 12))) + rng.choice([b"", b"end"])
        path = tmp_path / f"{k}.jsonl"
        path.write_bytes(data)
        want, at = [], 0
        for line in data.split(b"\n")[: None if not data.endswith(b"\n") and data else -1]:
            want.append((at, line))
            at += len(line) + 1
        for span in (1, 3, 10, 10_000):
            got = [x for start in range(0, max(len(data), 1), span) for x in tokenizing._lines(str(path), start, start + span, piece)]
            assert got == want


def test_one_bad_file_does_not_end_the_run(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    src, out = tmp_path / "src", str(tmp_path / "out")
    (src / "sub dir").mkdir(parents=True)
    (src / "a.jsonl").write_text('{"text": "é"}\n\n{"text": null}\n{"text": "abc"}')
    (src / "b.jsonl").write_text('{"text": "fine"}\n{"text": broken\n' + '{"text": "more"}\n' * 3000)
    (src / "c.json").write_text('{"other": 1}\n')
    pq.write_table(pa.table({"text": ["x", None, "yz"], "n": [1, 2, 3]}), src / "sub dir/d+e.parquet", row_group_size=2)
    (src / "f.parquet").write_bytes(b"PAR1 no")
    pq.write_table(pa.table({"n": [1]}), src / "g.parquet")
    (src / "note.txt").write_text("not read")
    tokenizing.tokenize_files(spark, str(src), out, span=512)
    name = lambda path: path.rpartition("/")[2]
    assert sorted((name(r["path"]), r["tokens"]) for r in tokenizing.tokenized(spark, out).collect()) == sorted([("a.jsonl", [197, 171, 1]), ("a.jsonl", [1]), ("a.jsonl", [99, 100, 101, 1]), ("d+e.parquet", [122, 1]), ("d+e.parquet", [1]), ("d+e.parquet", [123, 124, 1])])
    bad = {name(r["path"]): r["error"] for r in tokenizing.failures(spark, out).collect()}
    assert sorted(bad) == ["b.jsonl", "c.json", "f.parquet", "g.parquet"] and "byte 17" in bad["b.jsonl"] and "KeyError" in bad["c.json"]
    plan = {name(r["path"]): r for r in tokenizing.dry_run(spark, str(src)).collect()}
    assert plan["d+e.parquet"]["rows"] == 3 and plan["d+e.parquet"]["groups"] == 2 and plan["f.parquet"]["error"] and plan["a.jsonl"]["rows"] is None and "note.txt" not in plan


def test_vocabularies_by_their_files(spark):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    from weftline.functions import tokenize as tok

    texts = ["Hello  world", "", None, "naïve 日本 🙂"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for file, encode in (("byte_bpe_50k.json", lambda p: lambda t: Tokenizer.from_file(p).encode(t, add_special_tokens=False).ids), ("piece_bpe_32k.model", lambda p: sentencepiece.SentencePieceProcessor(model_file=p).encode)):
        path = public_tokenizers.path(file)
        got = {r["text"]: r["tokens"] for r in tok.tokenize(df, tokenizer=path, end=0).collect()}
        assert got == {t: [*encode(path)(t or ""), 0] for t in texts}


def test_token_files_by_key(spark, tmp_path):
    indexed.register(spark)
    out = str(tmp_path / "tok")
    rows = [(lang, tier, [k, len(str(lang))]) for k in range(60) for lang in ("de", "e/n", None) for tier in ("a", "b") if (k + len(tier)) % 3]
    df = spark.createDataFrame(rows, "lang string, tier string, tokens array<int>").repartition(5)
    some = df.where("tier = 'a'")
    first = sinks.merged_by(some, out)
    assert len(first) == 3 and sinks.merged_by(some, out) == []
    second = sinks.merged_by(df, out)
    assert len(second) == 3 and not set(first) & set(second)
    back = spark.read.format("indexed_tokens").option("tokens", True).load(out).collect()
    assert sorted(r["tokens"] for r in back) == sorted(t for *_, t in rows)
    assert len(files.below(out, ".tmp")) == 0


def test_many_files_are_one_scan_for_each_set_of_columns(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "in").mkdir()
    for k in range(60):
        name = tmp_path / "in" / f"de_{k:03d} x+y%.parquet"
        kind = k % 3
        table = {"text": [f"text {k} {i}" for i in range(k % 5)]} if kind == 0 else {"content": [f"text {k} {i}" for i in range(k % 5)], "id": [""] * (k % 5), "other": [1] * (k % 5)} if kind == 1 else {"other": [k]}
        pq.write_table(pa.table(table), name)
    paths = readers.discover(spark, [f"{tmp_path}/in/*.parquet"])
    got = readers.flexible_parquet(spark, paths, ["de"])
    # Files without rows have a type of their own.
    assert got._jdf.queryExecution().optimizedPlan().toString().count("parquet") <= 2 * 5
    first, want = 0, []
    for k in range(60):
        want += [(f"text {k} {i}", str(first + i), "de") for i in range(k % 5) if k % 3 < 2]
        first += k % 5 if k % 3 < 2 else 1
    assert sorted((r["text"], r["local_id"], r["lang"]) for r in got.collect()) == sorted(want)
    assert readers.flexible_parquet(spark, [], ["de"]).count() == 0


def test_lines_are_numbered_over_a_files_stretches(spark, tmp_path):
    rng = random.Random(1)
    want = []
    for k in range(3):
        lines = ["" if rng.random() < 0.2 else f"{k} {i} " + "x" * rng.randint(0, 200) for i in range(400)]
        (tmp_path / f"{k} f.txt").write_text("\n".join(lines))
        want += [(k, i, line) for i, line in enumerate(lines)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = readers.numbered_lines(spark, [str(tmp_path)])
        assert got.rdd.getNumPartitions() >= 1 and sorted((int(r["path"].rpartition("/")[2][0]), r["line"], r["value"]) for r in got.collect()) == want
        (tmp_path / "docs.jsonl").write_text("".join(f'{{"text": "same opening"}}\n\n' for _ in range(200)) + '{"text": "own", "id": "i7"}\nbroken\n')
        rows = readers.documents(spark, "jsonl", [f"{tmp_path}/docs.jsonl"], []).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["local_id"] for r in rows) == sorted([*[str(2 * k) for k in range(200)], "i7"]) and len({r["doc_id"] for r in rows}) == 201


def test_digests_in_pieces(tmp_path):
    import pyarrow as pa

    data = random.Random(0).randbytes(300_000)
    (tmp_path / "x").write_bytes(data)
    (tmp_path / "empty").write_bytes(b"")
    batch = pa.RecordBatch.from_arrays([pa.array([f"file://{tmp_path}/x", f"file:{tmp_path}/empty"])], ["path"])
    got = [b.to_pylist()[0] for b in files.digests(piece=1000)([batch])]
    assert [(r["bytes"], r["sha256"]) for r in got] == [(len(d), hashlib.sha256(d).hexdigest()) for d in (data, b"")]


def test_folders_are_their_files_and_only_spark_need_open_them(spark, data, tmp_path):
    """A table as Spark writes it, a folder, by its own path and by one that pyarrow does not know."""
    spark.read.parquet(f"{data}/documents.parquet").repartitionByRange(3, "doc_id").write.parquet(f"{tmp_path}/t.parquet")
    own = spark.sparkContext._jsc.hadoopConfiguration()
    own.set("fs.viewfs.mounttable.parts.link./in", f"file://{tmp_path}")
    want = spark.read.parquet(f"{data}/documents.parquet").where("length(trim(text)) > 0").count()
    got = []
    for root in (str(tmp_path), "viewfs://parts/in"):
        rows = readers.documents(spark, "shards", [f"{root}/t.parquet"], ["de"], "hand", "given")
        got.append(sorted((r["local_id"], r["lang"]) for r in rows.collect()))
        assert len(got[-1]) == want and {x for _, x in got[-1]} == {"hand"}
    assert got[0] == got[1]
    # Without ids, rows are numbered over all parts.
    spark.read.parquet(f"{tmp_path}/t.parquet").select("text", "doc_id").drop("doc_id").withColumn("text", F.lit("x")).write.parquet(f"{tmp_path}/n.parquet")
    for root in (str(tmp_path), "viewfs://parts/in"):
        numbers = sorted(int(r["local_id"]) for r in readers.documents(spark, "parquet", [f"{root}/n.parquet"], []).collect())
        assert numbers == list(range(len(numbers))) and numbers


def test_files_in_parts(spark, tmp_path):
    """A folder of a file's name is one file: numbered, digested and failed as a whole."""
    rows = spark.range(300).select(F.when(F.col("id") < 200, "a").otherwise("b").alias("g"), "id", F.concat(F.lit('{"text": "é'), "id", F.when(F.col("id") == 250, "").otherwise(F.lit('"}'))).alias("value"))
    ranged = rows.repartitionByRange(5, "g", "id").sortWithinPartitions("g", "id")
    ranged.select("g", F.lit("all.jsonl").alias("file"), "value").write.partitionBy("g", "file").text(str(tmp_path / "in"))
    assert len(files.below(str(tmp_path / "in"), ".txt")) > 2
    want = {g: [r["value"] for r in rows.where(F.col("g") == g).orderBy("id").collect()] for g in "ab"}
    got = readers.numbered_lines(spark, readers.discover(spark, [f"{tmp_path}/in/*/*.jsonl"])).collect()
    assert sorted((r["path"].partition("g=")[2][0], r["line"], r["value"]) for r in got) == sorted((g, i, v) for g in "ab" for i, v in enumerate(want[g]))
    digests = {r["sha256"]: (r["bytes"], r["chars"]) for r in readers.text_digests(spark, str(tmp_path / "in")).collect()}
    texts = ["".join(v + "\n" for v in want[g]) for g in "ab"]
    assert digests == {hashlib.sha256(t.encode()).hexdigest(): (len(t.encode()), len(t)) for t in texts}
    tokenizing.tokenize_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), span=100)
    assert [r["path"].rpartition("/in/")[2] for r in tokenizing.failures(spark, str(tmp_path / "out")).collect()] == ["g=b/file=all.jsonl"]
    assert tokenizing.tokenized(spark, str(tmp_path / "out")).count() == 200


def test_token_files_are_read_in_stretches(spark, tmp_path, monkeypatch):
    """A large file is several partitions, each with its own sequences; gaps, other types and empty sequences are read as they are."""
    rng = random.Random(3)
    rows = [[rng.randint(0, 1 << 20) for _ in range(rng.choice([0, 1, 50]))] for _ in range(500)]
    indexed.register(spark)
    sinks.merged(spark.createDataFrame([(r,) for r in rows], "tokens array<int>").repartition(3), str(tmp_path / "m"), None)
    assert len(files.below(str(tmp_path / "m"), ".idx")) == 3
    back = spark.read.format("indexed_tokens").option("tokens", True).load(str(tmp_path / "m")).collect()
    assert sorted(r["tokens"] or [] for r in back) == sorted(rows) and all(len(r["tokens"] or []) == r["length"] for r in back)
    monkeypatch.setattr(indexed, "SPAN", 1000)
    monkeypatch.setattr(indexed, "BATCH", 300)
    reader = indexed._Reader({"path": str(tmp_path / "m"), "tokens": "true"})
    parts = reader.partitions()
    got = [x for p in parts for b in reader.read(p) for x in b.to_pylist()]
    assert len(parts) > 20 and sorted(r["tokens"] for r in got) == sorted(rows)
    assert sorted((r["source"], r["seq_no"], r["pointer"]) for r in got) == sorted((r["source"], r["seq_no"], r["pointer"]) for r in back)
    # Two sequences of 16-bit ids, the second one first in the file.
    index = bytearray(indexed.write_index([2, 1], kind=8))
    index[42:58] = (2).to_bytes(8, "little") + (0).to_bytes(8, "little")
    (tmp_path / "o.idx").write_bytes(index)
    (tmp_path / "o.bin").write_bytes(b"".join(x.to_bytes(2, "little") for x in (9, 65_535, 8)))
    assert [r["tokens"] for r in spark.read.format("indexed_tokens").option("tokens", True).load(f"{tmp_path}/o.idx").orderBy("seq_no").collect()] == [[65_535, 8], [9]]
