"""Every operator on nulls, empty and very long texts, ties, repeated rows, no rows, and further columns with clashing names."""

import pytest
from pyspark.sql import functions as F

from weftline.llm import op1_chunk_store, op2_html_blocks, op3_mcd_rules, op4_line_windows, op5_crf_quality, op6_grace_dedup, op7_suffix_tree_lm, op8_linear_grouping, op9_tree_bpe, op10_simhash_mih, op11_zip_archives, op12_token_alignment, op13_suffix_resample, tokens
from weftline.llm.common import work_folder

BYTES, WORDS = (lambda: tokens.vocabulary("byte_bpe_50k.json")), (lambda: tokens.vocabulary("word_bpe_49k.json"))
SCHEMA = "doc_id long, text string, lang string, source string, key string, doc long, n long, number long, score double, h string, g string, word string"
LONG = "word another third\nline of words\n" * 4000 + "x" * 70_000
ROWS = [(1, "a b c d e\nf g h\ni j k"), (2, None), (3, ""), (4, " \t\n "), (5, LONG), (5, LONG), (6, "a b c d e\nf g h\ni j k"), (None, "no id"), (7, "naïve 日本語 🙂 text"), (8, "no id")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, *([None] * 10 if k % 2 else ["en", "s", "k", 1, 2, 3, 0.5, "h", "g", "w"])) for k, (i, t) in enumerate(rows)], SCHEMA)


def _op1(df):
    folder = work_folder(df.sparkSession)
    return op1_chunk_store.read_digests(op1_chunk_store.write_store(df, "doc_id", "text", folder, BYTES()), folder)


def _op11(df):
    folder = work_folder(df.sparkSession)
    return op11_zip_archives.checked(op11_zip_archives.read_archives(op11_zip_archives.write_archives(df, "doc_id", "key", "text", folder)), folder)


OPERATORS = {
    "op1": _op1,
    "op2": lambda df: op2_html_blocks.extract(df, "doc_id", "key", "text"),
    "op3": lambda df: op3_mcd_rules.judge(df, "doc_id", "text"),
    "op4": lambda df: op4_line_windows.dedup_lines(df, "doc_id", "text"),
    "op5": lambda df: op5_crf_quality.score(df, "text", op5_crf_quality.train(df, df.where("doc_id is not null").select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))), out="s"),
    "op6": lambda df: op6_grace_dedup.exact_groups(df, "doc_id", "text"),
    "op7": lambda df: op7_suffix_tree_lm.score_documents(df, "doc_id", "text", F.col("doc_id") > 1),
    "op8": lambda df: op8_linear_grouping.pack_documents(df, "doc_id", "text", WORDS()),
    "op9": lambda df: op9_tree_bpe.encode_digests(df, "doc_id", "text", WORDS(), apart=10_000, leaf=4_000),
    "op10": lambda df: op10_simhash_mih.near_groups(df, "doc_id", "text"),
    "op11": _op11,
    "op12": lambda df: op12_token_alignment.align_documents(df, "doc_id", "text", BYTES(), tokens.vocabulary("piece_bpe_32k.model"), work_folder(df.sparkSession)),
    "op13": lambda df: op13_suffix_resample.resample(df, "doc_id", "text", df.where("doc_id < 5"), "text", work_folder(df.sparkSession), percent=50, least=2),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_edge_rows(spark, name):
    got = OPERATORS[name](frame(spark)).collect()
    if name == "op8":
        assert sum(r["start"] == 0 for r in got) == len(ROWS)
    else:
        assert len(got) == len(ROWS)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_empty_table(spark, name):
    assert OPERATORS[name](frame(spark).where("false")).count() == 0


def test_defined_results_of_tokens(spark):
    """op1, op8 and op9 against the library on every edge row."""
    import hashlib
    import zlib

    import numpy as np

    df = frame(spark)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    ids = {name: {t: tokens.load(path()).encode(t or "", add_special_tokens=False).ids for _, t in ROWS} for name, path in (("b", BYTES), ("w", WORDS))}
    one = sorted((str(r["doc"]), r["n_tokens"], r["ids_crc32"]) for r in _op1(df).collect())
    assert one == sorted((str(i), len(ids["b"][t]) + 1, crc([*ids["b"][t], 0])) for i, t in ROWS)
    starts = [(r["start"], r["n_tokens"]) for r in _op1(df).orderBy("start").collect()]
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    nine = sorted((str(r["key"]), r["n_tokens"], r["ids_sha256"], r["leaves"] > 1) for r in OPERATORS["op9"](df).collect())
    assert nine == sorted((str(i), len(ids["w"][t]), hashlib.sha256(" ".join(map(str, ids["w"][t])).encode()).hexdigest(), t == LONG) for i, t in ROWS)
    eight = OPERATORS["op8"](df).collect()
    pieces = sorted((str(r["doc"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in eight)
    whole = [(i, [*ids["w"][t], 1]) for i, t in ROWS]
    assert pieces == sorted((str(i), k // 4096, k, len(x[k : k + 4096]), crc(x[k : k + 4096])) for i, x in whole for k in range(0, len(x), 4096))
    for s in {r["sequence_id"] for r in eight}:
        own = sorted((r["offset"], r["length"]) for r in eight if r["sequence_id"] == s)
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) <= 4096


def test_defined_results_of_lines_and_pages(spark):
    import duckdb

    df = frame(spark)
    # Rows of their own ids: nulls, empty and very long texts, repeated lines and ties of windows, against the SQL.
    alone = [r for k, r in enumerate(ROWS) if r[0] is not None and r[0] not in [x for x, _ in ROWS[:k]]]
    names = ["doc_id", "text"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", alone)
    want = con.sql(op4_line_windows.ORACLE_SQL).df()
    got = op4_line_windows.dedup_lines(spark.createDataFrame(alone, "doc_id long, text string"), *names).toPandas()
    got = got.rename(columns={"key": "doc_id"})[list(want.columns)]
    rows = lambda pdf: sorted(map(str, pdf.astype(object).where(pdf.notna(), None).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
    two = {r["key"]: r for r in OPERATORS["op2"](df).collect()}
    assert [two[i]["text"] for i in (2, 3, 4)] == ["", "", ""] and two[2]["n_chars"] == 0
    # No markup: one block, its white space as blanks, whole whatever its length.
    assert all(two[i]["text"] in ("", " ".join(t.split())) and two[i]["n_chars"] == len(two[i]["text"]) for i, t in ROWS if t)
    five = {(r["doc_id"], r["text"]): r["s"] for r in OPERATORS["op5"](df).collect()}
    assert len(five) == len(set(ROWS)) and all(0 <= x <= 1 for x in five.values()) and len({x for (_, t), x in five.items() if not t}) == 1
    # Equal texts have equal scores, whatever their ids.
    assert five[(1, ROWS[0][1])] == five[(6, ROWS[0][1])] and five[(None, "no id")] == five[(8, "no id")]


def test_defined_results_of_archives_alignment_and_samples(spark):
    df = frame(spark)
    eleven = sorted((str(r["key"]), r["n"], r["record_type"], str(r["refers"])) for r in _op11(df).collect())
    size = lambda t: len((t or "").encode())
    # The long text comes twice under one id, which makes both of them responses; all others are short.
    assert eleven == sorted((str(i), size(t), "response", "None") for i, t in ROWS)
    twelve = {(r["key"], r["n_a"]): r for r in OPERATORS["op12"](df).collect()}
    for i, t in ROWS:
        n = len(op12_token_alignment.ByteSide(BYTES()).tokenizer.encode(" " + t, add_special_tokens=False).ids) if t else 0
        r = twelve[(i, n)]
        assert (r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]) and (len(r["groups_sha256"]) == 64) == bool(n)
    # Pairs of the two equal long texts are held by two documents at least.
    assert all(r["count_sum"] >= 2 * r["n_links"] for (i, n), r in twelve.items() if i == 5)
    thirteen = OPERATORS["op13"](df).collect()
    drawn = sorted(r["rank"] for r in thirteen if r["rank"] is not None)
    able = sum(len(op13_suffix_resample.words((t or "").encode())) >= 2 for _, t in ROWS)
    assert drawn == list(range(1, able // 2 + 1)) and [r["n_features"] for r in thirteen if r["key"] in (2, 3, 4)] == [0, 0, 0]


def test_defined_results(spark):
    df = frame(spark)
    six = op6_grace_dedup.exact_groups(df, "doc_id", "text").collect()
    assert sum(r["kept"] for r in six) == len({r["text_sha256"] for r in six}) == 5
    empty = [r for r in six if r["key"] in (2, 3, 4)]
    assert {r["keep_id"] for r in empty} == {4} and {r["group_size"] for r in empty} == {3}
    assert [r["keep_id"] for r in six if r["key"] is None] == [8]
    ten = {r["key"]: r for r in op10_simhash_mih.near_groups(df, "doc_id", "text").collect()}
    assert ten[3]["fingerprint"] == "0" * 16 and ten[2]["component_id"] == ten[4]["component_id"] == 2 and ten[6]["component_id"] == 1 and ten[None]["component_id"] == 8
    three = {r["key"]: r for r in op3_mcd_rules.judge(df, "doc_id", "text").collect()}
    assert three[2]["n_words"] == 0 and three[2]["base_failed"] and not three[2]["kept"]
    seven = {r["key"]: r for r in op7_suffix_tree_lm.score_documents(df, "doc_id", "text", F.col("doc_id") > 1).collect()}
    assert seven[2]["n_tokens"] == seven[3]["n_tokens"] == 1 and seven[2]["n_known"] == 1
    none = op7_suffix_tree_lm.score_documents(df, "doc_id", "text", F.lit(False)).where("key = 6").first()
    assert none["n_known"] == 0 and none["train_tokens"] == 0 and none["base_score"] == 0
    scores = op5_crf_quality.score(df, "text", op5_crf_quality.fit([]), "s")
    assert [r["s"] for r in scores.collect()] == [1.0] * len(ROWS) and scores.drop("s").columns == df.columns
