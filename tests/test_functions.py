"""Functions against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.functions import arrays as A
from weftline.functions import text as T
from weftline.operators import languages


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_strip_is_pythons(spark):
    texts = [" a ", " b ", "\x1cc\x1f", "\t\n", "", "　d e ", "x"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(T.strip("t")).collect()]
    assert got == [t.strip() for t in texts]


@pytest.mark.parametrize("policy, want", [("filter", [7, 2, 2, 2, 9]), ("source", [7, 5, 2, 5, 9]), ("bundle", [7, 0, -2, 5, 9]), ("sum", [7, 0, -2, 0, 9])])
def test_token_policies(spark, policy, want):
    rows = [("0123456789", 7, 5), ("0123456789", 0, 5), ("0123456789", -2, 5), ("0123456789", None, 5), ("0123456789", 9, None)]
    got = spark.createDataFrame(rows, "t string, c long, o long").select(T.resolve_tokens("t", "c", "o", policy)).collect()
    assert [r[0] for r in got] == want


def test_skip_ranges(spark):
    got = one(spark, T.skip_ranges(F.lit("fr:24, en:20-22, de:s3-s5")))[0]
    assert [(r["lang"], r["shard"]) for r in got] == [("fr", 24), ("en", 20), ("en", 21), ("en", 22), ("de", 3), ("de", 4), ("de", 5)]
    for bad in ("fr", "fr:5-2"):
        with pytest.raises(Exception, match="bad shard range"):
            one(spark, T.skip_ranges(F.lit(bad)))


def test_completion_prefix(spark):
    prompt = "  What is it?\nPlease answer shortly.\nAnswer: x <Answer>y\nz</Answer> "
    assert one(spark, T.completion_prefix(F.lit(prompt)))[0] == "What is it?\nThe answer is:"


def test_byte_ids_round_trip(spark):
    text = "aé😀\n"
    ids, back = one(spark, T.byte_ids(F.lit(text)).alias("i"), T.byte_text(T.byte_ids(F.lit(text))).alias("b"))
    assert ids == [b + 2 for b in text.encode()] + [1] and back == text
    assert one(spark, T.byte_ids(F.lit("")))[0] == [1]


def test_names_and_paths(spark):
    row = one(spark, T.chunk_name(F.lit("fr"), F.lit(3), F.lit(12), F.lit("t"), "r"), T.pack_id("p", "train", F.lit("fr"), F.lit(8192), F.lit(7)), T.human_bytes(F.lit(1_500_000)), T.lang_from_path(F.lit("/x/de/part-1.parquet"), ["de"]), T.lang_from_path(F.lit("fr_1.parquet"), ["de", "fr"]), T.lang_from_path(F.lit("zz.parquet"), ["de"]))
    assert list(row) == ["r_fr_s0003_c00012_t", "p_train_fr_8192_000007", "1.5 MB", "de", "fr", "unknown"]


def test_arrays(spark):
    v = F.array(*map(F.lit, [1, 5, 5, 2]))
    row = one(spark, A.argmax(v), A.rotated(v), A.inserted(v, F.lit(0.5), F.lit(9)), A.cycled(v, F.lit(6)), A.evenly(F.lit(10), 4), A.windows(F.lit(10), 3, 5), A.windows(F.lit(3), 3, 5))
    assert list(row) == [1, [5, 5, 2, 1], [1, 5, 9, 5, 2], [1, 5, 5, 2, 1, 5], [0, 3, 6, 9], [0, 3, 6], []]


def test_position_ids(spark):
    n = F.lit(4)
    far, whole = one(spark, A.position_ids(n, 20, "far", draw=F.lit(0.0)), A.position_ids(n, 20, "bridge"))
    assert far == [12, 13, 14, 15] and whole == [0, 6, 13, 19]
    bridge = one(spark, A.position_ids(F.lit(6), 32, "bridge", query_start=F.lit(4), evidence_start=F.lit(1), depth=F.lit(0.5)))[0]
    assert bridge[-2:] == [30, 31] and bridge[:4] == list(range(bridge[0], bridge[0] + 4)) and bridge[3] < 30
    with pytest.raises(ValueError):
        A.position_ids(n, 8, "other")


def test_vector_functions(spark):
    x = F.array(*map(F.lit, [1.0, 2.0, 3.0, 4.0]))
    dot, soft, loss, had = one(spark, A.dot(x, x), A.softmax(x), A.contrastive_loss(x, 3), A.hadamard(x))
    p = np.exp([1, 2, 3, 4]) / np.exp([1, 2, 3, 4]).sum()
    assert dot == 30 and np.allclose(soft, p) and np.isclose(loss, -np.log(p[3])) and np.allclose(had, [5, -1, -2, 0])


def test_languages():
    assert len(languages.PRIMARY) == 35 and languages.parse("de, xx,ga") == (["de", "xx", "ga"], ["xx"])
    assert len(languages.ADAPTERS["web"]) == len(languages.ADAPTERS["clean"]) == 38


def test_byte_ids_of_batches(spark):
    """As the column expressions have them, with nulls, empty texts, all bytes, slices and ids that are marks."""
    import pyarrow as pa

    from weftline.functions import tokenize as tok

    texts = [None, "", "aé😀\n\x00ÿ", "x" * 300, None, "日本"]
    for part in (pa.array(texts), pa.array(["cut", *texts])[1:], pa.array([], pa.string()), pa.array([None, None], pa.string())):
        for end in (1, None):
            ids = tok.byte_lists(part, end)
            assert ids.to_pylist() == [None if t is None else [b + 2 for b in t.encode()] + [1] * (end is not None) for t in part.to_pylist()]
            assert tok.byte_strings(ids).to_pylist() == part.to_pylist()
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    both = df.select("text", T.byte_ids("text").alias("a"), tok.ids("text").alias("b"))
    rows = both.select("*", T.byte_text("a").alias("c"), tok.texts("b").alias("d")).collect()
    assert all(r["a"] == r["b"] and r["c"] == r["d"] == r["text"] for r in rows)
    # Rows that are too short are not tokenized; where only numbers are asked for none is.
    plan = lambda x: x._jdf.queryExecution().optimizedPlan().toString()
    long = tok.tokenize(df, least=10)
    assert sorted((len(r["tokens"]), r["n_tokens"]) for r in long.collect()) == [(12, 12), (301, 301)]
    assert "ArrowEvalPython" not in plan(long.select("n_tokens")) and "regexp" not in plan(both)
