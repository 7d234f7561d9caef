"""Resampling against a plain version, suffix orders against sorting, and the queries against their SQL."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from weftline.llm import op11_zip_archives, op13_suffix_resample
from weftline.llm import op13_suffix_resample as resample
from weftline.llm.common import work_folder


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def plain_features(text, grams):
    w = plain_words(text)
    return [" ".join(w[i : i + k]) for k in range(1, grams + 1) for i in range(len(w) - k + 1)]


def plain(rows, target, grams, buckets, percent, least, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    own = [[bucket(f) for f in plain_features(t, grams)] for _, t in rows]
    s, t = Counter(b for x in own for b in x), Counter(bucket(f) for x in target for f in plain_features(x, grams))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for (i, text), x in zip(rows, own):
        h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, x))
        out.append([i, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(plain_words(text))])
    able = sorted((x for x in out if x[5] >= least), key=lambda x: (-x[3], x[0] is None, x[0]))
    for rank, x in enumerate(able[: len(able) * percent // 100], 1):
        x[4] = rank
    return [tuple(x[:5]) for x in out]


@pytest.mark.parametrize("grams,block", [(1, 1 << 19), (2, 1 << 19), (3, 30), (5, 1)])
def test_against_plain(spark, monkeypatch, grams, block):
    rng = random.Random(grams)
    vocabulary = ["The", "the", "THE", "é", "É", "x1", "日本", "ab", "q", "İ", "ﬀ"]
    rows = [(i, rng.choice([" ", "--", "\n"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, " .,; \t"), (203, "a'b_c"), (None, "the " * 30), (5, "again " * 25), (5, "again " * 25)]
    target = ["the x1 ab", "日本 é q the", None, "x1 ab the x1"]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, row long")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(df, "doc_id", "text", goal, "text", work_folder(spark), 30, 8, grams, 997, 7).collect()
    want = plain(rows, target, grams, 997, 30, 8, 7)
    # Equal rows have ranks in any order.
    key = lambda r: (str(r[:4]), r[4] is None, r[4])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    monkeypatch.setattr(resample, "BLOCK", block)
    texts = [plain_words(t) for _, t in rows]
    made = resample.block_buckets([[w.encode() for w in t] for t in texts], grams, 997)
    assert [sorted(m.tolist()) for m in made] == [sorted(zlib.crc32(f.encode()) % 997 for f in plain_features(t, grams)) for _, t in rows]


@pytest.mark.parametrize("depth", [1, 2, 3, 7])
def test_suffix_orders(depth):
    rng = np.random.default_rng(depth)
    for _ in range(40):
        ids = rng.integers(0, rng.integers(1, 6), rng.integers(1, 60))
        order = resample.suffix_order(ids, depth)
        cut = [tuple(ids[p : p + depth].tolist()) for p in order.tolist()]
        assert sorted(order.tolist()) == list(range(len(ids))) and cut == sorted(cut)
        lcp = resample.common_prefixes(ids, order, depth)
        shared = lambda a, b: next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
        assert lcp.tolist() == [0, *[shared(a, b) for a, b in zip(cut, cut[1:])]]


def test_edge_tables(spark):
    none, docs = spark.createDataFrame([], "i long, t string"), spark.createDataFrame([(1, "a " * 50), (2, "word " * 300_000)], "i long, t string")
    assert resample.resample(none, "i", "t", docs, "t", work_folder(spark)).count() == 0
    got = {r["key"]: r for r in resample.resample(docs, "i", "t", none, "t", work_folder(spark), percent=50).collect()}
    assert got[2]["n_features"] == 300_000 and got[1]["n_features"] == 50 and sum(r["rank"] is not None for r in got.values()) == 1


@pytest.mark.parametrize("op", [op11_zip_archives, op13_suffix_resample])
def test_queries_and_sql(spark, data, op):
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    want = con.sql(op.ORACLE_SQL).df()
    got = op.query(spark, data).toPandas()[list(want.columns)]
    rows = lambda pdf: sorted(map(str, pdf.astype(object).where(pdf.notna(), None).map(lambda x: int(x) if isinstance(x, float) else x).itertuples(index=False, name=None)))
    assert rows(got) == rows(want)
