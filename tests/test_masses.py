"""Attention masses, recall and compressibility against all pairs, in many small blocks, with equal scores; needles in a budget."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from weftline.operators import retrieval, vectors


@pytest.mark.parametrize("causal", [True, False])
@pytest.mark.parametrize("kind", ["random", "ties", "equal", "far"])
def test_against_all_pairs(spark, monkeypatch, causal, kind):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rng = np.random.default_rng(7)
    n = 120
    v = {"random": rng.normal(size=(n, 6)), "ties": rng.integers(-1, 2, (n, 3)), "equal": np.ones((n, 2)), "far": rng.normal(size=(n, 4)) * 12}[kind].astype(np.float32)
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<float>").repartition(3)
    scores = v.astype(float) @ v.astype(float).T
    got = {r["query"]: r for r in vectors.masses(df, "id", "v", 5, every=4, causal=causal).collect()}
    shares, recalls = [], []
    for q in range(0, n, 4):
        own = scores[q, : q + 1] if causal else scores[q]
        r = got[q]
        assert r["n"] == len(own) and np.isclose(r["high"], own.max()) and np.isclose(r["low"], own.min())
        assert np.isclose(r["total"], np.exp(own - own.max()).sum())
        order = np.lexsort((np.arange(len(own)), -own))[:5]
        assert [b["key"] for b in r["best"]] == order.tolist() and np.allclose([b["score"] for b in r["best"]], own[order])
        p = np.exp(own - own.max()) / np.exp(own - own.max()).sum()
        recalls.append((q, p[order].sum()))
        shares.append(np.sort(p)[::-1][: int(np.ceil(len(own) * 0.3))].sum())
    recall = {r["quarter"]: (r["recall"], r["pairs"]) for r in vectors.recall_by_quarter(vectors.masses(df, "id", "v", 5, every=4, causal=causal), n).collect()}
    assert np.isclose(recall[-1][0], np.mean([m for _, m in recalls])) and np.isclose(recall[2][0], np.mean([m for q, m in recalls if n // 2 <= q < 3 * n // 4]))
    assert recall[-1][1] == sum(r["n"] for r in got.values())
    assert np.isclose(vectors.compressibility(df, "id", "v", 0.3, every=4, causal=causal).first()["mass"], np.mean(shares))


def test_needles_in_a_budget(spark):
    rows = [(["ab", "", "cdef"], 0.5, 20), (["x"], 1.0, 9), (["long line"], 0.0, 5), ([], 0.3, 50), (["a" * 30, "b"], 0.7, 200)]
    for lines, depth, budget in rows:
        df = spark.createDataFrame([(lines, depth)], "l array<string>, d double")
        got = retrieval.budget_context(df, "l", "d", F.lit("KEY"), budget).first()
        size, n = 4, 0
        while lines and size + len(lines[n % len(lines)]) + 1 <= budget:
            size += len(lines[n % len(lines)]) + 1
            n += 1
        filler = [lines[k % len(lines)] for k in range(n)]
        at = int(n * depth)
        assert got["context"] == [*filler[:at], "KEY", *filler[at:]] and got["n_lines"] == n
