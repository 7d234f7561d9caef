"""Exact, near and line deduplication against SQL and brute force."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import op4_line_windows as lines
from weftline.llm import op6_grace_dedup as grace
from weftline.llm import op10_simhash_mih as simhash
from weftline.llm.common import connected_components, exclusive_prefix, work_folder, written


@pytest.mark.parametrize("module", [lines, grace])
def test_against_sql(spark, data, module):
    got = module.query(spark, data).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = duckdb.sql(module.ORACLE_SQL.replace("FROM documents", f"FROM '{data}/documents.parquet'")).df().sort_values("doc_id").reset_index(drop=True)
    for c in got.columns:
        assert (got[c] == want[c]).all(), c


@pytest.mark.parametrize("code", [None, 7])
def test_spilling_changes_nothing(code):
    """Also where all hashes clash: contents are compared whole."""
    rng, rows, want = random.Random(1), [], {}
    for _ in range(3000):
        content = rng.choice([b"a", b"bc", b"d"]) * rng.randint(0, 300)
        best = (rng.randint(0, 5), rng.randint(0, 9) if rng.random() > 0.1 else None)
        rows.append((grace._code(__import__("hashlib").sha256(content).digest()) if code is None else code, content, best, 1))
        want[content] = (grace.better(want[content][0], best), want[content][1] + 1) if content in want else (best, 1)
    got = [(e[1], (e[2], e[3])) for e in grace.grace(rows, pa.int64(), budget=3000)]
    assert len(got) == len(want) and dict(got) == want


def test_line_windows(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, "\n\n\n\n\n\n"), (5, "q\nq\nq\nq\nq")]
    got = {r["key"]: (r["n_removed"], r["text"]) for r in lines.dedup_lines(spark.createDataFrame(rows, "i long, t string"), "i", "t").collect()}
    assert got == {1: (0, "a\nb\nc\nd"), 2: (4, "x\ny"), 3: (0, "a\nb"), 4: (0, "\n\n\n\n\n\n"), 5: (4, "q")}


def components(fps, bits=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count((fps[i + 1 :] ^ fps[i]).view(np.uint64)) <= bits) + i + 1:
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("crowd", [4096, 3])
def test_links_of_clustered_fingerprints(spark, crowd):
    rng = np.random.default_rng(5)
    base = rng.integers(-(2**63), 2**63 - 1, 40)
    near = [b ^ sum(1 << int(k) for k in rng.choice(63, rng.integers(1, 6), replace=False)) for b in base.tolist() for _ in range(25)]
    same = [int(base[0]) ^ (k << 3) for k in range(60)]  # a crowd that shares one segment
    fps = np.unique(np.array([*base.tolist(), *near, *same], np.int64))
    folder = work_folder(spark)
    distinct = written(spark.createDataFrame([(int(x),) for x in fps], "fp long"), f"{folder}/d")
    roots = {r["node"]: r["root"] for r in connected_components(spark, simhash.edges(distinct, crowd, folder), f"{folder}/c").collect()}
    got, want = [roots.get(int(x), int(x)) for x in fps], components(fps)
    assert len(set(got)) == len(set(want)) and len(set(zip(got, want))) == len(set(want))


def test_fingerprints(spark, data):
    from xxhash import xxh64_intdigest

    for text in ("", "One", "one TWO", "a b c d", "x y z " * 30, "日 本 語 é"):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).split()
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text.encode()) & (2**64 - 1) == want
    got = simhash.query(spark, data).toPandas()
    fps = np.array([int(x, 16) for x in got["fingerprint"]], np.uint64).view(np.int64)
    ids, groups = got["doc_id"].to_numpy(), components(fps)
    least = {}
    for g, i in zip(groups, ids):
        least[g] = min(least.get(g, i), i)
    assert [least[g] for g in groups] == got["component_id"].tolist()


def test_trees_span_without_all_pairs():
    fps = np.unique(np.random.default_rng(1).integers(0, 2**11, 900))
    edges = simhash.trees(fps)
    assert len(edges) < len(fps) and len(fps) - len(edges) == len(set(components(fps)))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    folder = work_folder(spark)
    got = {r["node"]: r["root"] for r in connected_components(spark, spark.createDataFrame(edges, "a long, b long"), folder).collect()}
    assert all(got[i] == 0 for i in range(1, 61)) and all(got[1000 + i] == 1000 for i in range(1, 200))


def test_exclusive_prefix(spark):
    rows = [(None, 5)] + [(i * 37 % 101, i) for i in range(101)]
    df = written(spark.createDataFrame(rows, "o long, v long"), f"{work_folder(spark)}/p")
    got, total = exclusive_prefix(df, "o", "v", "s", buckets=8).orderBy(df["o"].asc_nulls_first()).collect(), 0
    for r in got:
        assert r["s"] == total
        total += r["v"]
