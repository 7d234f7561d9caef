"""Folds by ranges against loops over all rows, with ties, at any number of ranges."""

import random

import numpy as np
import pytest

from weftline.operators import folds, packing


def loop(tokens, size, rows=0):
    """Batch numbers by the plain loop, and how many closed."""
    out, total, n, batch = [], 0, 0, 0
    for t in tokens:
        out.append(batch)
        total, n = total + t, n + 1
        if (size and total >= size) or (rows and n >= rows):
            total, n, batch = 0, 0, batch + 1
    return out, batch


@pytest.mark.parametrize("size, rows", [(50, 0), (40, 7), (0, 5), (1, 0), (300, 1)])
def test_tables_say_what_ranges_do(size, rows):
    rng = np.random.default_rng(size + rows)
    for high in (3, 30, 90):
        for _ in range(30):
            tokens = rng.integers(0, high, rng.integers(0, 120))
            want, full = loop(tokens.tolist(), size, rows)
            assert np.searchsorted(folds.ends(tokens, size, rows), np.arange(len(tokens)), side="right").tolist() == want
            # Cut anywhere, ranges of any length strung together close the same batches.
            cuts = sorted({0, len(tokens), *rng.integers(0, len(tokens) + 1, 6).tolist()})
            held = held_rows = closed = 0
            for a, b in zip(cuts, cuts[1:]):
                own = folds.ends(tokens[a:b], size, rows, held, held_rows)
                assert (closed + np.searchsorted(own, np.arange(b - a), side="right")).tolist() == want[a:b]
                made = folds.table(tokens[a:b], size, rows)
                n, held_rows, held = folds.passed(folds._sorted(made.sample(frac=1, random_state=1)), size, rows, held_rows, held)
                assert n == len(own)
                closed += n
                # No more rows than the first batch has, and one.
                assert len(made) <= (loop(tokens[a:b].tolist(), size, rows)[0].count(0) if b > a else 0) + 1
            assert closed == full


def tied(rng, n, orders, most):
    return [(rng.choice(["en", "de", None]), rng.randrange(orders), rng.choice([0, None, -3, *[rng.randrange(most) for _ in range(8)]]), k) for k in range(n)]


def count(t):
    return max(t or 0, 0)


@pytest.mark.parametrize("ranges", [1, 2, 7, 50, None])
def test_bundles_with_ties(spark, ranges):
    rng = random.Random(3)
    rows = tied(rng, 900, 40, 60)
    df = spark.createDataFrame(rows, "lang string, o long, t long, x long").repartition(5)
    got = packing.bundles(df, "lang", "o", "t", 500, partial=True, ranges=ranges).collect()
    want = []
    for lang in ("en", "de", None):
        own = sorted((o, count(t)) for g, o, t, _ in rows if g == lang)
        batch, full = loop([t for _, t in own], 500)
        want += [(str(lang), o, t, b, b < full) for (o, t), b in zip(own, batch)]
    # Rows that tie in order and tokens are alike.
    assert sorted((str(r["lang"]), r["o"], r["t"], r["bundle"], r["full"]) for r in got) == sorted(want)
    sums = {}
    for r in got:
        sums.setdefault((r["lang"], r["bundle"], r["full"]), []).append(r["t"])
    assert all((sum(v) >= 500) == full for (_, _, full), v in sums.items())


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_texts_of_tied_rows_stay_single(spark, ranges):
    rng = random.Random(8)
    rows = [("en", rng.randrange(6), rng.randrange(3), f"text {k}", f"s{k % 4}") for k in range(200)]
    df = spark.createDataFrame(rows, "lang string, o long, t long, text string, source string")
    made = packing.bundle_rows(packing.bundles(df, "lang", "o", "t", 9, partial=True, ranges=ranges), df, "lang", "o", "t", 9).collect()
    assert sum(r["source_doc_count"] for r in made) == 200
    joined = "\n".join(r["text"] for r in made)
    assert all(joined.count(f"text {k}\n") == 1 for k in range(200))
    assert all(r["estimated_tokens"] >= 9 for r in made if not r["partial"])


def turns(tokens, targets, each, partial):
    """The plain loop over several open bundles."""
    made, sums, held, turn, out = dict.fromkeys(targets, 0), dict.fromkeys(targets, 0), {t: [] for t in targets}, 0, []
    for row in tokens:
        going = [x for x in targets if made[x] < each]
        if not going:
            break
        target = going[turn % len(going)]
        turn += 1
        held[target].append(row)
        sums[target] += row[1]
        if sums[target] >= target:
            out += [(*r, target, made[target], True) for r in held[target]]
            made[target], sums[target], held[target] = made[target] + 1, 0, []
    for target, own in held.items() if partial else ():
        out += [(*r, target, made[target], False) for r in own if made[target] < each]
    return out


@pytest.mark.parametrize("ranges", [1, 2, 9, 40, None])
@pytest.mark.parametrize("targets, each", [([40, 90, 200], 3), ([100], 2), ([30, 500], 50), ([64, 32, 16, 8], 1)])
def test_several_targets_in_turn(spark, ranges, targets, each):
    rng = random.Random(each)
    rows = tied(rng, 400, 60, 25)
    df = spark.createDataFrame(rows, "lang string, o long, t long, x long").repartition(4)
    got = packing.bundles_many(df, "lang", "o", "t", targets, each, partial=True, ranges=ranges).collect()
    want = []
    for lang in ("en", "de", None):
        own = sorted((o, count(t)) for g, o, t, _ in rows if g == lang)
        want += [(str(lang), *r) for r in turns(own, targets, each, True)]
    assert sorted(map(lambda r: (str(r[0]), *r[1:]), map(tuple, got))) == sorted(want)


@pytest.mark.parametrize("ranges", [1, 4, 30])
@pytest.mark.parametrize("most_rows, most_bytes", [(7, 200), (5, 0), (1000, 100)])
def test_batches_of_two_limits(spark, ranges, most_rows, most_bytes):
    rng = random.Random(most_rows)
    rows = [(f"p{rng.randrange(150):03d}", rng.randrange(90)) for _ in range(300)]
    got = packing.batches(spark.createDataFrame(rows, "path string, size long"), "path", "size", most_rows, most_bytes, ranges).collect()
    own = sorted(rows)
    assert sorted(map(tuple, got)) == sorted((*r, b) for r, b in zip(own, loop([s for _, s in own], most_bytes, most_rows)[0]))


def test_no_rows(spark):
    none = spark.createDataFrame([], "lang string, o long, t long")
    assert packing.bundles(none, "lang", "o", "t", 5, partial=True).count() == packing.bundles_many(none, "lang", "o", "t", [5], 1).count() == packing.batches(none, "o", "t", 3).count() == 0
