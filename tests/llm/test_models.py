"""Classifier, rules, language model and extraction: held-out accuracy, plain versions and properties."""

import collections
import math
import os
import re
import subprocess
import sys
import zlib
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from weftline.llm import op2_html_blocks as blocks
from weftline.llm import op3_mcd_rules as rules
from weftline.llm import op5_crf_quality as crf
from weftline.llm import op7_suffix_tree_lm as lm


def test_crf_marginals_are_brute_force():
    rng = np.random.default_rng(2)
    emit, trans, start = rng.normal(size=(3, 4, 2)), rng.normal(size=(2, 2)), rng.normal(size=2)
    lengths = [4, 2, 1]
    mask = np.arange(4) < np.array(lengths)[:, None]
    nodes, pairs, log_z = crf.marginals(emit, mask, trans, start)
    want_pairs = np.zeros((2, 2))
    for d, n in enumerate(lengths):
        total, node = 0.0, np.zeros((n, 2))
        pair = np.zeros((2, 2))
        for code in range(2**n):
            y = [(code >> k) & 1 for k in range(n)]
            w = math.exp(start[y[0]] + sum(emit[d, t, y[t]] for t in range(n)) + sum(trans[y[t], y[t + 1]] for t in range(n - 1)))
            total += w
            for t in range(n):
                node[t, y[t]] += w
            for t in range(n - 1):
                pair[y[t], y[t + 1]] += w
        assert np.allclose(nodes[d, :n], node / total)
        want_pairs += pair / total
        if n > 0:
            assert np.isclose(log_z[d], math.log(total))
    assert np.allclose(pairs, want_pairs)


def test_crf_chains_and_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    trans, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    score = 3 * rng.normal(size=300)
    nodes, _, _ = crf.marginals(np.stack([np.zeros_like(score), score], axis=-1)[None], np.ones((1, 300), bool), trans, start)
    assert np.allclose(crf.chain_marginals(score, trans, start), nodes[0, :, 1])
    # The same scores whether texts are worked on whole, in small blocks, or as chains of their own.
    texts = [b"", b"\n", b"One good line here.\nAnd one more of them.\n\nOne good line here.", b"BUY!!! NOW $$$\n" * 40, b"a " * 500 + b"\nb", " é\n\x0bx".encode()]
    model = crf.Model(rng.normal(size=crf.WIDTH), 1 + rng.random(crf.WIDTH), rng.normal(size=crf.WIDTH + 1), trans, start)
    whole = model.scores(texts)
    for text, got in zip(texts, whole):
        own, lines, weight = crf.own_features([(text, crf._State())])
        at = np.arange(len(own))
        x = crf.line_features(own, at == 0, at == len(own) - 1)
        assert np.allclose(x, crf.window_features(text, 0, len(own)))
        emit = ((x - model.mean) / model.scale) @ model.weights[:-1] + model.weights[-1]
        nodes, _, _ = crf.marginals(np.stack([np.zeros_like(emit), emit], axis=-1)[None], np.ones((1, len(own)), bool), trans, start)
        assert np.isclose(got, nodes[0, :, 1] @ weight / weight.sum())
    monkeypatch.setattr(crf, "BLOCK", 16)
    monkeypatch.setattr(crf, "CHAIN", 2)
    assert np.allclose(model.scores(texts), whole)


def test_crf_memory_of_a_long_text():
    code = """
import resource, numpy as np
from weftline.llm import op5_crf_quality as crf
rng = np.random.default_rng(1)
model = crf.Model(np.zeros(crf.WIDTH), np.ones(crf.WIDTH), rng.normal(size=crf.WIDTH + 1), rng.normal(size=(2, 2)), rng.normal(size=2))
model.scores([b"x"])
base = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
model.scores([b"\\n".join(b"%d" % k for k in range(1_000_000))])
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - base) // 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))).stdout
    assert int(out.split()[-1]) < 300


def test_crf_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = crf.query(spark, sf).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id").join(got)
    held = labels[labels["held_out"]]
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, h in got["held_out"].items())
    assert (held["predicted"] == held["quality"]).mean() > 0.97 and got["score"].between(0, 1).all()


def plain_statistics(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = collections.Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_rules_statistics(spark, data):
    texts = ["", None, "a", "a a a", "a a a a", "a b a b a b", "x\nx\n \nx\n", "é # b *\x0bq", "a b c d a b c e a b c", "a b c d"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    got = {r["key"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rules.statistics(df, "doc_id", "text", "lang", "source").collect()}
    for i, t in rows:
        assert got[i] == plain_statistics(t), (i, t)


def plain_mcd(x):
    """(mean, covariance) by the same steps in numpy, with exact quantiles."""
    floor = np.diag([v**2 for v in rules.VECTOR.values()])
    q = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    distance = lambda m, c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
    found = []
    for mean, cov in ((q[1], np.diag(((q[2] - q[0]) / 1.349) ** 2) + floor), (x.mean(axis=0), np.cov(x.T, bias=True) + floor)):
        for _ in range(rules.STEPS):
            d = distance(mean, cov)
            near = x[d <= np.quantile(d, rules.SHARE, method="inverted_cdf")]
            mean, cov = near.mean(axis=0), rules.consistency(rules.SHARE, rules.AT_SHARE) * np.cov(near.T, bias=True) + floor
        found.append((np.linalg.slogdet(cov)[1], mean, cov))
    _, mean, cov = min(found, key=lambda f: f[0])
    near = x[distance(mean, cov) <= rules.AT_STEP]
    return near.mean(axis=0), rules.consistency(0.975, rules.AT_STEP) * np.cov(near.T, bias=True) + floor


def test_rules_against_numpy(spark):
    """Languages and sources of 500 rows and of 3, each judged by its own estimate leaning on its language's."""
    sf = "/root/testdata/sf0.01"
    F = __import__("pyspark").sql.functions
    source = F.when(F.col("doc_id") % 150 == 0, "tiny").when(F.col("doc_id") % 5 == 0, "some").otherwise("most")
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("lang in ('en', 'de')").withColumn("source", source)
    got = rules.judge(docs, "doc_id", "text").toPandas()
    on = got[~got["base_failed"]].reset_index(drop=True)
    n = on["n_words"].clip(lower=1)
    lines = dict((r["key"], r["n_lines"]) for r in rules.statistics(docs, "doc_id", "text", "lang", "source").collect())
    x = np.column_stack([np.log(on["word_chars"] / n), np.log1p(100 * on["n_symbols"] / on["word_chars"]), on["n_repeat_words"] / n, on["n_dup_lines"] / on["key"].map(lines).clip(lower=1)])
    want, sizes = np.zeros(len(on)), set()
    for (lang, _), at in on.groupby(["lang", "source"]).groups.items():
        (ms, cs), (ml, cl) = plain_mcd(x[at]), plain_mcd(x[on["lang"] == lang])
        own = len(at) / (len(at) + rules.PRIOR)
        mean, cov = own * ms + (1 - own) * ml, own * cs + (1 - own) * cl
        want[at] = np.einsum("ij,jk,ik->i", x[at] - mean, np.linalg.inv(cov), x[at] - mean)
        sizes.add(len(at))
    assert min(sizes) < 10 and max(sizes) > 100
    assert np.corrcoef(np.log1p(want), np.log1p(on["distance"]))[0, 1] > 0.99
    assert ((want <= rules.CUTOFF) == on["kept"].to_numpy()).mean() > 0.995
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas().set_index("doc_id")["quality"]
    known = on[on["key"].isin(labels.index)]
    assert known[known["key"].map(labels) == 1]["kept"].mean() > 0.99 and known[known["key"].map(labels) == 0]["kept"].mean() < 0.2


def test_language_model(spark):
    sf = "/root/testdata/sf0.01"
    got = lm.query(spark, sf).toPandas().set_index("doc_id")
    docs = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [b""] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    counts = collections.Counter()
    for i, words in docs.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    for i, words in docs.items():
        r = got.loc[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel_tol=1e-9)
    held = got[got["held_out"]]
    assert held["score"].sum() > 0.9 * held["base_score"].sum() and (held["score"] > held["base_score"]).mean() > 0.9


def test_extraction():
    tree = blocks.grow(list(blocks.LABELLED))
    assert all(blocks.decide(tree, r[:-1]) == bool(r[-1]) for r in blocks.LABELLED)
    page = """<html><head><title>T</title><script>"</p>"</script></head><body><header><h1>Site</h1></header><div class="sidebar"><p>x y z</p></div><main><h1>A &amp; B</h1><p>One&nbsp;two<br>three
    four<p class=ad>buy<p>five <a href="x">six</a></p><aside>no</aside><section id="comments"><article><p>reader</p></article></section><form><input>name<button>go</button></form></main><!-- c --><footer>f</footer>"""
    assert blocks.main_text(page, tree) == "A & B\n\nOne two three four\n\nfive six"
    maybe = '<div id="content"><p>one two</p><div class="comments"><p>no</p></div></div><p>' + "word " * 60 + "</p>"
    assert blocks.main_text(maybe, tree) == "one two"
    assert blocks.main_text(f"<article><p>inside</p></article>{maybe}", tree) == "inside"
    assert blocks.main_text("", tree) == "" and blocks.main_text("a < b <c", tree) == ""


def test_extraction_by_attributes_and_densities():
    tree = blocks.grow(list(blocks.LABELLED))
    used = set()

    def walk(node):
        if isinstance(node, tuple):
            used.add(blocks.FIELDS[node[0]])
            walk(node[2]), walk(node[3])

    walk(tree)
    assert used >= {"words", "links", "content", "frame"} and used & {"words_before", "links_before"} and used & {"words_after", "links_after"}
    body = "the river runs past the old mill and on to the sea " * 4
    text = body.strip()
    assert blocks.main_text(f'<article><div data-href="/x?id=ad"><p>{body}</p></div></article>', tree) == text
    assert blocks.main_text(f'<main><h1>Title</h1><div class="newsletter-archive"><p>{body}</p><div class="share"><p>tell friends</p></div></div></main>', tree) == f"Title\n\n{text}"
    assert blocks.main_text(f'<main><div class="post share-this-story"><p>{body}</p></div></main>', tree) == text
    assert blocks.main_text(f'<main><p>{body}</p><div class="promo"><p>{body}</p></div><div id="comments"><p>{body * 9}</p></div></main>', tree) == text
    # A page without a single known name: menus and link lists go by their links and neighbours.
    menu = "".join(f'<div><a href="/{k}">Item {k}</a></div>' for k in range(5))
    plain = f"<div>{menu}</div><div><h2>A heading</h2><div>{body}</div><div>{body}</div></div><div>{menu}</div>"
    assert blocks.main_text(plain, tree) == f"A heading\n\n{text}\n\n{text}"


@pytest.mark.parametrize("page", ['<div class="promo">' * 20_000, '<p class=a b = "c' * 3000 + ">", "<div>" * 30_000, '<p title="x>y' * 5000, "<" * 50_000, "<!--" * 20_000, "<b>" * 30_000 + "</i>" * 30_000, "</p>" * 50_000])
def test_odd_pages_end(page):
    blocks.main_text(page, blocks.grow(list(blocks.LABELLED)))


def test_pages(spark, data):
    import html

    got = {r["page_id"]: r for r in blocks.query(spark, data).collect()}
    for r in spark.read.parquet(f"{data}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        want = "\n\n".join(b for b in (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", q)).split()) for q in re.split(r"</?(?:p|h1)>", article)) if b)
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def plain_suffix_tree(train, texts, least, met=1, depth=3, test=4.0, weight=50.0):
    """Scores by tables of all contexts, in plain Python, and the number of states of each length."""
    streams = [["<start>", *t.lower().split(), ""] for t in train]
    words = collections.Counter(w for s in streams for w in s[1:])
    rare = {w: c for w, c in words.items() if w and c < least}
    once, twice = (sum(c == k for c in words.values()) for k in (1, 2))
    off = min(max(once / max(once + 2 * twice, 1), 0.05), 0.95)
    others = sum(rare.values())
    room = sum(words.values()) + 0.5 * (len(words) - len(rare) - 1 + 2)

    def alone(w):
        if w not in words or w in rare:
            return (others + 0.5) / room * ((rare[w] - off) if w in rare else off * len(rare)) / others
        return (words[w] + 0.5) / room

    states: list[dict] = []

    def p(before, w):
        for d in range(min(len(states), len(before)), 0, -1):
            own = states[d - 1].get(before[-d:])
            if own is not None:
                kept, n = own
                return (kept[w] + (n - sum(kept.values()) + weight) * p(before[-d + 1 :] if d > 1 else (), w)) / (n + weight)
        return alone(w)

    for d in range(1, depth + 1):
        below = collections.defaultdict(collections.Counter)
        for s in streams:
            for i in range(d, len(s)):
                below[tuple(s[i - d : i])][s[i]] += 1
        found = {}
        for context, own in below.items():
            n, kept = sum(own.values()), collections.Counter({w: c for w, c in own.items() if c >= met})
            if n < least or not kept:
                continue
            rest, chance = n - sum(kept.values()), (len(kept) + (sum(kept.values()) < n) - 1) / 2
            gain = sum(c * math.log(c / n / p(context[1:], w)) for w, c in kept.items())
            if rest:
                gain += rest * math.log(rest / n / max(1 - sum(p(context[1:], w) for w in kept), 1e-12))
            if gain > chance + test * math.sqrt(chance + 1):
                found[context] = kept, n
        states.append(found)
    scores = []
    for t in texts:
        s = ["<start>", *t.lower().split(), ""]
        scores.append(sum(math.log10(p(tuple(s[max(i - depth, 0) : i]), s[i])) for i in range(1, len(s))))
    return scores, [len(x) for x in states]


@pytest.mark.parametrize("near, met", [(0, 3), (300, 1), (1_000_000, 3)])
def test_suffix_tree_is_brute_force(spark, near, met):
    """States by an absolute count, of any word: hundreds of contexts of each length, each met by fewer than a thousandth of the tokens, and 4,000 other words."""
    rng, texts = np.random.default_rng(3), []
    for _ in range(300):
        x = list(rng.integers(0, 10, 3))
        while len(x) < 60:
            x.append((3 * x[-1] + x[-2] * x[-3] + x[-3]) % 10 if rng.random() < 0.8 else rng.integers(10))
        texts.append(" ".join(f"v{k}" if rng.random() < 0.95 else f"w{rng.integers(4000)}" for k in x))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want, states = plain_suffix_tree(texts[:250], texts, 5, met)
    assert min(states[1:]) > 40 and states[2] > 200
    got = {r["key"]: r["score"] for r in lm.score_documents(df, "doc_id", "text", "doc_id < 250", head=100, near=near, least=5, met=met).collect()}
    assert all(math.isclose(got[i], want[i], rel_tol=1e-9) for i in range(300))


def test_far_words_and_strings_are_packed():
    """Words and strings beyond the tables of all tasks make a row for each slice and range, however many they are."""
    texts = [" ".join(f"w{(7 * i + k * k) % 5000}" for k in range(200)) for i in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array(range(400)), pa.array(texts)], ["number", "doc", "text"])
    none, bits = np.zeros(0, np.int64), np.full(1 << 10, -1, np.int64)
    model = SimpleNamespace(value=(none, np.zeros(0), bits, none, np.zeros(0), np.zeros(0), 1, 0.0, 0.0))
    rows = pa.Table.from_batches(lm._scored(model, pa.int64(), 4, 16)(iter([batch]))).to_pylist()
    far = [r for r in rows if r["kind"] != lm.DOCUMENT]
    assert len(rows) - len(far) == 400 and len(far) == 32
    words = [r for r in far if r["kind"] == lm.WORDS]
    codes = np.concatenate([np.cumsum(lm._numbers(r["codes"], "<i8")) for r in words])
    assert sum(lm._numbers(r["times"], "<u4").sum() for r in words) == 400 * 200 and set(codes) == set(lm.word_codes(" ".join(texts).encode())[1])


def test_ranges_are_the_same_in_spark(spark):
    codes = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 500)
    got = spark.createDataFrame([(int(c),) for c in codes], "code long").select("code", lm._range_of("code", 37).alias("r")).collect()
    assert {r["code"]: r["r"] for r in got} == dict(zip(codes.tolist(), lm.range_of(codes, 37).tolist()))


@pytest.mark.parametrize("same", [True, False])
def test_crf_bound_keeps_both_labels(spark, same):
    """Rows of labelled ids that repeat beyond the bound."""
    bad, good = [i for i in range(1, 20) if zlib.crc32(str(i).encode()) % crf.FOLDS][:2]
    rows = [(i, f"{text} {0 if same else k}") for k in range(40) for i, text in ((bad, "$$$ !!! click 999"), (good, "The river runs slowly past the old mill in the evening."))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = crf.train(docs, spark.createDataFrame([(bad, 0), (good, 1)], "doc_id long, quality int"), most=5)
    low, high = model.scores([rows[0][1].encode(), rows[1][1].encode()])
    assert low < high
