"""Alignment of two tokenizers against a plain version that compares all pairs of byte ranges."""

import hashlib
import random
from collections import Counter

import pytest

from weftline.llm import op12_token_alignment as align
from weftline.llm import tokens
from weftline.llm.common import work_folder

A, B = (lambda: tokens.vocabulary("byte_bpe_50k.json")), (lambda: tokens.vocabulary("piece_bpe_32k.model"))


def plain(rows):
    """By the contract's words: ranges, groups at common ends, links by overlap, counts by document."""
    a_side, b_side = align.ByteSide(A()), align.PieceSide(B())
    docs = []
    for key, text in rows:
        whole = (" " + (text or "")).encode()
        a, b = (a_side.tokenizer.encode(" " + text, add_special_tokens=False).ids, b_side.model.encode(text)) if text else ([], [])
        if not text or b"".join(a_side.bytes[k] for k in a) != whole or b"".join(b_side.bytes[k] for k in b) != whole:
            docs.append((key, [], [], [], []))
            continue
        ranges = []
        for ids, side in ((a, a_side), (b, b_side)):
            at, own = 0, []
            for k in ids:
                own.append((at, at + len(side.bytes[k]), k))
                at += len(side.bytes[k])
            ranges.append(own)
        both = sorted({e for _, e, _ in ranges[0]} & {e for _, e, _ in ranges[1]})
        groups = [[[k for s, e, k in own if lo <= s and e <= hi] for own in ranges] for lo, hi in zip([0, *both], both)]
        links = [(i, j) for s, e, i in ranges[0] for t, f, j in ranges[1] if s < f and t < e]
        docs.append((key, a, b, groups, links))
    counts = Counter(p for d in docs for p in set(d[4]))
    best: dict[int, int] = {}
    for (i, _), n in counts.items():
        best[i] = max(n, best.get(i, 0))
    out = []
    for key, a, b, groups, links in docs:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((key, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


def texts():
    rng = random.Random(5)
    hard = [None, "", " ", "\n", "a", "  two  blanks ", "<s> </s> <unk> <|endoftext|> <0x41>", "日本語 🙂👨‍👩‍👧 né\x00q", "▁ under▁score", "\t\r\n  x", "Ünïcödé", "ﬁ ½ ｆｕｌｌ", "é́é", "aaaa" * 50, "ends with a blank ", "\nline\nfeeds\n", "a\n\nb  c\n d", "x\u00a0y z\u3000q", "w" * 300 + " z", "tab\tbed word"]
    return hard + ["".join(rng.choice(["the ", "er", "é", "日", "🙂", " ", "\n", "12", "Token", "ization", ".", "́"]) for _ in range(rng.randint(1, 60))) for _ in range(60)]


@pytest.mark.parametrize("frequent", [align.FREQUENT, 40, 0])
def test_against_all_pairs(spark, frequent):
    rows = list(enumerate(texts())) + [(3, "\n"), (90, "the er"), (90, "the er"), (None, "no id")]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, pair string, row long")
    got = align.align_documents(df, "doc_id", "text", A(), B(), work_folder(spark), frequent)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(rows)))


def test_task_sums_in_parts(monkeypatch):
    """Counts of a task that holds more pairs than it may."""
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(align, "HELD", 50)
    rng = np.random.default_rng(0)
    docs = [np.unique(rng.integers(0, 400, rng.integers(0, 40))) for _ in range(60)]
    total = Counter()
    for batch in align._held("<u4")([pa.RecordBatch.from_arrays([pa.array([np.diff(d, prepend=0).astype("<u4").tobytes() for d in docs], pa.binary())], ["pairs"])]):
        for k, n in zip(batch["pair"].to_pylist(), batch["n"].to_pylist()):
            total[k] += n
    assert total == Counter(x for d in docs for x in d.tolist())


def test_long_text_and_empty_table(spark):
    text = "long texts are aligned whole\n" * 8000 + "x" * 20_000
    got = align.align_documents(spark.createDataFrame([(1, text)], "i long, t string"), "i", "t", A(), B(), work_folder(spark)).first()
    assert got["n_a"] == len(align.ByteSide(A()).encode([" " + text])[0]) and got["n_links"] == got["n_a"] + got["n_b"] - got["n_groups"]
    # The only document: each pair is held once, so all links are best and count one.
    assert got["n_best"] == got["count_sum"] == got["n_links"]
    assert align.align_documents(spark.createDataFrame([], "i long, t string"), "i", "t", A(), B(), work_folder(spark)).count() == 0
