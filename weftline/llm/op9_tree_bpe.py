"""Encoding and decoding by tree concatenation.

A long stretch without places to split is cut into halves, and they into
halves, down to leaves that are encoded on their own: those of a long document
in parallel tasks. Two neighbours are then joined: a window of tokens around
the join is encoded again and grows until its encoding agrees with a run of
tokens of the left side and with one of the right side. A sequence of tokens is
the encoding of its text if every two neighbours in it are the encoding of
theirs, so what is spliced at the agreeing runs is exact.

Defined results: a null text is empty, and an empty text has no tokens; a very
long text is encoded whole, its leaves in as many tasks as there are, and a run
of combining marks longer than a leaf stays in one; keys are
of any type; repeated and equal rows give one row each; an empty table gives
none; columns besides the key and the text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .op1_chunk_store import _arrow

#: Code points of a leaf; tokens that have to agree on each side; code points from which a document's leaves go to tasks of their own.
LEAF, AGREE, APART = 4096, 4, 65_536
#: Pieces between blanks that a window takes on each side at first.
WINDOW = 3


class Span:
    """Tokens of text[start:stop]: ids, and where each begins and ends in the whole text."""

    __slots__ = ("ids", "begin", "end", "start", "stop")

    def __init__(self, ids, begin, end, start, stop):
        self.ids, self.begin, self.end, self.start, self.stop = ids, begin, end, start, stop


def encode_span(tokenizer, text: str, start: int, stop: int) -> Span:
    e = tokenizer.encode(text[start:stop], add_special_tokens=False)
    at = np.array(e.offsets, dtype=np.int64).reshape(-1, 2) + start
    return Span(np.array(e.ids, dtype=np.int64), at[:, 0], at[:, 1], start, stop)


@lru_cache(maxsize=1)
def _composing() -> frozenset[str]:
    """Characters that canonical composition may join to what stands before them."""
    parts = (unicodedata.decomposition(chr(c)).split() for c in range(sys.maxunicode + 1))
    return frozenset(chr(int(p[1], 16)) for p in parts if len(p) == 2 and not p[0].startswith("<"))


def firm(text: str, at: int) -> bool:
    """Whether a cut at ``at`` leaves normalisation as it is: what follows is no mark, jamo, joiner or unknown character, which may move or compose."""
    if at <= 0 or at >= len(text):
        return True
    c = text[at]
    return c.isascii() or not (unicodedata.category(c) in ("Mn", "Mc", "Me", "Cf", "Cn") or "\u1160" <= c <= "\u11ff" or c in _composing())


def safe_cut(text: str, at: int) -> int:
    """The first firm place from ``at`` on."""
    while not firm(text, at):
        at += 1
    return at


def join(tokenizer, text: str, left: Span, right: Span, window: int = 16) -> Span:
    """The tokens of both sides together, exactly as the whole is encoded."""
    if not len(left.ids) and left.start == left.stop:
        return right
    while True:
        i, j = max(0, len(left.ids) - window), min(len(right.ids), window)
        # A token that holds a part of a character shares the character with its neighbour: begin before it, and at a firm place.
        while i > 0 and (left.begin[i] < left.end[i - 1] or not firm(text, int(left.begin[i]))):
            i -= 1
        while 0 < j < len(right.ids) and (right.begin[j] < right.end[j - 1] or not firm(text, int(right.begin[j]))):
            j += 1
        a = int(left.begin[i]) if i > 0 else left.start
        b = int(right.begin[j]) if j < len(right.ids) else right.stop
        mid = encode_span(tokenizer, text, a, b)
        head, tail = _agree_left(left, mid, i), _agree_right(right, mid)
        if head is not None and tail is not None and head[1] <= tail[0]:
            (li, mi), (mj, rj) = head, tail
            parts = lambda name: np.concatenate([getattr(left, name)[:li], getattr(mid, name)[mi:mj], getattr(right, name)[rj:]])
            return Span(parts("ids"), parts("begin"), parts("end"), left.start, right.stop)
        if i == 0 and j == len(right.ids):
            return Span(mid.ids, mid.begin, mid.end, left.start, right.stop)
        window *= 2


def _agree_left(left: Span, mid: Span, i: int):
    """(tokens to keep of the left, tokens to leave out of the window), where AGREE tokens from the window's start are the same."""
    if i == 0:
        return 0, 0
    n = AGREE
    if len(left.ids) - i < n or len(mid.ids) < n:
        return None
    same = (left.ids[i : i + n] == mid.ids[:n]).all() and (left.begin[i : i + n] == mid.begin[:n]).all() and (left.end[i : i + n] == mid.end[:n]).all()
    return (i, 0) if same else None


def _agree_right(right: Span, mid: Span):
    """(tokens of the window to keep, tokens to leave out of the right), at AGREE same tokens before the window's last ones."""
    if mid.stop == right.stop:
        return len(mid.ids), len(right.ids)
    n = AGREE
    # The window may end within a word, so its last tokens do not count.
    for j in range(len(mid.ids) - n, n - 1, -1):
        k = int(np.searchsorted(right.begin, mid.begin[j - n]))
        if mid.begin[j - n] >= right.start and k + n <= len(right.ids) and k >= 1:
            r = slice(k, k + n)
            m = slice(j - n, j)
            if (right.ids[r] == mid.ids[m]).all() and (right.begin[r] == mid.begin[m]).all() and (right.end[r] == mid.end[m]).all():
                return j, k + n
    return None


def leaves(text: str, leaf: int) -> list[tuple[int, int]]:
    """Leaves of equal length at most ``leaf``, a power of two of them, cut at firm places only."""
    n = 1
    while len(text) > n * leaf:
        n *= 2
    cuts = sorted({safe_cut(text, len(text) * k // n) for k in range(n)} | {0})
    return list(zip(cuts, [*cuts[1:], len(text)]))


def join_all(tokenizer, text: str, spans: list[Span]) -> Span:
    """Neighbours are joined in pairs, level by level."""
    while len(spans) > 1:
        spans = [join(tokenizer, text, *spans[k : k + 2]) if k + 1 < len(spans) else spans[k] for k in range(0, len(spans), 2)]
    return spans[0]


def tree_encode(tokenizer, text: str, leaf: int = LEAF) -> list[int]:
    """The ids of ``text`` by tree concatenation."""
    return join_all(tokenizer, text, [encode_span(tokenizer, text, a, b) for a, b in leaves(text, leaf)]).ids.tolist()


def _pieces(path: str) -> tokens.Pieces:
    """Of each piece: (number of ids, ids joined by a space, decoded text)."""

    def build():
        tokenizer = tokens.load(path)
        names = [None] * tokenizer.get_vocab_size()
        for name, k in tokenizer.get_vocab().items():
            names[k] = name

        def of(ids: list[int]) -> tuple[int, str, str]:
            return len(ids), " ".join(map(str, ids)), " ".join([names[k] for k in ids]) if tokenizer.decoder is None else tokenizer.decode(ids, skip_special_tokens=False)

        return tokens.Pieces(path, of, encode=lambda piece: tree_encode(tokenizer, piece), weigh=lambda v: 180 + len(v[1]) + len(v[2]))

    return tokens.shared((path, "digest"), build)


class Leaf:
    """A stretch of text as pieces between blanks and their values, and whether it begins or ends within one."""

    __slots__ = ("pieces", "values", "cut_before", "cut_after")

    def __init__(self, pieces: list[str], values: list, cut_before: bool, cut_after: bool):
        self.pieces, self.values, self.cut_before, self.cut_after = pieces, values, cut_before, cut_after


def join_leaves(tokenizer, make, left: Leaf, right: Leaf, window: int = WINDOW) -> Leaf:
    """Both sides together. A window of pieces around the join is encoded again; what stands in it beyond the pieces at the join has to come out as it is on either side, else the window grows."""
    if not (left.cut_after and right.cut_before):
        # A blank at the join, which no token crosses: both sides stay.
        return Leaf(left.pieces + right.pieces, left.values + right.values, left.cut_before, right.cut_after)
    whole = left.pieces[-1] + right.pieces[0]
    while True:
        i, j = max(0, len(left.pieces) - window), min(len(right.pieces), window)
        ids = tokenizer.encode(" ".join([*left.pieces[i:-1], whole, *right.pieces[1:j]]), add_special_tokens=False).ids
        head, tail = left.values[i:-1], right.values[1:j]
        n, m = sum([v[0] for v in head]), sum([v[0] for v in tail])
        same = n + m <= len(ids) and " ".join(map(str, ids[:n])) == " ".join([v[1] for v in head if v[0]]) and " ".join(map(str, ids[len(ids) - m :])) == " ".join([v[1] for v in tail if v[0]])
        if same and (head or i == 0) and (tail or j == len(right.pieces)):
            return Leaf([*left.pieces[:-1], whole, *right.pieces[1:]], [*left.values[:-1], make(ids[n : len(ids) - m]), *right.values[1:]], left.cut_before, right.cut_after)
        if i == 0 and j == len(right.pieces):
            return Leaf([" ".join([*left.pieces[:-1], whole, *right.pieces[1:]])], [make(ids)], left.cut_before, right.cut_after)
        window *= 2


def digest_text(path: str, text: str, leaf: int = LEAF) -> tuple[int, str, str, int]:
    """(tokens, ids joined by a space, decoded text, leaves) of a text. Without a decoder of its own the vocabulary's tokens are joined by a space, so decoded pieces are as well.

    Leaves are made of pieces between blanks and joined level by level; a text
    with a longer stretch without blanks is joined token by token.
    """
    pieces = _pieces(path)
    own = leaves(text, leaf)
    if len(own) == 1:
        values = pieces.of(tokens.bare_pieces(text))
    else:
        raw = [tokens.bare_pieces(text[a:b]) for a, b in own]
        if max([len(p) for x in raw for p in x]) > tokens.LONG:
            values = [pieces.make(tree_encode(pieces.tokenizer, text, leaf))]
        else:
            full = [[p for p in x if p] for x in raw]
            level = [Leaf(f, pieces.of(f), x[0] != "", x[-1] != "") for f, x in zip(full, raw)]
            while len(level) > 1:
                level = [join_leaves(pieces.tokenizer, pieces.make, *level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
            values = level[0].values
    values = [v for v in values if v[0]]
    return sum([v[0] for v in values]), " ".join([v[1] for v in values]), " ".join([v[2] for v in values]), len(own)


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _whole(path: str, leaf: int):
    names = ["key", "n_tokens", "ids", "decoded", "leaves"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [digest_text(path, t or "", leaf) for t in batch.column("text").to_pylist()]
            n, ids, decoded, own = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(n, pa.int64()), pa.array(map(_hex, ids), pa.string()), pa.array(map(_hex, decoded), pa.string()), pa.array(own, pa.int64())], names)

    return run


def _cut(leaf: int):
    """The leaves of whole texts, one text at a time."""

    def run(batches):
        for batch in batches:
            for k, text in enumerate(batch.column("text").to_pylist()):
                own = leaves(text, leaf)
                same = pa.array([k] * len(own), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("row").take(same), batch.column("key").take(same), pa.array([a for a, _ in own], pa.int64()), pa.array([text[a:b] for a, b in own], pa.string())], ["row", "key", "start", "piece"])

    return run


def _leaf(path: str):
    """Encodes leaves; only their ids and places, as bytes, go on."""

    def run(batches):
        tokenizer = tokens.load(path)
        for batch in batches:
            ids, begin, end = [], [], []
            for text, start in zip(batch.column("piece").to_pylist(), batch.column("start").to_pylist()):
                span = encode_span(tokenizer, text, 0, len(text))
                ids.append(span.ids.astype("<i4").tobytes())
                begin.append((span.begin + start).astype("<i8").tobytes())
                end.append((span.end + start).astype("<i8").tobytes())
            names = ["row", "key", "start", "piece"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(ids, pa.binary()), pa.array(begin, pa.binary()), pa.array(end, pa.binary())], [*names, "ids", "begin", "end"])

    return run


def _joined(path: str, key_type: pa.DataType):
    def run(table: pa.Table) -> pa.Table:
        tokenizer = tokens.load(path)
        tokens.release()
        rows = sorted(table.to_pylist(), key=lambda r: r["start"])
        text, spans = "".join(r["piece"] for r in rows), []
        for r in rows:
            spans.append(Span(np.frombuffer(r["ids"], "<i4").astype(np.int64), np.frombuffer(r["begin"], "<i8"), np.frombuffer(r["end"], "<i8"), r["start"], r["start"] + len(r["piece"])))
        ids = join_all(tokenizer, text, spans).ids.tolist()
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        return pa.table({"key": pa.array([rows[0]["key"]], key_type), "n_tokens": pa.array([len(ids)], pa.int64()), "ids": [_hex(" ".join(map(str, ids)))], "decoded": [_hex(decoded)], "leaves": pa.array([len(spans)], pa.int64())})

    return run


def encode_digests(df: DataFrame, key: str, text: str, path: str, apart: int = APART, leaf: int = LEAF) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256, leaves) of every row of ``df``; leaves are how many the text was encoded from.

    Texts of up to ``apart`` code points are encoded and joined where they are
    read. The leaves of longer ones are dealt out to all tasks and joined for
    each text in one, which holds no more than that text.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    out = f"key {kind}, n_tokens long, ids string, decoded string, leaves long"
    short = rows.where(F.length("text") <= apart).mapInArrow(_whole(path, leaf), out)
    long = rows.where(F.length("text") > apart).withColumn("row", F.monotonically_increasing_id())
    cut = long.mapInArrow(_cut(leaf), f"row long, key {kind}, start long, piece string")
    # A given number of partitions is not merged by adaptive execution, which sees bytes and not the work of encoding them.
    cut = cut.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("row", "start"))
    encoded = cut.mapInArrow(_leaf(path), f"row long, key {kind}, start long, piece string, ids binary, begin binary, end binary")
    joined = encoded.groupBy("row").applyInArrow(_joined(path, _arrow(df.schema[key].dataType)), out)
    return short.unionByName(joined).select("key", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"), "leaves")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_digests(docs, "doc_id", "text", tokens.vocabulary("word_bpe_49k.json")).withColumnRenamed("key", "doc_id")
