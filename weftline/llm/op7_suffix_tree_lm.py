"""Language-model scores by a probabilistic suffix tree over words.

Symbols are all words and the end of a text; a start stands before each text.
Contexts are the up to DEPTH symbols before one. A context is a candidate if
it is met LEAST times, a count, so that the tree grows with the corpus; its
next symbols are counted over all training texts. Those met MET times below it
have an outcome each, the others one together: what is met once or twice says
only how open a context is, so its share goes to the suffix. A candidate
becomes a state if its next-symbol distribution diverges from that of its
longest suffix among the states by more than chance would give. Each state's
distribution is smoothed with its suffix's. A symbol is scored by the longest
suffix of what stands before it that is a state; without one, words met LEAST
times cost their share of all tokens, and others their part of what is left: a
constant is taken off each one's count, by the numbers of words that occur once
and twice, and what that leaves is the probability of the unknown word.

Candidates, counts and states are written tables that are joined by context.
Symbols and contexts go by 64-bit hashes, a context's being made of those of
its symbols, so that no table of words is needed to read it. The tree is turned
into one table of weights: a text's score is that of its words alone and the
sum of the weights of its strings of up to DEPTH + 1 symbols. A weight is what
a state costs as a context and what a symbol seen there adds. A fixed bitmap of
the hashes that a table may hold spares the shuffle most other strings; the
join decides. A string met MET times has a suffix met as often, so the suffixes'
bitmap spares most of those that are not. What the HEAD most frequent words and
the NEAR most frequent strings cost is sent to all tasks, bounded tables that
save work. All others go to the costs by ranges of hashes, as many as the costs
need: a slice of texts has one row for each range, with the hashes packed in
order, and a task holds the costs of one range while those rows pass by. A
level's shuffle files go with its table, the tree's tables with its weights.

Defined results: a null text is empty, and an empty text is its end alone;
without training rows every count is 0 and the tree is its root; ties of counts, which only decide what is sent to all tasks, fall by
hash; very long texts are scored whole, a slice of texts at a time; rows with the
same key are documents of their own; an empty table gives no rows; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import remove, work_folder, written
from .op1_chunk_store import _arrow

#: Longest context; times a context is met at least, and a symbol below it that has an outcome of its own; standard deviations beyond chance of the divergence test; weight of the suffix's distribution; words, and strings, whose counts or weights go to every task; folds and the one held out.
DEPTH, LEAST, MET, TEST, WEIGHT, HEAD, NEAR, FOLDS, HELD = 3, 20, 3, 4.0, 50.0, 600_000, 1_500_000, 7, 2
#: Bytes of text that are looked at at once, and of those whose words are hashed together.
SLICE, BLOCK = 4 << 20, 1 << 19
#: Distinct strings of a task's table; bits of a bitmap's place at most and of the word within; how far a hash turns with each further symbol.
STRINGS, PLACE, BITS, TURN = 1_000_000, 27, 6, 23
#: Ranges of hashes at least, and costs in one on average.
RANGES, COSTS = 16, 1_000_000


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


#: The end of a text and its start.
END, START = (_mixed(np.array([2, 3], np.uint64) << np.uint64(60)).view(np.int64)).tolist()
#: Base of the words' polynomial and its inverse modulo 2 ** 64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANKS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
#: A number for each byte, the same for A-Z and a-z.
_BYTES = _mixed((np.arange(256) + np.where((np.arange(256) > 64) & (np.arange(256) < 91), 32, 0)).astype(np.uint64) + np.uint64(1 << 40))
_AFTER = re.compile(rb"[\x20\x09-\x0D]")


class _Powers:
    """Powers of the base and of its inverse, as many as the longest block so far needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            whole = lambda x: np.cumprod(np.r_[np.uint64(1), np.full(n - 1, x, np.uint64)])
            self.up, self.down = whole(np.uint64(_BASE)), whole(np.uint64(_INVERSE))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_codes(buffer: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(place of each word in the buffer, its 64-bit hash): a polynomial of its bytes, A-Z as a-z, and its length, mixed. All words of a block at once."""
    places, codes, lo = [], [], 0
    while lo < len(buffer):
        m = _AFTER.search(buffer, lo + BLOCK)
        hi = m.start() if m else len(buffer)
        raw = np.frombuffer(buffer, np.uint8, hi - lo, lo)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], ~_BLANKS[raw], [False]]).view(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        up, down = _POWERS.of(len(raw) + 1)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[raw] * up[:-1])])
        h = (sums[ends] - sums[starts]) * down[starts]
        codes.append(_mixed(h ^ (ends - starts).astype(np.uint64)).view(np.int64))
        places.append(starts + lo)
        lo = hi
    return (np.concatenate(places), np.concatenate(codes)) if codes else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def streams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols of all texts, each from its start to its end; place within the text; symbols of each text)."""
    at, codes = word_codes(b" ".join(texts))
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(at, begins)
    lengths = np.diff(first) + 2
    stream = np.full(len(codes) + 2 * len(texts), END, np.int64)
    ends = np.cumsum(lengths)
    stream[ends - lengths] = START
    stream[np.arange(len(codes)) + 2 * np.repeat(np.arange(len(texts)), lengths - 2) + 1] = codes
    return stream, np.arange(len(stream)) - np.repeat(ends - lengths, lengths), lengths


class _Counts:
    """Counts of keys, each with a further number: those of many slices together, until there are STRINGS of them."""

    def __init__(self, names: list[str]):
        self.names, self.parts, self.held = names, [], 0

    def _merged(self) -> list[np.ndarray]:
        key, other, n = (np.concatenate(x) for x in zip(*self.parts))
        found, first, back = np.unique(key, return_index=True, return_inverse=True)
        return [found, other[first], np.bincount(back, weights=n, minlength=len(found)).astype(np.int64)]

    def sent(self) -> Iterator[pa.RecordBatch]:
        rows = self._merged() if self.parts else [np.zeros(0, np.int64)] * 3
        self.parts, self.held = [], 0
        for lo in range(0, len(rows[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[lo : lo + 100_000]) for x in rows], self.names)

    def add(self, key: np.ndarray, other: np.ndarray) -> Iterator[pa.RecordBatch]:
        found, first, n = np.unique(key, return_index=True, return_counts=True)
        self.parts.append((found, other[first], n))
        self.held += len(found)
        if self.held > STRINGS:
            rows = self._merged()
            self.parts, self.held = [tuple(rows)], len(rows[0])
            if self.held > STRINGS // 2:
                yield from self.sent()


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(symbol, -, c) of each task's words and ends."""
    table = _Counts(["both", "other", "c"])
    for batch in batches:
        for part in slices([t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]):
            stream, place, _ = streams(part)
            symbols = stream[place > 0]
            yield from table.add(symbols, symbols)
    yield from table.sent()


def symbol_counts(train: DataFrame, text: str) -> DataFrame:
    """(both, c) of the words and the end over whole training texts."""
    return train.select(F.col(text).alias("text")).mapInArrow(_counted, "both long, other long, c long").groupBy("both").agg(F.sum("c").alias("c"))


def turned(code: np.ndarray) -> np.ndarray:
    u = code.view(np.uint64)
    return ((u << np.uint64(TURN)) | (u >> np.uint64(64 - TURN))).view(np.int64)


def strings_of(stream: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Hashes of the 1, 2, ... ``most`` symbols that end at each place; of no meaning where there are fewer."""
    code = stream
    yield code
    for _ in range(most - 1):
        code = stream ^ turned(np.r_[np.int64(0), code[:-1]])
        yield code


def member(values: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each value is in the sorted table, its place there)."""
    if not len(table):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values, at


def slices(texts: list[bytes]) -> Iterator[list[bytes]]:
    lo = 0
    while lo < len(texts):
        hi, held = lo, 0
        while hi < len(texts) and (hi == lo or held + len(texts[hi]) < SLICE):
            held += len(texts[hi])
            hi += 1
        yield texts[lo:hi]
        lo = hi


def bitmap(keys: DataFrame, column: str) -> np.ndarray:
    """Bits of the two places that each key falls on, 32 of them for a key or more: 16 MB at most, whatever the number of keys."""
    place = min(PLACE, max(BITS + 4, keys.count().bit_length() + 5))
    both = keys.select(F.explode(F.array(F.shiftrightunsigned(column, 64 - place), F.col(column).bitwiseAND((1 << place) - 1))).alias("at"))
    bits = both.select(F.shiftrightunsigned("at", BITS).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(at & {(1 << BITS) - 1} as int))").alias("b"))
    got = bits.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (place - BITS), np.int64)
    out[got.column("w").to_numpy()] = got.column("b").to_numpy()
    return out


def maybe(codes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether a bitmap has both of the code's places; another code may share them."""
    place, u, words = len(bits).bit_length() - 1 + BITS, codes.view(np.uint64), bits.view(np.uint64)
    has = lambda at: (words[(at >> np.uint64(BITS)).astype(np.int64)] >> (at & np.uint64((1 << BITS) - 1))) & np.uint64(1) == 1
    out = has(u >> np.uint64(64 - place))
    some = np.flatnonzero(out)
    out[some] = has(u[some] & np.uint64((1 << place) - 1))
    return out


def _children(bits, suffixes, depth: int):
    """(context, context and next symbol, count) of each task's texts, below the contexts of one length that the one bitmap lets through and of the suffixes that the other does."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Counts(["both", "context", "c"])
        for batch in batches:
            for part in slices([t or b"" for t in batch.column("text").cast(pa.large_binary()).to_pylist()]):
                stream, place, _ = streams(part)
                *_, code = strings_of(stream, depth)
                before = np.r_[np.int64(0), code[:-1]]
                on = np.flatnonzero((place >= depth) & maybe(before, bits.value) & maybe(code, suffixes.value))
                before = before[on]
                yield from table.add(stream[on] ^ turned(before), before)
        yield from table.sent()

    return run


def _turned(column) -> Column:
    return F.shiftleft(column, TURN).bitwiseOR(F.shiftrightunsigned(column, 64 - TURN))


def grow(train: DataFrame, text: str, alone: DataFrame, texts: int, folder: str, depth: int = DEPTH, least: int = LEAST, met: int = MET, test: float = TEST, weight: float = WEIGHT) -> DataFrame:
    """(code, weight, n) of all strings with a weight, n times met, from the words' (both, c, p) by themselves."""
    spark, rows = train.sparkSession, train.select(F.col(text).alias("text"))
    # What a context's hash lacks to its suffix's turns a string's hash into that of the string less its first symbol.
    often = alone.where((F.col("c") >= least) & (F.col("both") != END)).select(F.col("both").alias("context"), _turned(F.col("both")).alias("first"), F.col("c").alias("n"))
    start = spark.range(1).where(F.lit(texts) >= least).select(F.lit(START).alias("context"), _turned(F.lit(START)).alias("first"), F.lit(texts).cast("long").alias("n"))
    contexts, shorter, parts = often.unionByName(start), alone.where(F.col("c") >= met).select("both", "p"), []
    for d in range(1, depth + 1):
        contexts = written(contexts, f"{folder}/contexts{d}")
        bits, suffixes = (spark.sparkContext.broadcast(bitmap(t, c)) for t, c in ((contexts, "context"), (shorter, "both")))
        got = rows.mapInArrow(_children(bits, suffixes, d), "both long, context long, c long").groupBy("context", "both").agg(F.sum("c").alias("c")).where(F.col("c") >= met)
        got = got.join(contexts.select("context", "first"), "context").select("context", "both", F.col("both").bitwiseXOR(F.col("first")).alias("less"), "c")
        # Below a candidate's suffix, which is one as well, all that is met as often below the candidate was seen.
        got = written(got.join(shorter.select(F.col("both").alias("less"), F.col("p").alias("before")), "less"), f"{folder}/counts{d}")
        bits.destroy(), suffixes.destroy()
        sums = got.groupBy("context").agg(F.sum("c").alias("own"), F.count("*").alias("sizes"), F.sum(F.pow(F.lit(10.0), "before")).alias("mass"), F.sum(F.col("c") * (F.ln("c") - F.col("before") * math.log(10))).alias("gain"))
        sums = contexts.select("context", "n").join(sums, "context").withColumn("rest", F.col("n") - F.col("own"))
        gain = F.col("gain") - F.col("own") * F.ln("n") + F.when(F.col("rest") > 0, F.col("rest") * F.ln(F.col("rest") / F.col("n") / F.greatest(1 - F.col("mass"), F.lit(1e-12)))).otherwise(0.0)
        chance = (F.col("sizes") + F.when(F.col("rest") > 0, 1).otherwise(0) - 1) / 2
        states = sums.where(gain > chance + test * F.sqrt(chance + 1)).withColumn("given", F.col("rest") + weight)
        states = written(states.select("context", "n", "given", F.log10(F.col("given") / (F.col("n") + weight)).alias("back")), f"{folder}/states{d}")
        p = F.when(F.col("n").isNotNull(), F.log10((F.col("c") + F.col("given") * F.pow(F.lit(10.0), "before")) / (F.col("n") + weight))).otherwise(F.col("before"))
        end = F.col("both") == _turned(F.col("context")).bitwiseXOR(F.lit(END))
        seen = got.join(states, "context", "left").select("both", "less", "c", end.alias("end"), p.alias("p"), (p - F.col("before") - F.col("back")).alias("weight"))
        seen = written(seen, f"{folder}/seen{d}")
        remove(spark, f"{folder}/counts{d}")
        parts += [states.select(F.col("context").alias("code"), F.col("back").alias("weight"), "n"), seen.where("weight is not null").select(F.col("both").alias("code"), "weight", F.col("c").alias("n"))]
        shorter = seen.select("both", "p")
        contexts = seen.where((F.col("c") >= least) & ~F.col("end")).select(F.col("both").alias("context"), _turned(F.col("both").bitwiseXOR(F.col("less"))).alias("first"), F.col("c").alias("n"))
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    weights = written(total.groupBy("code").agg(F.sum("weight").alias("weight"), F.max("n").alias("n")), f"{folder}/weights")
    for d in range(1, depth + 1):
        for name in ("contexts", "states", "seen"):
            remove(spark, f"{folder}/{name}{d}")
    return weights


def _met(doc: np.ndarray, code: np.ndarray, table: np.ndarray):
    """(places in the sorted table, whether there, documents) of codes, and (document, code, times) of those that are not in it. Each code is looked up once, in order."""
    found, back = np.unique(code, return_inverse=True)
    near, at = member(found, table)
    here = near[back]
    key, times = np.unique(doc[~here] * max(len(found), 1) + back[~here], return_counts=True)
    return at[back[here]], doc[here], (key // max(len(found), 1), found[key % max(len(found), 1)], times)


def _planes(x: np.ndarray) -> bytes:
    """Numbers with all their first bytes, all their second ones, and so on, which compress better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def _numbers(data: bytes, kind: str) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def range_of(code: np.ndarray, ranges: int) -> np.ndarray:
    """Which of so many equal ranges of hashes each one is in, as ``_range_of`` says for columns."""
    return ((code.view(np.uint64) >> np.uint64(33)) * np.uint64(ranges) >> np.uint64(31)).astype(np.int64)


def _range_of(code: str, ranges: int) -> Column:
    return F.shiftright(F.shiftrightunsigned(code, 33) * F.lit(ranges).cast("long"), 31).cast("int")


#: What a row on its way to the weights is: a document's own sums, a word's or a string's cost, words or strings of many documents.
DOCUMENT, WORD, STRING, WORDS, TEXTS = range(5)
_ROUTED = "range int, kind int, number long, code long, n long, known long, base double, score double, numbers binary, docs binary, codes binary, times binary"


def _rows(schema: pa.Schema, size: int, **given) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(given[f.name], f.type) if f.name in given else pa.nulls(size, f.type) for f in schema], schema=schema)


def _routed(key_type: pa.DataType, columns: str = _ROUTED) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in columns.split(", "))] + [("doc", key_type)])


def _scored(model, key_type: pa.DataType, most: int, ranges: int):
    """A row for each document, and for each slice of texts and range of hashes one of the words that are not among the HEAD and one of the strings that may have a weight and are not among the NEAR."""
    schema = _routed(key_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, weights, bits, head, head_base, head_score, end_known, end_base, end_score = model.value
        for batch in batches:
            numbers, docs, texts = batch.column("number").to_numpy(), batch.column("doc"), batch.column("text").cast(pa.large_binary())
            first = 0
            for part in slices([t or b"" for t in texts.to_pylist()]):
                stream, place, lengths = streams(part)
                own, doc = numbers[first : first + len(part)], np.repeat(np.arange(len(part)), lengths)
                score, far = np.zeros(len(part)), []
                for k, code in enumerate(strings_of(stream, most)):
                    on = np.flatnonzero((place >= k) & maybe(code, bits))
                    at, there, rest = _met(doc[on], code[on], codes)
                    score += np.bincount(there, weights=weights[at], minlength=len(part))
                    far.append((TEXTS, rest))
                words = np.flatnonzero((place > 0) & (place < lengths[doc] - 1))
                at, there, rest = _met(doc[words], stream[words], head)
                far.append((WORDS, rest))
                base = np.bincount(there, weights=head_base[at], minlength=len(part)) + end_base
                score += np.bincount(there, weights=head_score[at], minlength=len(part)) + end_score
                known = np.bincount(there, minlength=len(part)) + end_known
                yield _rows(schema, len(part), range=own % ranges, kind=np.full(len(part), DOCUMENT), number=own, code=np.full(len(part), own[0]), doc=docs.slice(first, len(part)), n=lengths - 1, known=known, base=base, score=score)
                for kind in (WORDS, TEXTS):
                    where, code, times = (np.concatenate(x) for x in zip(*(rest for k, rest in far if k == kind)))
                    order = np.argsort(code.view(np.uint64))
                    where, code, times = where[order], code[order], times[order]
                    cuts = np.searchsorted(range_of(code, ranges), np.arange(ranges + 1))
                    for r in np.flatnonzero(np.diff(cuts)):
                        cut = slice(cuts[r], cuts[r + 1])
                        packed = {"numbers": np.diff(own, prepend=0), "docs": where[cut].astype("<u4"), "codes": np.diff(code[cut], prepend=0), "times": times[cut].astype("<u4")}
                        yield _rows(schema, 1, range=[r], kind=[kind], **{name: [_planes(x)] for name, x in packed.items()})
                first += len(part)

    return run


_SUMS = ("docs", "known", "base", "score")
_WEIGHED = "slice long, kind int, number long, n long, known long, base double, score double, sums binary"


def _weighed(key_type: pa.DataType, unseen: tuple[float, float]):
    """Documents as they are, and a row of sums for each row of a slice's words or strings, from rows in the order of ranges and kinds: a range's costs are held, the others pass by. ``unseen``: the base and the score of a word without a cost."""
    schema = _routed(key_type, _WEIGHED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, tables = None, {}, {}
        for batch in batches:
            at = batch.column("range").to_numpy().astype(np.int64) * 8 + batch.column("kind").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)] if len(at) else [0]
            for lo, hi in zip(edges, edges[1:]):
                part, (r, kind) = batch.slice(lo, hi - lo), divmod(int(at[lo]), 8)
                if r != last:
                    last, held, tables = r, {WORD: [], STRING: []}, {}
                if kind == DOCUMENT:
                    same = {c: part.column(c) for c in ("kind", "number", "n", "known", "base", "score", "doc")}
                    yield _rows(schema, part.num_rows, slice=part.column("code"), **same)
                elif kind in held:
                    held[kind].append([part.column(c).to_numpy(zero_copy_only=False) for c in ("code", "base", "score")])
                else:
                    own = WORD if kind == WORDS else STRING
                    if own not in tables:
                        rows = [np.concatenate(x) for x in zip(*held.pop(own))] or [np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
                        order = np.argsort(rows[0])
                        tables[own] = [x[order] for x in rows]
                    codes, base, score = tables[own]
                    for numbers, docs, code, times in zip(*(part.column(c).to_pylist() for c in ("numbers", "docs", "codes", "times"))):
                        numbers, docs, code, times = np.cumsum(_numbers(numbers, "<i8")), _numbers(docs, "<u4").astype(np.int64), np.cumsum(_numbers(code, "<i8")), _numbers(times, "<u4").astype(np.int64)
                        here, place = member(code, codes)
                        n = len(numbers)
                        found = [np.bincount(docs[here], weights=times[here] * x[place[here]], minlength=n) for x in (base, score)]
                        met, known = np.flatnonzero(np.bincount(docs, minlength=n)), np.zeros(n)
                        if own == WORD:
                            known = np.bincount(docs[here], weights=times[here], minlength=n)
                            found = [x + u * np.bincount(docs[~here], weights=times[~here], minlength=n) for x, u in zip(found, unseen)]
                        yield _rows(schema, 1, slice=numbers[:1], kind=[kind], sums=[np.concatenate([met.astype(np.float64), known[met], *(x[met] for x in found)]).tobytes()])

    return run


def _summed(key_type: pa.DataType):
    """Documents with all their sums, from rows in the order of slices and kinds: a slice's documents are held while its sums pass by."""
    names = ["key", "n_tokens", "n_known", "base_score", "score"]

    def ended(held: list[pa.RecordBatch], sums: list[np.ndarray]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(held).sort_by("number").combine_chunks()
        known, base, score = (whole.column(c).to_numpy() + x for c, x in zip(("known", "base", "score"), sums))
        return pa.RecordBatch.from_arrays([*(whole.column(c).combine_chunks() for c in ("doc", "n")), pa.array(known, pa.int64(), safe=False), pa.array(base), pa.array(score)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, sums = None, [], None
        for batch in batches:
            at = batch.column("slice").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)] if len(at) else [0]
            for lo, hi in zip(edges, edges[1:]):
                part = batch.slice(lo, hi - lo)
                if at[lo] != last:
                    if held:
                        yield ended(held, sums if sums is not None else [0, 0.0, 0.0])
                    last, held, sums = at[lo], [], None
                own = part.column("kind").to_numpy() == DOCUMENT
                if own.any():
                    held.append(part.filter(pa.array(own)))
                for data in part.column("sums").filter(pa.array(~own)).to_pylist():
                    if sums is None:
                        sums = [np.zeros(sum(x.num_rows for x in held)) for _ in _SUMS[1:]]
                    docs, *found = np.frombuffer(data, np.float64).reshape(len(_SUMS), -1)
                    for total, x in zip(sums, found):
                        total[docs.astype(np.int64)] += x
        if held:
            yield ended(held, sums if sums is not None else [0, 0.0, 0.0])

    return run


def score_documents(df: DataFrame, key: str, text: str, train, head: int = HEAD, near: int = NEAR, depth: int = DEPTH, least: int = LEAST, met: int = MET) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every row of ``df``, learnt from those for which ``train`` holds."""
    spark, folder = df.sparkSession, work_folder(df.sparkSession)
    kind = df.schema[key].dataType
    learnt = df.where(train)
    counts = written(symbol_counts(learnt, text), f"{folder}/counts")
    rare = (F.col("both") != END) & (F.col("c") < least)
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("both") == END, F.col("c"))).alias("ends"), F.count_if(F.col("c") == 1).alias("once"), F.count_if(F.col("c") == 2).alias("twice"), F.sum(F.when(rare, F.col("c"))).alias("others"), F.count_if(rare).alias("other_words")).first()
    total, distinct, ends, others, other_words = sums["n"] or 0, sums["v"], sums["ends"] or 0, sums["others"] or 0, sums["other_words"]
    off = min(max(sums["once"] / max(sums["once"] + 2 * sums["twice"], 1), 0.05), 0.95)
    # Each word that is met often, the end and all other words together.
    room = math.log10(total + 0.5 * (distinct - (ends > 0) - other_words + 2))
    other = math.log10(others + 0.5) - room
    # Among the other words, the unknown one has what was taken off.
    unknown = other + (math.log10(max(off * other_words, 0.5) / others) if others else 0.0)

    def root(c: Column, symbol: Column) -> Column:
        return F.when((c >= least) | (symbol == END), F.log10(c + 0.5) - room).when(c > 0, F.log10((c - off) / float(max(others, 1))) + other).otherwise(unknown)

    def base(c: Column) -> Column:
        return F.log10((c + 1) / F.lit(float(total + distinct + 1)))

    alone = counts.select("both", "c", root(F.col("c"), F.col("both")).alias("p"))
    weights = grow(learnt, text, alone, ends, folder, depth, least, met)
    words = alone.where(F.col("both") != END).select(F.col("both").alias("code"), F.col("c").alias("n"), base(F.col("c")).alias("base"), F.col("p").alias("score"))
    # Two bounded tables, of `head` and of `near` rows, sorted by code.
    def most(rows: DataFrame, n: int, *names: str) -> list[np.ndarray]:
        got = rows.orderBy(F.desc("n"), "code").limit(n).select("code", *names).toArrow()
        order = np.argsort(got.column("code").to_numpy())
        return [got.column(name).to_numpy()[order] for name in ("code", *names)]

    (codes, values), (head_codes, head_base, head_score) = most(weights, near, "weight"), most(words, head, "base", "score")
    pa.default_memory_pool().release_unused()
    model = spark.sparkContext.broadcast((codes, values, bitmap(weights, "code"), head_codes, head_base, head_score, int(ends > 0), math.log10((ends + 1) / (total + distinct + 1)), math.log10(ends + 0.5) - room))
    rows = df.select(F.monotonically_increasing_id().alias("number"), F.col(key).alias("doc"), F.col(text).alias("text"))
    ranges = min(max(RANGES, -(-(distinct + weights.count()) // COSTS)), 1 << 20)
    schema = f"{_ROUTED}, doc {kind.simpleString()}"
    routed = rows.mapInArrow(_scored(model, _arrow(kind), depth + 1, ranges), schema)
    costs = words.select(F.lit(WORD).alias("kind"), "code", "base", "score").unionByName(weights.select(F.lit(STRING).alias("kind"), "code", F.lit(0.0).alias("base"), F.col("weight").alias("score")))
    routed = routed.unionByName(costs.withColumn("range", _range_of("code", ranges)), allowMissingColumns=True)
    unseen = math.log10(1 / (total + distinct + 1)), unknown
    weighed = routed.repartitionById(ranges, "range").sortWithinPartitions("range", "kind").mapInArrow(_weighed(_arrow(kind), unseen), f"{_WEIGHED}, doc {kind.simpleString()}")
    sums = weighed.repartition("slice").sortWithinPartitions("slice", "kind").mapInArrow(_summed(_arrow(kind)), f"key {kind.simpleString()}, n_tokens long, n_known long, base_score double, score double")
    scored = written(sums, f"{folder}/scored").select("key", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
    model.destroy()
    return scored


def held_out(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == HELD


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = score_documents(docs, "doc_id", "text", ~held_out("doc_id"))
    return scored.select(F.col("key").alias("doc_id"), held_out("key").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
