"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its features are those of its own characters and
words and of the lines beside it; neighbouring labels are tied by learnt
transitions. Forward and backward passes give each line's marginal, and a
document's score is their mean, weighted by the lines' lengths.

Only documents are labelled. The first passes of the fit take every line to
bear its document's label, each line by itself; the others take the lines'
labels as hidden, each agreeing with its document's with probability AGREE, so
that forward and backward passes under that evidence say what the lines are and
transitions are learnt from their pairs. Learnt from are TRAIN_DOCS labelled
documents at most, by a hash of their ids, and of each at most TRAIN_LINES
lines in a row, from a hashed place on. Only this bounded sample reaches the
driver, as features. Rows whose crc32(id as text) mod FOLDS is 0 are never
learnt from.

Scoring reads whole texts in the task that reads the row; only the text goes to
Python and only the score comes back. Texts are worked on in blocks of lines
whose state is carried on, so a very long text costs three numbers a line and
its distinct lines and words, and is scored as any other.

Defined results: a null text is empty; an empty text is one blank line and is
scored as such; a very long text is scored whole, also as a single line; labels
without a document, or null, are not learnt from, and of several labels of one
document the largest counts; without both labels in the sample all scores are
its share of good ones (1 if there is none); a score of exactly GOOD is good;
repeated rows are scored alike; an empty table gives no rows; further columns
stay as they are, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens

#: Most labelled documents and lines of each that are learnt from; folds; the score from which a document is good.
TRAIN_DOCS, TRAIN_LINES, FOLDS, GOOD = 2500, 48, 5, 0.3
#: Passes of the fit with the lines' labels given, and hidden; how likely a hidden one agrees with its document's; step; weight of the squared norm.
PASSES, HIDDEN, AGREE, STEP, RIDGE = 60, 90, 0.75, 0.15, 1e-3
#: Bytes of lines that are looked at at once, lines from which a text is a chain by itself, and lines of chains that are padded together.
BLOCK, CHAIN, PADDED = 1 << 18, 2048, 200_000

_CLASSES = 7
_RUN = re.compile(rb"\S+")


def _classes() -> np.ndarray:
    """Class of each byte: 0 other, 1 upper case, 2 digit, 3 blank, 4 exclamation mark, 5 symbol, 6 punctuation, 7 beyond ASCII."""
    table = np.zeros(256, np.uint8)
    table[65:91], table[48:58], table[128:] = 1, 2, 7
    for chars, k in ((" \t\x0b\x0c\r", 3), ("!", 4), ("#*$%&|<>@\\^~_=+{}[]/`", 5), (".,;:?'\"-()", 6)):
        table[np.frombuffer(chars.encode(), np.uint8)] = k
    return table


_TABLE = _classes()
OWN = 14
#: Features of a line: its own, those of the line before and after (zeros at the ends), and whether there is one.
WIDTH = 3 * OWN + 2


class _State:
    """What a text's later lines have to know of the earlier ones: hashes of its lines and its words."""

    __slots__ = ("lines", "words")

    def __init__(self):
        self.lines: set = set()
        self.words: set = set()


def _words(line: bytes) -> tuple[int, set, int]:
    """(words, distinct words, length of the longest); a very long line's words are never all held."""
    if len(line) <= BLOCK:
        w = line.split()
        return len(w), set(w), max(map(len, w), default=0)
    n, distinct, longest = 0, set(), 0
    for m in _RUN.finditer(line):
        n, longest = n + 1, max(longest, m.end() - m.start())
        distinct.add(m[0])
    return n, distinct, longest


def own_features(parts: list[tuple[bytes, _State]]) -> tuple[np.ndarray, list[int], np.ndarray]:
    """(features of their own of all lines, lines of each part, weight of each line); a part holds whole lines of a text."""
    buffer = b"\n".join(p for p, _ in parts) + b"\n"
    raw = np.frombuffer(buffer, np.uint8)
    ends = np.flatnonzero(raw == 10)
    starts = np.r_[0, ends[:-1] + 1]
    kinds = _TABLE[raw]
    counts = np.stack([np.add.reduceat(kinds == k, starts, dtype=np.int64) for k in range(1, _CLASSES + 1)], axis=1).astype(float)
    length = (ends - starts).astype(float)
    lines, words, distinct, longest, again, fresh = [], [], [], [], [], []
    for text, state in parts:
        own = text.split(b"\n")
        lines.append(len(own))
        for line in own:
            n, d, most = _words(line)
            words.append(n)
            distinct.append(len(d))
            longest.append(most)
            mark = hash(line)
            again.append(n > 0 and mark in state.lines)
            state.lines.add(mark)
            d -= state.words
            fresh.append(len(d))
            state.words |= d
    words, distinct, longest = (np.array(x, float) for x in (words, distinct, longest))
    n, w = np.maximum(length, 1), np.maximum(words, 1)
    own = np.column_stack([
        counts[:, 0] / n, counts[:, 1] / n, np.minimum(counts[:, 3] / w, 3), np.minimum(counts[:, 4] / w, 3), counts[:, 5] / n, counts[:, 6] / n,
        np.log1p(length) / 8, np.log1p(words) / 6, np.minimum(counts[:, 2], n) / n, np.minimum(n / w, 40) / 10, np.log1p(longest) / 4,
        1 - distinct / w, np.array(again, float), 1 - np.array(fresh, float) / np.maximum(distinct, 1),
    ])
    return own, lines, length + 1


def blocks(texts: list[bytes]) -> Iterator[list[tuple[int, bytes, _State]]]:
    """Parts of texts, in order, some BLOCK bytes of whole lines at once: (text's number, part, its state)."""
    held, size = [], 0
    for number, text in enumerate(texts):
        state, lo = _State(), 0
        while lo <= len(text):
            hi = text.find(b"\n", lo + BLOCK) if len(text) - lo > BLOCK else -1
            hi = len(text) if hi < 0 else hi
            held.append((number, text[lo:hi], state))
            size += hi - lo + 1
            lo = hi + 1
            if size >= BLOCK:
                yield held
                held, size = [], 0
    if held:
        yield held


def line_features(own: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """All features of lines in a row; ``first`` and ``last`` mark the ends of texts."""
    before, after = np.vstack([np.zeros((1, OWN)), own[:-1]]), np.vstack([own[1:], np.zeros((1, OWN))])
    before[first], after[last] = 0, 0
    return np.hstack([own, before, after, first[:, None], last[:, None]])


def window_features(text: bytes, lo: int, lines: int) -> np.ndarray:
    """Features of the lines lo, lo + 1, ... of a text; of all others only what those need is kept."""
    rows, at, total = [], 0, text.count(b"\n") + 1
    for block in blocks([text]):
        own, _, _ = own_features([(part, state) for _, part, state in block])
        rows.append(own[max(0, lo - 1 - at) : max(0, lo + lines + 1 - at)])
        at += len(own)
    own, begin = np.vstack(rows), max(0, lo - 1)
    place = begin + np.arange(len(own))
    return line_features(own, place == 0, place == total - 1)[lo - begin : lo - begin + lines]


def marginals(emit: np.ndarray, mask: np.ndarray, trans: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward-backward over padded chains: emit (docs, lines, 2) are log potentials. Returns node marginals, summed pair marginals and log partition functions."""
    docs, steps, _ = emit.shape
    top = emit.max(axis=2, keepdims=True)
    e, a = np.exp(emit - top), np.exp(trans)
    alpha, scale = np.zeros_like(e), np.ones((docs, steps))
    now = np.exp(start) * e[:, 0]
    for t in range(steps):
        if t:
            now = (alpha[:, t - 1] @ a) * e[:, t]
        total = now.sum(axis=1, keepdims=True)
        on = mask[:, t, None]
        alpha[:, t] = np.where(on, now / total, alpha[:, t - 1] if t else 0.5)
        scale[:, t] = np.where(mask[:, t], total[:, 0], 1)
    beta, pairs = np.ones((docs, 2)), np.zeros((2, 2))
    nodes = np.zeros_like(e)
    for t in range(steps - 1, -1, -1):
        nodes[:, t] = alpha[:, t] * beta
        if t:
            on = mask[:, t, None]
            right = e[:, t] * beta
            joint = alpha[:, t - 1][:, :, None] * a * right[:, None, :] / scale[:, t][:, None, None]
            pairs += joint[mask[:, t]].sum(axis=0)
            beta = np.where(on, (right @ a.T) / scale[:, t][:, None], beta)
    nodes /= nodes.sum(axis=2, keepdims=True)
    return nodes, pairs, (np.log(scale) + np.where(mask, top[:, :, 0], 0)).sum(axis=1)


def chain_marginals(score: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The marginals of being good of one long chain, given each line's log potential of being good; some bytes a line."""
    (aa, ab), (ba, bb) = np.exp(trans).tolist()
    s0, s1 = np.exp(start - start.max()).tolist()
    out = np.empty(len(score))
    good, step = None, 1 << 16
    for lo in range(0, len(score), step):
        part = score[lo : lo + step]
        forward = []
        for e0, e1 in zip(np.exp(-np.maximum(part, 0)).tolist(), np.exp(np.minimum(part, 0)).tolist()):
            if good is None:
                x0, x1 = s0 * e0, s1 * e1
            else:
                x0, x1 = ((1 - good) * aa + good * ba) * e0, ((1 - good) * ab + good * bb) * e1
            good = x1 / (x0 + x1)
            forward.append(good)
        out[lo : lo + step] = forward
    b0 = b1 = 1.0
    for lo in range((len(score) - 1) // step * step, -1, -step):
        part = score[lo : lo + step][::-1]
        nodes = []
        for f, e0, e1 in zip(out[lo : lo + step][::-1].tolist(), np.exp(-np.maximum(part, 0)).tolist(), np.exp(np.minimum(part, 0)).tolist()):
            x0, x1 = (1 - f) * b0, f * b1
            nodes.append(x1 / (x0 + x1))
            y0, y1 = e0 * b0, e1 * b1
            b0, b1 = aa * y0 + ab * y1, ba * y0 + bb * y1
            total = b0 + b1
            b0, b1 = b0 / total, b1 / total
        out[lo : lo + step] = nodes[::-1]
    return out


class Model:
    """Weights of a line's features for being good, and of transitions and starts; features are brought to mean 0 and scale 1."""

    def __init__(self, mean, scale, weights, trans, start, constant=None):
        self.mean, self.scale, self.weights, self.trans, self.start, self.constant = mean, scale, weights, trans, start, constant

    def potentials(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(each line's log potential of being good, its weight) of each text. The features are taken in once, so a line costs three products, whatever the length of its text."""
        slope = self.weights[:-1] / self.scale
        rest = self.weights[-1] - self.mean @ slope
        columns = slope[: 3 * OWN].reshape(3, OWN).T
        parts: list = []
        at = 0

        def whole():
            (product, weight) = (np.concatenate(x) for x in zip(*parts))
            score = product[:, 0] + rest
            score[1:] += product[:-1, 1]
            score[:-1] += product[1:, 2]
            score[0] += slope[-2]
            score[-1] += slope[-1]
            return score, weight

        for block in blocks(texts):
            own, lines, weight = own_features([(part, state) for _, part, state in block])
            product, lo = own @ columns, 0
            for (number, _, _), n in zip(block, lines):
                if number != at:
                    yield whole()
                    parts.clear()
                    at = number
                parts.append((product[lo : lo + n], weight[lo : lo + n]))
                lo += n
        if parts:
            yield whole()

    def scores(self, texts: list[bytes]) -> list[float]:
        """Length-weighted mean of the lines' marginals of being good."""
        if self.constant is not None:
            return [self.constant] * len(texts)
        scores, waiting = np.zeros(len(texts)), []
        held = 0

        def settle() -> None:
            waiting.sort(key=lambda x: len(x[1]))
            lo = 0
            while lo < len(waiting):
                hi, least = lo + 1, len(waiting[lo][1])
                while hi < len(waiting) and len(waiting[hi][1]) <= 1.3 * least + 2:
                    hi += 1
                part = waiting[lo:hi]
                steps = len(part[-1][1])
                emit, w, mask = np.zeros((hi - lo, steps, 2)), np.zeros((hi - lo, steps)), np.zeros((hi - lo, steps), bool)
                for k, (_, score, weight) in enumerate(part):
                    emit[k, : len(score), 1], w[k, : len(score)], mask[k, : len(score)] = score, weight, True
                nodes, _, _ = marginals(emit, mask, self.trans, self.start)
                scores[[number for number, _, _ in part]] = (nodes[:, :, 1] * w).sum(axis=1) / w.sum(axis=1)
                lo = hi
            waiting.clear()

        for number, (score, weight) in enumerate(self.potentials(texts)):
            if len(score) > CHAIN:
                scores[number] = chain_marginals(score, self.trans, self.start) @ weight / weight.sum()
                continue
            waiting.append((number, score, weight))
            held += len(score)
            if held > PADDED:
                settle()
                held = 0
        settle()
        return np.clip(scores, 0, 1).tolist()


def fit(chains: list[tuple[np.ndarray, int]], passes: int = PASSES, hidden: int = HIDDEN) -> Model:
    """Maximise the conditional likelihood of (features of lines in a row, label of their document), with Adam."""
    labels = {y for _, y in chains}
    if len(labels) < 2:
        return Model(None, None, None, None, None, float(next(iter(labels), 1)))
    every = np.vstack([x for x, _ in chains])
    mean, scale = every.mean(axis=0), every.std(axis=0) + 1e-3
    steps = max(len(x) for x, _ in chains)
    data, mask = np.zeros((len(chains), steps, WIDTH + 1)), np.zeros((len(chains), steps), bool)
    gold = np.array([y for _, y in chains])
    for k, (x, _) in enumerate(chains):
        data[k, : len(x), :-1], data[k, : len(x), -1], mask[k, : len(x)] = (x - mean) / scale, 1, True
    flat, on = data.reshape(-1, WIDTH + 1), mask.reshape(-1)
    want_nodes = np.repeat(gold[:, None], steps, axis=1).astype(float)
    want_pairs = np.zeros((2, 2))
    evidence = np.log(AGREE / (1 - AGREE)) * np.stack([gold == 0, gold == 1], axis=-1)[:, None, :]
    theta, m, v = np.zeros(WIDTH + 1 + 4 + 2), 0.0, 0.0
    for step in range(1, passes + hidden + 1):
        w, trans, start = theta[: WIDTH + 1], theta[WIDTH + 1 : WIDTH + 5].reshape(2, 2), theta[-2:]
        score = (flat @ w).reshape(mask.shape)
        emit = np.stack([np.zeros_like(score), score], axis=-1)
        nodes, pairs, _ = marginals(emit, mask, trans, start)
        if step > passes:
            given, want_pairs, _ = marginals(emit + evidence, mask, trans, start)
            want_nodes = given[:, :, 1]
        miss = np.where(on, (want_nodes - nodes[:, :, 1]).reshape(-1), 0)
        begin = (want_nodes[:, 0] - nodes[:, 0, 1]).sum()
        grad = np.concatenate([flat.T @ miss, (want_pairs - pairs).reshape(-1), [-begin, begin]]) / len(chains) - RIDGE * theta
        if step <= passes:
            grad[WIDTH + 1 :] = 0
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + STEP / np.sqrt(step) ** 0.5 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(mean, scale, theta[: WIDTH + 1], theta[WIDTH + 1 : WIDTH + 5].reshape(2, 2), theta[-2:])


def fold(key: str):
    return F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS


def _sampled(lines: int):
    """(label, features as bytes) of labelled texts: of each, so many lines in a row at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts = batch.column("text").cast(pa.large_binary())
            for k, place in enumerate(batch.column("place").to_pylist()):
                text = texts[k].as_py() or b""
                lo = place % max(1, text.count(b"\n") + 2 - lines)
                out.append(window_features(text, lo, lines).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(out, pa.binary())], ["label", "x"])

    return run


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", most: int = TRAIN_DOCS, lines: int = TRAIN_LINES) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold: ``most`` ids, and 4 times as many of their different texts, by hashes that do not look at labels."""
    spark = docs.sparkSession
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & (fold(key) != 0))
    chosen = usable.groupBy(F.col(key).alias("_id")).agg(F.max(label).cast("int").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(most).collect()
    # `most` rows, whatever the input.
    table = spark.createDataFrame([(r["_id"], r["label"]) for r in chosen], T.StructType([T.StructField("_id", labels.schema[key].dataType), T.StructField("label", T.IntegerType())]))
    rows = docs.select(F.col(key).alias("_id"), F.col(text).alias("text")).join(F.broadcast(table), "_id").dropDuplicates(["_id", "text"])
    rows = rows.select("label", "text", F.pmod(F.xxhash64("_id", F.lit("place")), F.lit(1 << 30)).alias("place"))
    got = rows.mapInArrow(_sampled(lines), "label int, x binary").withColumn("h", F.sha2("x", 256)).orderBy("h", "label").limit(4 * most).collect()
    got.sort(key=lambda r: (r["label"], r["h"]))
    return fit([(np.frombuffer(r["x"], "<f4").astype(float).reshape(-1, WIDTH), r["label"]) for r in got])


def scorer(model: Model):
    """A column function from a text to its score."""

    def scored(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens.release()
        for column in columns:
            column, out = column.cast(pa.large_binary()), []
            for lo in range(0, len(column), 512):
                out.extend(model.scores([t or b"" for t in column.slice(lo, 512).to_pylist()]))
            yield pa.array(out, pa.float64())

    return F.arrow_udf(scored, "double")


def score(df: DataFrame, text: str, model: Model, out: str = "score") -> DataFrame:
    """``df`` as it is and each text's score in a further column ``out``, which may not be one of its own."""
    if out in df.columns:
        raise ValueError(f"{out} is a column already; choose another name for the score")
    return df.withColumn(out, scorer(model)(F.coalesce(F.col(text), F.lit(""))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, "text", model).select("doc_id", "score")
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"))
