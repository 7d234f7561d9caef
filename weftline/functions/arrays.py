"""Array functions: choices, rotations, fillers, position ids and vector arithmetic."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col


def argmax(scores) -> Column:
    """Place of the highest score from 0; of equal ones, the first."""
    return (F.array_position(col(scores), F.array_max(col(scores))) - 1).cast("int")


def rotated(values) -> Column:
    """Each value moved one place to the front, the first to the end."""
    v = col(values)
    return F.when(F.size(v) == 0, v).otherwise(F.concat(F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, 1, 1)))


def inserted(values, depth, item) -> Column:
    """The item put in before place int(n * depth)."""
    v = col(values)
    return F.array_insert(v, (F.floor(F.size(v) * col(depth)) + 1).cast("int"), col(item))


def cycled(values, n) -> Column:
    """The first n of the values repeated without end."""
    v, n = col(values), col(n)
    return F.when(n <= 0, F.slice(v, 1, 0)).otherwise(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(v, i % F.size(v))))


def hash_order(values, seed: int) -> Column:
    """The values in the order of their hashes with a seed: a shuffle that any engine can repeat."""
    keyed = F.transform(col(values), lambda x: F.struct(F.sha2(F.concat(F.lit(f"{seed}|"), x.cast("string")), 256).alias("h"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda s: s["x"])


def windows(n, length: int, most: int) -> Column:
    """Starts of the first ``most`` windows of a length that end before the last of n places."""
    last = col(n) - length - 1
    return F.when(last < 0, F.array().cast("array<int>")).otherwise(F.slice(F.sequence(F.lit(0), last.cast("int"), F.lit(length)), 1, most))


def evenly(n, most: int = 64) -> Column:
    """At most so many places from 0 to n - 1, evenly spaced, rounded half to even."""
    n = col(n)
    m = F.least(n, F.lit(most))
    return F.when(m <= 1, F.array(F.lit(0))).otherwise(F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.bround(i * (n - 1) / (m - 1)).cast("int")))


def position_ids(length, most: int, strategy: str = "contiguous", draw=None, query_start=None, evidence_start=None, depth=None) -> Column:
    """Position ids of a text of a length within a span of ``most``.

    ``draw`` in [0, 1) stands for chance. ``offset`` and ``far`` shift all ids,
    by any offset or one in the last quarter; ``bridge`` puts what comes from
    the query on at the end of the span and the evidence at its depth.
    """
    n = col(length)
    base = F.sequence(F.lit(0), n - 1)
    if strategy == "contiguous":
        return base
    room = F.greatest(F.lit(most) - n, F.lit(0))
    if strategy in ("offset", "far"):
        low = F.floor(room * 0.75) if strategy == "far" else F.lit(0)
        shift = (low + F.floor(col(draw) * (room + 1 - low))).cast("int")
        return F.transform(base, lambda i: i + shift)
    if strategy != "bridge":
        raise ValueError(f"no position strategy {strategy!r}")
    if query_start is None:
        return F.when(n <= 1, base).otherwise(F.transform(base, lambda i: F.bround(i * F.lit(float(most - 1)) / (n - 1)).cast("int")))
    start = F.least(F.greatest(col(query_start), F.lit(0)), n)
    tail = F.greatest(n - start, F.lit(1))
    tail_start = F.greatest(F.lit(most) - tail, F.lit(0))
    evidence = F.bround(col(depth) * F.greatest(tail_start - 1, F.lit(0))).cast("int")
    before = F.greatest(evidence - F.least(col(evidence_start), start), F.lit(0))
    shift = F.greatest(before + start - tail_start, F.lit(0))
    head = F.when(start == 0, F.array().cast("array<int>")).otherwise(F.transform(F.sequence(F.lit(0), start - 1), lambda i: F.greatest(i + before - shift, F.lit(0)).cast("int")))
    return F.concat(head, F.transform(F.sequence(F.lit(0), tail - 1), lambda i: (i + tail_start).cast("int")))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda t, x: t + x)


def relu_dot(a, b, weight=1.0) -> Column:
    return F.greatest(dot(a, b), F.lit(0.0)) * weight


def softmax(scores) -> Column:
    top = F.array_max(col(scores))
    e = F.transform(col(scores), lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda t, y: t + y))


def contrastive_loss(scores, truth: int = 0, temperature: float = 1.0) -> Column:
    """Cross entropy of the softmax of candidates' scores at the true one."""
    s = F.transform(col(scores), lambda x: x / temperature)
    top = F.array_max(s)
    return top + F.log(F.aggregate(F.transform(s, lambda x: F.exp(x - top)), F.lit(0.0), lambda t, y: t + y)) - F.get(s, F.lit(truth))


def perplexity(nll) -> Column:
    return F.exp(F.least(F.lit(20.0), col(nll)))


def wavelength(theta, dims: int) -> Column:
    """Longest wavelength of rotary positions with a base."""
    return 2 * math.pi * F.pow(col(theta), F.lit((dims - 2) / dims))


def log_schedule(progress, start: float, end: float) -> Column:
    """From start to end evenly in logarithms, rounded half to even."""
    return F.bround(F.exp(F.log(F.lit(float(start))) + col(progress) * (F.log(F.lit(float(end))) - F.log(F.lit(float(start)))))).cast("long")


def depth_schedule(step, depths: list[float], every: int) -> Column:
    """The depth of a step: the next of the list after ``every`` steps, the last one from there on."""
    place = F.least(F.floor(col(step) / every), F.lit(len(depths) - 1)).cast("int")
    return F.get(F.array(*map(F.lit, depths)), place)


def every_k(step, layer, every: int) -> Column:
    """Whether a layer is looked at in a step: layers take turns, counted from 1."""
    return F.pmod(col(step) - 1, F.lit(every)) == F.pmod(col(layer) - 1, F.lit(every))


def suffix_loss(losses, n: int) -> Column:
    """Mean of the last n losses of a text, or of all if there are fewer."""
    tail = F.slice(col(losses), -F.least(F.lit(n), F.size(col(losses))), F.least(F.lit(n), F.size(col(losses))))
    return F.when(F.size(col(losses)) == 0, F.lit(None).cast("double")).otherwise(F.aggregate(tail, F.lit(0.0), lambda t, x: t + x) / F.size(tail))


def masked(values, keep, fill: float) -> Column:
    """The values, with another one where ``keep`` does not hold."""
    return F.zip_with(col(values), col(keep), lambda x, k: F.when(k, x.cast("double")).otherwise(F.lit(fill)))


def divergence(p, q) -> Column:
    """Kullback-Leibler divergence of the softmax of scores q from that of p."""
    return F.aggregate(F.zip_with(softmax(p), softmax(q), lambda a, b: a * (F.log(a) - F.log(b))), F.lit(0.0), lambda t, x: t + x)


def reached(values, mass: float) -> Column:
    """How many of the values, largest first, have so much of their sum together."""
    v = F.sort_array(col(values), asc=False)
    total = F.aggregate(v, F.lit(0.0), lambda t, x: t + x)
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"))
    return F.aggregate(v, start, lambda a, x: F.struct((a["s"] + x).alias("s"), (a["n"] + F.when(a["s"] < mass * total, 1).otherwise(0)).alias("n")), lambda a: a["n"])


def hadamard(values) -> Column:
    """The normalised Walsh-Hadamard transform of an array whose length is a power of two."""
    @F.pandas_udf("array<double>")
    def of(series: pd.Series) -> pd.Series:
        def one(v):
            x = np.asarray(v, float)
            n, h = len(x), 1
            if n & (n - 1) or not n:
                raise ValueError("the length is no power of two")
            while h < n:
                x = x.reshape(-1, 2, h)
                x = np.stack([x[:, 0] + x[:, 1], x[:, 0] - x[:, 1]], axis=1).reshape(-1)
                h *= 2
            return x / np.sqrt(n)

        return series.map(one)

    return of(col(values))
