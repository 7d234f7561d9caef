"""Top keys of queries over embeddings, and how much of the attention mass they hold."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch

#: Rows of a block of queries, and of keys.
BLOCK = 1024


def _blocks(df: DataFrame, key: str, vector: str, parts: int, name: str) -> DataFrame:
    """Rows (block, ids, vectors) of at most about BLOCK rows each, dealt out by hash."""
    block = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    return df.select(block.alias(name), F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v")).groupBy(name).agg(F.collect_list("id").alias(f"{name}_ids"), F.collect_list("v").alias(f"{name}_vectors"))


def _nearest(k: int, causal: bool, relu: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                qi, ki = np.array(row.q_ids), np.array(row.k_ids)
                scores = np.array(list(map(list, row.q_vectors)), np.float64) @ np.array(list(map(list, row.k_vectors)), np.float64).T
                if relu:
                    scores = np.maximum(scores, 0)
                if causal:
                    scores = np.where(ki[None, :] <= qi[:, None], scores, -np.inf)
                order = np.lexsort((np.broadcast_to(ki, scores.shape), -scores), axis=1)[:, :k]
                top = np.take_along_axis(scores, order, axis=1)
                on = np.isfinite(top)
                yield pd.DataFrame({"query": np.repeat(qi, on.sum(axis=1)), "key": ki[order][on], "score": top[on]})

    return run


def topk(df: DataFrame, key: str, vector: str, k: int, every: int = 1, causal: bool = True, relu: bool = False, rows: int | None = None, pad: bool = False) -> DataFrame:
    """(query, rank, key, score): of each query the k keys with the highest dot products, of equal ones the smaller id.

    Queries are the rows whose id is divisible by ``every``; keys are all rows,
    when causal those up to the query's. Blocks of queries meet blocks of keys,
    each pair of blocks is one matrix product, and only k rows a query leave it.
    """
    n = rows or df.count()
    queries = _blocks(df.where(F.col(key) % every == 0), key, vector, max(1, n // every // BLOCK), "q")
    keys = _blocks(df, key, vector, max(1, n // BLOCK), "k")
    part = queries.crossJoin(keys).mapInPandas(_nearest(k, causal, relu), "query long, key long, score double")
    ranked = part.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "key"))).where(F.col("rank") <= k)
    if not pad:
        return ranked.select("query", "rank", "key", "score")
    spine = ranked.select("query").distinct().withColumn("rank", F.explode(F.sequence(F.lit(1), F.lit(k))))
    return spine.join(ranked, ["query", "rank"], "left").select("query", "rank", F.coalesce("key", F.lit(-1)).alias("key"), "score")


class _Sums:
    """What a block of queries has met so far: of each query the number of keys, the highest and lowest score, the sum of exponentials below the highest, and the k highest with their keys."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k, n = ids, k, len(ids)
        self.n, self.high, self.low, self.total = np.zeros(n, np.int64), np.full(n, -np.inf), np.full(n, np.inf), np.zeros(n)
        self.scores, self.keys = np.zeros((n, 0)), np.zeros((n, 0), np.int64)

    def meet(self, scores: np.ndarray, on: np.ndarray, keys: np.ndarray) -> None:
        scores = np.where(on, scores, -np.inf)
        high = np.maximum(self.high, scores.max(axis=1, initial=-np.inf))
        sure = np.where(np.isfinite(high), high, 0)
        self.total = self.total * np.exp(np.where(np.isfinite(self.high), self.high - sure, -np.inf)) + np.exp(scores - sure[:, None]).sum(axis=1)
        self.high, self.low, self.n = high, np.minimum(self.low, np.where(on, scores, np.inf).min(axis=1, initial=np.inf)), self.n + on.sum(axis=1)
        if self.k:
            both, names = np.hstack([self.scores, scores]), np.hstack([self.keys, np.broadcast_to(keys, scores.shape)])
            order = np.lexsort((names, -both), axis=1)[:, : self.k]
            self.scores, self.keys = np.take_along_axis(both, order, axis=1), np.take_along_axis(names, order, axis=1)

    def rows(self) -> pd.DataFrame:
        best = [[(s, int(k)) for s, k in zip(a, b) if np.isfinite(s)] for a, b in zip(self.scores.tolist(), self.keys.tolist())]
        return pd.DataFrame({"query": self.ids, "n": self.n, "high": self.high, "low": self.low, "total": self.total, "best": [[{"score": s, "key": k} for s, k in x] for x in best]})[self.n > 0]


def _products(row, causal: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, key ids, scores, which of them count) of a pair of blocks."""
    qi, ki = np.array(row.q_ids), np.array(row.k_ids)
    scores = np.array(list(map(list, row.q_vectors)), np.float64) @ np.array(list(map(list, row.k_vectors)), np.float64).T
    return qi, ki, scores, (ki[None, :] <= qi[:, None]) if causal else np.ones(scores.shape, bool)


def _pairs(df: DataFrame, key: str, vector: str, every: int, state: DataFrame | None = None) -> DataFrame:
    n = df.count()
    chosen = df.where(F.col(key) % every == 0)
    extra = [c for c in state.columns if c != "query"] if state is not None else []
    chosen = chosen.join(state, F.col(key) == F.col("query")) if state is not None else chosen
    block = F.pmod(F.xxhash64(key), F.lit(max(1, n // every // BLOCK))).cast("int")
    rows = chosen.select(block.alias("q"), F.struct(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("v"), *extra).alias("x"))
    queries = rows.groupBy("q").agg(F.collect_list("x").alias("x")).select("q", F.col("x.id").alias("q_ids"), F.col("x.v").alias("q_vectors"), *[F.col(f"x.{c}").alias(f"q_{c}") for c in extra])
    return queries.crossJoin(_blocks(df, key, vector, max(1, n // BLOCK), "k"))


def masses(df: DataFrame, key: str, vector: str, k: int, every: int = 1, causal: bool = True) -> DataFrame:
    """(query, n, high, low, total, best): of each query the keys it sees, the highest and lowest dot product, the sum of exponentials of all below the highest, and the k best keys with their scores.

    The softmax of a score is exp(score - high) / total, so no pair of a query
    and a key leaves the block in which it is worked out: a task adds up what
    its pairs of blocks say of a query, and sends a row of k keys for it.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, _Sums] = {}
        for frame in frames:
            for row in frame.itertuples():
                qi, ki, scores, on = _products(row, causal)
                if row.q not in held:
                    yield from (x.rows() for x in held.values())
                    held = {row.q: _Sums(qi, k)}
                held[row.q].meet(scores, on, ki)
        yield from (x.rows() for x in held.values())

    parts = _pairs(df, key, vector, every).mapInPandas(run, "query long, n long, high double, low double, total double, best array<struct<score double, key long>>")
    merged = parts.groupBy("query").agg(F.sum("n").alias("n"), F.max("high").alias("high"), F.min("low").alias("low"), F.collect_list(F.struct("high", "total")).alias("_t"), F.flatten(F.collect_list("best")).alias("_b"))
    total = F.aggregate("_t", F.lit(0.0), lambda a, x: a + x["total"] * F.exp(x["high"] - F.col("high")))
    best = F.slice(F.array_sort(F.transform("_b", lambda x: F.struct((-x["score"]).alias("s"), x["key"].alias("key")))), 1, max(k, 1)) if k else F.array()
    return merged.select("query", "n", "high", "low", total.alias("total"), (F.transform(best, lambda x: F.struct((-x["s"]).alias("score"), x["key"].alias("key"))) if k else F.col("_b")).alias("best"))


def recall_by_quarter(sums: DataFrame, n: int) -> DataFrame:
    """Share of the mass on the best keys, over all queries and by quarter of their places (0 to n - 1), and how many pairs there are."""
    mass = F.aggregate("best", F.lit(0.0), lambda a, x: a + F.exp(x["score"] - F.col("high"))) / F.col("total")
    quarter = sum((F.when(F.col("query") >= (k * n) // 4, 1).otherwise(0) for k in (1, 2, 3)), F.lit(0))
    rows = sums.select(mass.alias("mass"), "n", F.explode(F.array(F.lit(-1), quarter)).alias("quarter"))
    return rows.groupBy("quarter").agg(F.avg("mass").alias("recall"), F.sum("n").alias("pairs"))


#: Cells that a level of a search cuts a range of scores into, and levels.
CELLS, LEVELS = 64, 2


def _cells(scores: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of each score its cell between a query's bounds; a higher score is never in a lower cell."""
    width = np.where(high > low, high - low, 1.0)
    return np.clip(np.floor((scores - low[:, None]) / width[:, None] * CELLS), 0, CELLS - 1).astype(np.int64)


def _within(row, scores: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(which scores are in the cells chosen so far, bounds of the last one), found anew from the first bounds in the same way each time."""
    low, high = (np.array(list(map(float, x))) for x in (row.q_low, row.q_high))
    for level in range(len(row.q_path[0])):
        chosen = np.array([p[level] for p in row.q_path])
        on = on & (_cells(scores, low, high) == chosen[:, None])
        step = (high - low) / CELLS
        low, high = low + chosen * step, low + (chosen + 1) * step
    return on, low, high


def compressibility(df: DataFrame, key: str, vector: str, fraction: float, every: int = 1, causal: bool = True) -> DataFrame:
    """Mean over queries of the mass on each one's ceil(fraction * keys) heaviest keys.

    The score from which on keys count is searched for: each block says how many
    scores of a query lie in each of CELLS cells, and their mass; the cell in
    which the last key falls is cut again. After LEVELS of these only the scores
    of that last cell, each distinct one with its number, leave the blocks.
    """
    state = masses(df, key, vector, 0, every, causal).select("query", "high", "low", "total", F.ceil(F.col("n") * fraction).alias("take"), F.lit(0).cast("long").alias("above"), F.lit(0.0).alias("mass"), F.array().cast("array<int>").alias("path"))
    state = _kept(state)

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                qi, _, scores, on = _products(row, causal)
                top = np.array(list(row.q_high))
                on, low, high = _within(row, scores, on)
                q, k = np.nonzero(on)
                place = q * CELLS + _cells(scores, low, high)[q, k]
                n = np.bincount(place, minlength=len(qi) * CELLS)
                weight = np.bincount(place, np.exp(scores[q, k] - top[q]), minlength=len(qi) * CELLS)
                at = np.flatnonzero(n)
                yield pd.DataFrame({"query": qi[at // CELLS], "cell": at % CELLS, "n": n[at], "weight": weight[at]})

    def last(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                qi, _, scores, on = _products(row, causal)
                q, k = np.nonzero(_within(row, scores, on)[0])
                yield pd.DataFrame({"query": qi[q], "score": scores[q, k]}).groupby(["query", "score"], as_index=False).size().rename(columns={"size": "n"})

    down = Window.partitionBy("query").orderBy(F.desc("cell"))
    for _ in range(LEVELS):
        cells = _pairs(df, key, vector, every, state.select("query", "high", "low", "path")).mapInPandas(counted, "query long, cell int, n long, weight double")
        cells = cells.groupBy("query", "cell").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))
        upto = cells.withColumns({"_n": F.sum("n").over(down), "_w": F.sum("weight").over(down)}).join(state, "query").where(F.col("above") + F.col("_n") >= F.col("take"))
        first = upto.groupBy("query").agg(F.max_by(F.struct("cell", (F.col("_n") - F.col("n")).alias("n"), (F.col("_w") - F.col("weight")).alias("w")), "cell").alias("c"))
        state = _kept(state.join(first, "query").select("query", "high", "low", "total", "take", (F.col("above") + F.col("c.n")).alias("above"), (F.col("mass") + F.col("c.w")).alias("mass"), F.concat("path", F.array("c.cell")).alias("path")))
    rest = _pairs(df, key, vector, every, state.select("query", "high", "low", "path")).mapInPandas(last, "query long, score double, n long")
    rest = rest.groupBy("query", "score").agg(F.sum("n").alias("n")).withColumn("_n", F.sum("n").over(Window.partitionBy("query").orderBy(F.desc("score"))))
    used = F.greatest(F.lit(0), F.least(F.col("n"), F.col("take") - F.col("above") - (F.col("_n") - F.col("n"))))
    per = state.join(rest, "query").groupBy("query", "mass", "total").agg(F.sum(used * F.exp(F.col("score") - F.col("high"))).alias("more"))
    return per.agg(F.avg((F.col("mass") + F.col("more")) / F.col("total")).alias("mass"))


def _kept(df: DataFrame) -> DataFrame:
    """Written and read back, so that a next step does not work it out again."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def layer_pattern(masses: DataFrame, layer: str, mass: str, fraction: float) -> DataFrame:
    """S for the bround(fraction * n) layers with the most mass, F for the others, in order. A row for each layer."""
    ranked = masses.withColumns({"_r": F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc(mass), layer)), "_n": F.count("*").over(Window.partitionBy(F.lit(0)))})
    mark = F.when(F.col("_r") <= F.bround(F.col("_n") * fraction), "S").otherwise("F")
    return ranked.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(layer).alias("l"), mark.alias("m")))), lambda x: x["m"]), "").alias("pattern"))


def overlap(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    """Mean share of keys that two selections have in common."""
    sets = lambda df, n: df.groupBy("query").agg(F.collect_set("key").alias(n))
    both = sets(a, "x").join(sets(b, "y"), "query")
    return both.agg(F.count("*").alias("queries"), F.round(F.avg(F.size(F.array_intersect("x", "y")) / k), 9).alias("overlap"))
