"""Forced-choice results: scores, accuracy tables, perplexity windows and resuming."""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import arrays as A

CASE = ["condition", "target_tokens", "depth", "trial"]


def score_candidates(df: DataFrame, prompt: str, candidates: str, scorer: Callable[[str, list[str]], list[float]]) -> DataFrame:
    """Scores of candidates by a model's function, in Arrow batches."""
    @F.pandas_udf("array<double>")
    def scores(p: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([scorer(x, list(y)) for x, y in zip(p, c)])

    return df.withColumn("scores", scores(prompt, candidates))


def byte_overlap(prompt: str, candidates: list[str]) -> list[float]:
    """A stand-in model: how many of a candidate's byte pairs the prompt has, as a log share."""
    seen = {prompt[k : k + 2] for k in range(len(prompt) - 1)}
    return [math.log((1 + sum(c[k : k + 2] in seen for k in range(len(c) - 1))) / (1 + max(len(c) - 1, 0))) for c in candidates]


def forced_choice(df: DataFrame, scores: str = "scores", truth: str = "true_idx") -> DataFrame:
    """The highest score wins, of equal ones the first."""
    return df.withColumn("pred_idx", A.argmax(scores)).withColumn("correct", F.col("pred_idx") == F.col(truth))


def _cells(df: DataFrame, keys: list[str]) -> DataFrame:
    n, right = F.count("*"), F.count_if("correct")
    return df.groupBy(*keys).agg(n.alias("n"), right.alias("n_correct"), F.try_divide(right, n).alias("accuracy"))


def accuracy(df: DataFrame, *keys: str) -> DataFrame:
    return _cells(df, list(keys))


def accuracy_grid(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    """A row for each row key, a column for each value; cells without trials are null."""
    return df.groupBy(row).agg(*[F.try_divide(F.count_if(F.col("correct") & (F.col(column) == v)), F.count_if(F.col(column) == v)).alias(f"acc_{v}") for v in values])


def accuracy_sets(df: DataFrame) -> DataFrame:
    """By language and length, and by language and condition, in one pass."""
    return df.groupingSets([["lang", "target_tokens"], ["lang", "condition"]], "lang", "target_tokens", "condition").agg(F.count("*").alias("n"), F.count_if("correct").alias("n_correct"))


def category_means(scores: DataFrame, categories: dict[str, str]) -> DataFrame:
    """Mean score of each category of tasks and of all, by length."""
    of = F.create_map(*[F.lit(x) for kv in categories.items() for x in kv])
    both = scores.select(F.explode(F.array(of[F.col("task")], F.lit("overall"))).alias("category"), "ctx", "score").where("category is not null")
    return both.groupBy("category", "ctx").agg(F.round(F.avg("score"), 9).alias("mean_score"))


def rank_at(df: DataFrame, column: str, value, by: str, name: str) -> DataFrame:
    """Names by ascending score at one cell."""
    return df.where(F.col(column) == value).withColumn("rank", F.row_number().over(Window.partitionBy(column).orderBy(by, name)))


def windowed_loss(df: DataFrame, loss: str = "loss", length: str = "seq_len") -> DataFrame:
    """Mean loss by length, weighted by scored tokens, and its perplexity."""
    tokens = F.col(length) - 1
    out = df.groupBy(length).agg(F.count("*").alias("windows"), F.try_divide(F.sum(F.col(loss) * tokens), F.sum(tokens)).alias("loss"))
    return out.withColumn("ppl", A.perplexity("loss"))


def last_per_case(df: DataFrame, order: str, keys=CASE) -> DataFrame:
    """The last valid row of each case; depths that agree to 8 digits are one."""
    valid = df.where(F.reduce(F.array(*[F.col(k).isNotNull() for k in keys]), F.lit(True), lambda a, b: a & b))
    case = [F.bround("depth", 8) if k == "depth" else F.col(k) for k in keys]
    row = F.max_by(F.struct("*"), order)
    return valid.groupBy(*[c.alias(f"_k{i}") for i, c in enumerate(case)]).agg(row.alias("_r")).select("_r.*")


def pending_cases(grid: DataFrame, done: DataFrame, keys=CASE) -> DataFrame:
    """Cases of the grid without a result."""
    on = [F.bround(grid[k], 8) == F.bround(done[k], 8) if k == "depth" else grid[k] == done[k] for k in keys]
    return grid.join(done, on, "left_anti")


def with_results(grid: DataFrame, done: DataFrame, keys: list[str], *values: str) -> DataFrame:
    """All cases of the grid with the values of those that have a result."""
    return grid.join(done.select(*keys, *values), keys, "left")


def correct_by_file(results: DataFrame, file: str) -> DataFrame:
    """Rows and correct ones of each result file."""
    return results.groupBy(file).agg(F.count("*").alias("n"), F.count_if("correct").alias("n_correct"))


def disjoint(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """The keys of ``a``; one that ``b`` has as well is an error, so that what is trained on is not evaluated on."""
    both = b.select(F.col(key).alias("_k"), F.lit(True).alias("_both")).distinct()
    clash = F.when(F.col("_both"), F.raise_error(F.concat(F.lit("in both: "), F.col(key).cast("string")))).otherwise(F.col(key))
    return a.select(key).distinct().join(both, F.col(key) == F.col("_k"), "left").select(clash.alias(key))


def spine(spark, **values: list) -> DataFrame:
    """All combinations of the given lists: a grid of stated size."""
    out = spark.range(1)
    for name, items in values.items():
        out = out.withColumn(name, F.explode(F.array(*map(F.lit, items))))
    return out.drop("id")
