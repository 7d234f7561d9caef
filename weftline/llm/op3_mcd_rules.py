"""Quality rules: base limits, then robust multivariate outliers by language and source.

Every document has a vector of transformed statistics. For each language and
source, and for each language, the minimum covariance determinant is estimated:
from two starts, medians with quartiles and the moments of all rows,
concentration steps move to the mean and covariance of the SHARE of rows that
are nearest, until the determinants stay; the start with the least one counts,
and a last step takes all rows within the 0.975 quantile. A source's estimate
is the mean of its own and its language's, weighted by its rows and by PRIOR, so
sources of any size are judged alike and small ones lean on their language. A
document is rejected beyond the CUTOFF quantile of the squared Mahalanobis
distance. Least scales are added to the diagonal, so that a statistic that
nearly all documents share, such as no symbols at all, does not reject
everything else.

Only built-in functions run, and all of it is distributed: a group's estimate
is a row of a table, thresholds are approximate quantiles, and moments are
sums with partial aggregates. Rows meet the estimates under a salt, so a source
that holds a third of all rows is dealt to SALTS tasks.

Defined results: a null text is empty; empty texts fail the base limits; a very
long text's statistics are those of all of it; null languages and sources are
the empty ones; a row on the limit stays; rows with the same key are documents of
their own; an empty table gives no rows; further columns are ignored, whatever
their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANK, work_folder, written

#: Share of a concentration step; most steps, and the change of the logarithms of determinants at which they stay; rows that a language's estimate counts as; salts; words and per cent of repeated words of the base limits.
SHARE, STEPS, STAYS, PRIOR, SALTS, LEAST_WORDS, MOST_REPEATED = 0.75, 8, 0.02, 50, 48, 50, 50
#: Quantiles of chi-square with 4 degrees of freedom, fixed values: at SHARE, at 0.975 and at 0.999, beyond which documents are rejected.
AT_SHARE, AT_STEP, CUTOFF = 5.385, 11.143, 18.467
#: Least scale of each transformed statistic: log of the mean word length, log of symbols per 100 characters, share of repeated words, share of repeated lines.
VECTOR = {"x0": 0.12, "x1": 0.4, "x2": 0.12, "x3": 0.12}
P = len(VECTOR)


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _repeated(words: Column) -> Column:
    """Words within 3-word windows that the array of words has twice or more: one sort brings windows with the same hash together, and neighbours are compared word by word."""
    n = F.size(words)
    at = lambda i: F.get(words, i)
    hashed = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.cast("int").alias("i")))

    def marked(s: Column) -> Column:
        same = lambda i, j: (at(i) == at(j)) & (at(i + 1) == at(j + 1)) & (at(i + 2) == at(j + 2))
        pairs = F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, c: F.when((a["h"] == c["h"]) & same(a["i"], c["i"]), F.array(a["i"], c["i"])))
        found = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))))
        covered = lambda q: F.when(F.size(q) == 0, 0).otherwise(3 + F.aggregate(F.zip_with(F.slice(q, 1, F.greatest(F.size(q) - 1, F.lit(0))), F.slice(q, 2, F.greatest(F.size(q) - 1, F.lit(0))), lambda a, c: F.least(F.lit(3), c - a)), F.lit(0), lambda t, x: t + x))
        return _let(found, covered)

    return F.when(n < 4, F.lit(0)).otherwise(_let(F.sort_array(hashed), marked)).cast("long")


def statistics(df: DataFrame, key: str, text: str, lang: str, source: str) -> DataFrame:
    """(key, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of every whole text."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, f"[{BLANK}]+"), lambda w: w != "")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    bare = t
    for blank in " \t\n\x0b\x0c\r":
        bare = F.replace(bare, F.lit(blank), F.lit(""))
    from_words = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).alias("n_repeat_words")))
    from_lines = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return df.select(
        F.col(key).alias("key"), F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.xxhash64(text).alias("text_hash"),
        F.length(bare).cast("long").alias("word_chars"), F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"), from_words.alias("w"), from_lines.alias("l"),
    ).select("key", "lang", "source", "text_hash", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines")


def vectors(stats: DataFrame) -> DataFrame:
    n, c = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return stats.withColumns({
        "base_failed": failed,
        "x0": F.log(c / n), "x1": F.log1p(100 * F.col("n_symbols") / c), "x2": F.col("n_repeat_words") / n, "x3": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "salt": F.pmod(F.xxhash64("key", "text_hash"), F.lit(SALTS)).cast("int"),
    })


def _salted(estimates: DataFrame) -> DataFrame:
    return estimates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _meet(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    return rows.join(_salted(estimates), ["g", "salt"])


def _source() -> Column:
    return F.to_json(F.array("lang", "source"))


def _lang() -> Column:
    return F.to_json(F.array("lang"))


def _with_distance(rows: DataFrame) -> DataFrame:
    """Column d: the squared Mahalanobis distance, by forward substitution in the Cholesky factor (l00, l10, ...)."""
    for i in range(P):
        value = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            value = value - F.col(f"l{i}{j}") * F.col(f"z{j}")
        rows = rows.withColumn(f"z{i}", value / F.col(f"l{i}{i}"))
    return rows.withColumn("d", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, P)), F.col("z0") * F.col("z0")))


def consistency(share: float, quantile: float) -> float:
    """What makes the covariance of the nearest ``share`` of a normal sample that of the whole, for 4 dimensions."""
    h = quantile / 2
    return share / (1 - math.exp(-h) * (1 + h + h * h / 2))


PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def _cholesky(table: DataFrame) -> DataFrame:
    """Columns l00, l10, ... from c00, c10, ..."""
    for i in range(P):
        for j in range(i + 1):
            value = F.col(f"c{i}{j}")
            for k in range(j):
                value = value - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            table = table.withColumn(f"l{i}{j}", F.sqrt(F.greatest(value, F.lit(VECTOR[f"x{i}"] ** 2 / 4))) if i == j else value / F.col(f"l{j}{j}"))
    return table


def _estimate(near: DataFrame, factor: float) -> DataFrame:
    """Mean, covariance and its Cholesky factor of each group's rows; moments are taken about the previous mean."""
    centred = near.withColumns({f"y{i}": F.col(f"x{i}") - F.col(f"m{i}") for i in range(P)})
    sums = centred.groupBy("g").agg(
        F.count("*").cast("double").alias("n"), *[F.first(f"m{i}").alias(f"b{i}") for i in range(P)], *[F.sum(f"y{i}").alias(f"s{i}") for i in range(P)], *[F.sum(F.col(f"y{i}") * F.col(f"y{j}")).alias(f"q{i}{j}") for i, j in PAIRS]
    )
    table = sums.withColumns({f"c{i}{j}": factor * (F.col(f"q{i}{j}") / F.col("n") - F.col(f"s{i}") / F.col("n") * F.col(f"s{j}") / F.col("n")) + (F.lit(VECTOR[f"x{i}"] ** 2) if i == j else F.lit(0.0)) for i, j in PAIRS})
    table = _cholesky(table.withColumns({f"m{i}": F.col(f"b{i}") + F.col(f"s{i}") / F.col("n") for i in range(P)}))
    return table.select("g", *MEANS, *FACTORS, *[f"c{i}{j}" for i, j in PAIRS])


MEANS, FACTORS = [f"m{i}" for i in range(P)], [f"l{i}{j}" for i, j in PAIRS]


def _log_det() -> Column:
    return 2 * sum((F.log(f"l{i}{i}") for i in range(1, P)), F.log("l00"))


def estimates(rows: DataFrame, folder: str, steps: int = STEPS) -> DataFrame:
    """One row for each group, a language's source or a language: its mean, its covariance and the Cholesky factor of that."""
    usable = rows.where(~F.col("base_failed")).select("salt", *VECTOR, F.explode(F.array(_source(), _lang())).alias("g"))
    usable = written(usable, f"{folder}/usable")
    quartiles = usable.groupBy("g").agg(*[F.percentile_approx(f"x{i}", [0.25, 0.5, 0.75], 2000).alias(f"p{i}") for i in range(P)])
    start = {f"m{i}": F.col(f"p{i}")[1] for i in range(P)}
    # The distance between quartiles of a normal sample is 1.349 of its scale.
    start |= {f"l{i}{j}": F.sqrt(F.pow((F.col(f"p{i}")[2] - F.col(f"p{i}")[0]) / 1.349, 2) + VECTOR[f"x{i}"] ** 2) if i == j else F.lit(0.0) for i, j in PAIRS}
    table = written(quartiles.select("g", *[v.alias(k) for k, v in start.items()]), f"{folder}/start")
    whole = _estimate(_meet(usable, table), 1.0).select("g", *MEANS, *FACTORS)
    table = written(table.withColumn("s", F.lit(0)).unionByName(whole.withColumn("s", F.lit(1))).withColumn("g", F.concat_ws("#", "g", "s")).drop("s"), f"{folder}/starts")
    both = usable.withColumn("s", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("g", F.concat_ws("#", "g", "s")).drop("s")
    last = None
    for step in range(steps):
        met = _with_distance(_meet(both, table.select("g", *MEANS, *FACTORS)))
        limits = met.groupBy("g").agg(F.percentile_approx("d", SHARE, 2000).alias("limit"))
        limited = written(table.select("g", *MEANS, *FACTORS).join(limits, "g"), f"{folder}/limit{step}")
        near = _with_distance(_meet(both, limited)).where(F.col("d") <= F.col("limit"))
        table = written(_estimate(near, consistency(SHARE, AT_SHARE)).withColumn("det", _log_det()), f"{folder}/step{step}")
        if last is not None:
            moved = table.join(last.select("g", F.col("det").alias("before")), "g").agg(F.max(F.abs(F.col("det") - F.col("before")))).first()[0]
            if moved is None or moved <= STAYS:
                break
        last = table
    best = table.groupBy(F.expr("left(g, length(g) - 2)").alias("group")).agg(F.min_by(F.struct(*MEANS, *FACTORS), F.struct("det", "g")).alias("e"))
    best = written(best.select(F.col("group").alias("g"), "e.*"), f"{folder}/best")
    near = _with_distance(_meet(usable, best)).where(F.col("d") <= AT_STEP)
    # Something is always that near: the mean of SHARE of the rows is.
    return written(_estimate(near, consistency(0.975, AT_STEP)), f"{folder}/last")


def shrunk(rows: DataFrame, table: DataFrame, folder: str, prior: float = PRIOR) -> DataFrame:
    """One row for each language and source: the estimate of the source leaning on that of its language."""
    counts = rows.where(~F.col("base_failed")).groupBy("lang", "source").agg(F.count("*").cast("double").alias("n"))
    names = [*MEANS, *[f"c{i}{j}" for i, j in PAIRS]]
    of = lambda prefix: table.select(F.col("g").alias(f"{prefix}g"), *[F.col(x).alias(f"{prefix}{x}") for x in names])
    met = counts.join(of("s_"), _source() == F.col("s_g"), "left").join(of("l_"), _lang() == F.col("l_g"))
    own = F.col("n") / (F.col("n") + prior)
    mixed = met.select("lang", "source", *[F.coalesce(own * F.col(f"s_{x}") + (1 - own) * F.col(f"l_{x}"), F.col(f"l_{x}")).alias(x) for x in names])
    return written(_cholesky(mixed).select("lang", "source", *MEANS, *FACTORS), f"{folder}/shrunk")


def judge(df: DataFrame, key: str, text: str, lang: str = "lang", source: str = "source", prior: float = PRIOR, cutoff: float = CUTOFF) -> DataFrame:
    """(key, lang, source, text_hash, statistics, base_failed, distance, kept) of every row of ``df``; null languages and sources are empty."""
    folder = work_folder(df.sparkSession)
    stats = written(statistics(df, key, text, lang, source), f"{folder}/stats")
    rows = vectors(stats)
    table = shrunk(rows, estimates(rows, folder), folder, prior)
    judged = _with_distance(rows.join(_salted(table), ["lang", "source", "salt"], "left"))
    return judged.select(
        "key", "lang", "source", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", F.col("d").alias("distance"), (~F.col("base_failed") & (F.coalesce("d", F.lit(0.0)) <= cutoff)).alias("kept")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs, "doc_id", "text").select(F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
