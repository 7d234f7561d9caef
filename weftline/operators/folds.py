"""Folds over ordered rows in parallel: where a batch closes decides where the next one begins.

A batch closes at the row with which it has so many rows, or reaches a size.
Rows are laid out in their order and cut into ranges of like mass. What a range
makes of any batch that is open before it depends only on the row at which that
batch closes, so a table with a row for each such place says it all: no more
rows than a batch has, whatever the range's length. The tables of a group are
strung together in one task, and then all ranges are folded at once, each from
the batch that is open before it.

Several batches may be open at a time, filled in turn: a row goes to the lane
that its number in the group names, so each lane is a fold of its own, with
tables of its own, until the first of them has all the batches it may have.
There is then one lane less, and the next phase begins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import running_sums

#: Batches that a range should hold at least, and the share of a size that each row counts for besides its own.
BATCHES, SHARE = 8, 4096


def laid_out(df: DataFrame, group: str | None, order: list[str], tokens: str, size: int, folder: str, ranges: int | None = None) -> DataFrame:
    """Rows (g, order, t, place, k) written in order: places count all rows, k is the range.

    Rows that tie in ``order`` go by their tokens; those that tie in these as
    well are alike. Null and negative numbers of tokens count as 0.
    """
    spark = df.sparkSession
    unit = max(1, size // SHARE)
    t = F.greatest(F.coalesce(F.col(tokens).cast("long"), F.lit(0)), F.lit(0))
    names = [f"o{k}" for k in range(len(order))]
    rows = df.select((F.col(group).cast("string") if group else F.lit("")).alias("g"), *[F.col(c).alias(n) for c, n in zip(order, names)], t.alias("t")).withColumn("_mass", F.col("t") + unit if size else F.lit(1).cast("long"))
    rows = running_sums(rows, ["g", *names, "t"], {"place": None, "_at": "_mass"}, folder, ranges)
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = rows.agg(F.coalesce(F.sum("_mass"), F.lit(0))).first()[0]
    width = -(-total // n) if ranges else max(BATCHES * (size + unit), -(-total // n))
    return rows.withColumn("k", F.floor(F.col("_at") / F.lit(max(1, width))).cast("long")).drop("_at", "_mass")


def ends(t: np.ndarray, size: int, rows: int = 0, held: int = 0, held_rows: int = 0) -> np.ndarray:
    """Places after which a batch closes: with its so many rows, or as soon as its sum reaches the size (0: no such limit). One search a batch."""
    sums, out, base, start = np.cumsum(t), [], -held, -held_rows
    while True:
        at = int(np.searchsorted(sums, base + size)) if size else len(sums)
        at = min(at, start + rows - 1) if rows else at
        if at >= len(sums):
            return np.array(out, dtype=np.int64)
        out.append(at + 1)
        base, start = int(sums[at]), at + 1


TABLE = "rows long, held long, closed long, after_rows long, after_held long"


def table(t: np.ndarray, size: int, rows: int = 0) -> pd.DataFrame:
    """What a range makes of the batch that is open before it: for each place at which that one may close, (rows up to there, their sum, batches closed, rows and sum open after the range); last, with -1 closed, the whole range."""
    n = len(t)
    sums = np.cumsum(t)
    before = np.concatenate([[0], sums])
    close = np.searchsorted(sums, before[:-1] + size) if size else np.full(n, n)
    close = np.minimum(close, np.arange(n) + rows - 1) if rows else close
    # From each place on: how many batches close, and where the last one begins. By doubling: half the steps, then the others.
    jump = np.concatenate([np.where(close < n, close + 1, np.arange(n)), [n]])
    closed = (jump > np.arange(n + 1)).astype(np.int64)
    while True:
        further = jump[jump]
        if (further == jump).all():
            break
        closed, jump = closed + closed[jump], further
    last = min(int(close[0]), n - 1) if n else -1
    at = np.arange(last + 1)
    if not rows and n:
        # Rows of no tokens close nothing.
        at = at[np.concatenate([[True], sums[1 : last + 1] > sums[:last]])] if last else at
    after = jump[at + 1]
    out = pd.DataFrame({"rows": at + 1, "held": sums[at] if n else sums, "closed": closed[at + 1] + 1, "after_rows": n - after, "after_held": before[n] - before[after]})
    return pd.concat([out, pd.DataFrame([(n, before[n], -1, n, before[n])], columns=out.columns)], ignore_index=True).astype("int64")


def _sorted(made: pd.DataFrame) -> pd.DataFrame:
    """A table by places, the whole range last, as rows come in any order."""
    return made.assign(_whole=made["closed"] < 0).sort_values(["_whole", "rows"]).drop(columns="_whole")


def passed(made: pd.DataFrame, size: int, rows: int, held_rows: int, held: int) -> tuple[int, int, int]:
    """(batches closed, rows and sum open after the range), by its table, for what is open before it."""
    own = made["closed"].to_numpy() >= 0
    reached = np.zeros(len(made), bool)
    if size:
        reached |= held + made["held"].to_numpy() >= size
    if rows:
        reached |= held_rows + made["rows"].to_numpy() >= rows
    hit = np.flatnonzero(reached & own)
    if len(hit):
        row = made.iloc[int(hit[0])]
        return int(row["closed"]), int(row["after_rows"]), int(row["after_held"])
    row = made.iloc[-1]
    return 0, held_rows + int(row["rows"]), held + int(row["held"])


def batched(laid: DataFrame, size: int, rows: int = 0) -> DataFrame:
    """Rows of ``laid_out`` with the number of their batch in the group, and whether it closes."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in laid.schema)
    names = [*laid.columns, "batch", "full"]

    def mapped(pdf: pd.DataFrame) -> pd.DataFrame:
        made = table(pdf.sort_values("place")["t"].to_numpy(), size, rows)
        made.insert(0, "g", pdf["g"].iloc[0])
        made.insert(1, "k", pdf["k"].iloc[0])
        return made

    def strung(pdf: pd.DataFrame) -> pd.DataFrame:
        held = held_rows = closed = 0
        out = []
        for k, made in pdf.groupby("k", sort=True):
            out.append((pdf["g"].iloc[0], k, held_rows, held, closed))
            n, held_rows, held = passed(_sorted(made), size, rows, held_rows, held)
            closed += n
        return pd.DataFrame([(*x, closed) for x in out], columns=["g", "k", "before_rows", "before", "base", "total"])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        before_rows, before, base, total = (int(pdf[c].iloc[0]) for c in ("before_rows", "before", "base", "total"))
        made = ends(pdf["t"].to_numpy(), size, rows, before, before_rows)
        pdf["batch"] = base + np.searchsorted(made, np.arange(len(pdf)), side="right")
        pdf["full"] = pdf["batch"] < total
        return pdf[names]

    tables = laid.groupBy("g", "k").applyInPandas(mapped, f"g string, k long, {TABLE}")
    entries = tables.groupBy("g").applyInPandas(strung, "g string, k long, before_rows long, before long, base long, total long")
    entries = entries.withColumnsRenamed({"g": "_g", "k": "_k"})
    met = laid.join(entries, F.col("g").eqNullSafe(F.col("_g")) & (F.col("k") == F.col("_k"))).drop("_g", "_k")
    return met.groupBy("g", "k").applyInPandas(fold, f"{kept}, batch long, full boolean")


_STATE = "q long, turn long, open array<int>, made array<long>, held array<long>"
_LANES = ["q", "turn", "open", "made", "held0"]


def in_turn(laid: DataFrame, sizes: list[int], each: int, folder: str) -> DataFrame:
    """(place, lane, batch) of the rows that are used: each goes, in turn, to the next of ``sizes`` that has fewer than ``each`` batches."""
    spark = laid.sparkSession
    spans = laid.groupBy("g", "k").agg(F.max("place").alias("last"))
    everyone = [F.array(*[F.lit(x) for x in v]).cast(kind) for v, kind in ((range(len(sizes)), "array<int>"), ([0] * len(sizes), "array<bigint>"))]
    state = laid.groupBy("g").agg(F.min("place").alias("q")).select("g", "q", F.lit(0).cast("long").alias("turn"), everyone[0].alias("open"), everyone[1].alias("made"), everyone[1].alias("held"))

    def lanes(rows: pd.DataFrame, now) -> list[tuple[int, pd.DataFrame]]:
        rows = rows[rows["place"] >= now.q].sort_values("place")
        lane = (now.turn + rows["place"].to_numpy() - now.q) % len(now.open)
        return [(x, rows[lane == x]) for x in range(len(now.open))]

    def mapped(rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        out = []
        for now in marks.itertuples() if len(rows) else ():
            for x, own in lanes(rows, now):
                if len(own):
                    made = table(own["t"].to_numpy(), sizes[now.open[x]])
                    out.append(made.assign(g=now.h, k=now.j, lane=x, q=now.q, turn=now.turn, open=[list(now.open)] * len(made), made=[list(now.made)] * len(made), held0=[list(now.held)] * len(made)))
        names = ["g", "k", "lane", *_LANES, "rows", "held", "closed", "after_rows", "after_held"]
        return pd.concat(out)[names] if out else pd.DataFrame(columns=names)

    def strung(pdf: pd.DataFrame) -> pd.DataFrame:
        first = pdf.iloc[0]
        made, held, out = [int(x) for x in first["made"]], [int(x) for x in first["held0"]], []
        for k, tables in pdf.groupby("k", sort=True):
            out.append((first["g"], k, first["q"], first["turn"], list(first["open"]), list(made), list(held)))
            for x, own in tables.groupby("lane"):
                n, _, held[x] = passed(_sorted(own), sizes[first["open"][x]], 0, 0, held[x])
                made[x] += n
            # The phase ends within this range; what follows is the next one's.
            if max(made) >= each:
                break
        return pd.DataFrame(out, columns=["h", "j", "q", "turn", "open", "made", "held"])

    def used(rows: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        names = ["kind", "g", "place", "target", "batch", "q", "turn", "open", "made", "held"]
        if not len(marks) or not len(rows):
            return pd.DataFrame(columns=names)
        now = next(marks.itertuples())
        parts = []
        for x, own in lanes(rows, now):
            places = own["place"].to_numpy()
            closing = ends(own["t"].to_numpy(), sizes[now.open[x]], 0, int(now.held[x]))
            left = each - int(now.made[x])
            parts.append((x, own, places, closing, int(places[closing[left - 1] - 1]) if len(closing) >= left else None))
        over = min((p[-1] for p in parts if p[-1] is not None), default=None)
        out, after = [], []
        for x, own, places, closing, _ in parts:
            n = len(places) if over is None else int(np.searchsorted(places, over, side="right"))
            batch = int(now.made[x]) + np.searchsorted(closing, np.arange(n), side="right")
            own_rows = pd.DataFrame({"kind": 0, "g": now.h, "place": places[:n], "target": sizes[now.open[x]], "batch": batch, "q": 0, "turn": 0})
            out.append(own_rows.assign(**{c: pd.Series([None] * n, dtype=object) for c in ("open", "made", "held")}))
            done = int((closing <= n).sum())
            since = int(closing[done - 1]) if done else 0
            after.append((now.open[x], int(now.made[x]) + done, int(own["t"].iloc[since:n].sum()) + (0 if done else int(now.held[x]))))
        if over is not None:
            going = [a for a in after if a[1] < each]
            state = pd.DataFrame([(1, now.h, over, 0, 0, over + 1, now.turn + over - now.q + 1, *([a[j] for a in going] for j in range(3)))], columns=names)
            out.append(state)
        return pd.concat(out)[names]

    parts = []
    for phase in range(len(sizes)):
        marks = spans.join(state.withColumnRenamed("g", "_g"), F.col("g").eqNullSafe(F.col("_g"))).where("last >= q").select(F.col("g").alias("h"), F.col("k").alias("j"), "q", "turn", "open", "made", "held")
        tables = laid.groupBy("g", "k").cogroup(marks.groupBy("h", "j")).applyInPandas(mapped, f"g string, k long, lane int, q long, turn long, open array<int>, made array<long>, held0 array<long>, {TABLE}")
        entries = tables.groupBy("g").applyInPandas(strung, f"h string, j long, {_STATE}")
        out = laid.groupBy("g", "k").cogroup(entries.groupBy("h", "j")).applyInPandas(used, f"kind int, g string, place long, target long, batch long, {_STATE}")
        out.write.parquet(f"{folder}/phase{phase}")
        out = spark.read.schema(f"kind int, g string, place long, target long, batch long, {_STATE}").parquet(f"{folder}/phase{phase}")
        parts.append(out.where("kind = 0").select("place", "target", "batch"))
        state = out.where("kind = 1 and size(open) > 0").select("g", "q", "turn", "open", "made", "held")
        if state.first() is None:
            break
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found
