"""Prefix sums in an order, without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def hash_key(seed: int, *columns) -> F.Column:
    """A uniform order that any engine can repeat: SHA-256 in hex of the seed and the columns."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]), 256)


def prefix_by_hash(df: DataFrame, key: str, value: str, out: str, by: tuple = (), digits: int = 3) -> DataFrame:
    """Sum of ``value`` over the rows before a row in the order of a hex hash.

    The hash's first digits make 16 ** digits ranges of like size. Their
    totals, a bounded number of rows (for each of ``by``), are summed first.
    """
    ranged = df.withColumn("_range", F.substring(key, 1, digits))
    totals = ranged.groupBy(*by, "_range").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(*by, "_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*by, "_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(bases, [*by, "_range"]).withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_range", "_base")


def prefix_by_value(df: DataFrame, order: str, value: str, out: str, ranges: int = 256) -> DataFrame:
    """The same in ascending order of an integer column, cut at its quantiles; reads ``df`` once more for them."""
    cuts = sorted({int(x) for x in df.approxQuantile(order, [i / ranges for i in range(1, ranges)], 0.5 / ranges)})
    marks = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<bigint>")
    ranged = df.withColumn("_range", F.size(F.filter(marks, lambda c: c < F.col(order))))
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_total"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # At most `ranges` rows are sent to all tasks.
    return ranged.join(F.broadcast(bases), "_range").withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_range", "_base")


def running_sums(df: DataFrame, order: list, sums: dict[str, str | None], folder: str, ranges: int | None = None) -> DataFrame:
    """For each (out, value) of ``sums`` a column ``out``: the sum of column ``value`` (1 without one) over all rows before a row in any order of columns.

    The rows are dealt out by ranges of all of ``order``, as many as there are
    shuffle partitions, so that their number grows with the cluster and rows
    that tie in its first column are cut by the next ones. Each task adds up
    its own range as it writes it below ``folder``; a row for each range, its
    totals, is then strung together and sent to all. Rows that tie in all of
    ``order`` come in any order, which stays as it was written. Null values
    count as nothing.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    marks = {out: f"_v{k}" for k, out in enumerate(sums)}
    rows = df.withColumns({marks[out]: F.coalesce(F.col(value).cast("long"), F.lit(0)) if value else F.lit(1).cast("long") for out, value in sums.items()})
    values = list(marks.values())
    names = [*df.columns, *values, *[f"_before{v}" for v in values], "_range"]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = TaskContext.get().partitionId(), dict.fromkeys(values, 0)
        for batch in batches:
            before = []
            for v in values:
                each = batch.column(v).to_numpy(zero_copy_only=False)
                total = held[v] + np.cumsum(each)
                before.append(pa.array(total - each, pa.int64()))
                held[v] = int(total[-1]) if len(total) else held[v]
            yield pa.RecordBatch.from_arrays([*batch.columns, *before, pa.array(np.full(batch.num_rows, own, np.int32))], names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + "".join(f", _before{v} long" for v in values) + ", _range int"
    rows.repartitionByRange(n, *order).sortWithinPartitions(*order).mapInArrow(summed, schema).write.option("compression", "zstd").parquet(folder)
    rows = spark.read.schema(schema).parquet(folder)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("_range").agg(*[F.sum(v).alias(f"_total{v}") for v in values])
    bases = totals.select("_range", *[F.coalesce(F.sum(f"_total{v}").over(before), F.lit(0)).alias(f"_base{v}") for v in values])
    # As many rows as there are ranges.
    met = rows.join(F.broadcast(bases), "_range")
    return met.select(*df.columns, *[(F.col(f"_base{v}") + F.col(f"_before{v}")).alias(out) for out, v in marks.items()])


def running(df: DataFrame, order: list, value: str | None, out: str, folder: str, ranges: int | None = None) -> DataFrame:
    """One running sum of that kind."""
    return running_sums(df, order, {out: value}, folder, ranges)
