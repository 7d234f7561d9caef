"""Token ids of whole folders in one pass with two outputs: rows, and what went wrong with which file.

Files are cut into ranges, of bytes for JSON Lines and of row groups for
Parquet, so that a large one is read by many tasks. A file of which any range
fails is reported and none of its rows is used, and the others go on. A folder
with a file's name, such as Spark writes, is one file in parts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tokenize as tok
from ..sources import files, readers

#: Bytes of a range, and rows that are tokenized at once.
SPAN, ROWS = 64 << 20, 512


def _lines(path: str, start: int, stop: int, piece: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that begin in a range of bytes."""
    system, name = files.opened(path)
    with system.open_input_file(name) as f:
        # The line that began before the range is the range before's.
        f.seek(max(start - 1, 0))
        before, at, held = bool(start) and f.read(1) != b"\n", start, b""
        while data := f.read(piece):
            *whole, held = (held + data).split(b"\n")
            for line in whole:
                if not before:
                    if at >= stop:
                        return
                    yield at, line
                before, at = False, at + len(line) + 1
            if at >= stop and not before:
                return
        if held and not before and at < stop:
            yield at, held


def _texts(path: str, start: int, stop: int) -> Iterator[tuple[int, str]]:
    """(place, text) of a range of bytes, or of row groups."""
    if path.endswith(".parquet"):
        import pyarrow.parquet as pq

        system, name = files.opened(path)
        with system.open_input_file(name) as f:
            file = pq.ParquetFile(f)
            for group in range(start, min(stop, file.num_row_groups)):
                at = sum(file.metadata.row_group(k).num_rows for k in range(group))
                for batch in file.iter_batches(ROWS, [group], ["text"]):
                    for text in batch.column(0).to_pylist():
                        yield at, text or ""
                        at += 1
        return
    for at, line in _lines(path, start, stop):
        if line.strip():
            try:
                text = json.loads(line)["text"]
            except (ValueError, KeyError, TypeError) as error:
                raise ValueError(f"the line at byte {at}: {type(error).__name__}: {error}") from None
            yield at, text or ""


def _encoded(tokenizer: str, end: int | None):
    make = tok.maker(tokenizer)
    names = ["path", "place", "tokens", "error"]

    def rows(path: str, held: list[tuple[int, str]], encode) -> pa.RecordBatch:
        texts = [t for _, t in held]
        ids = tok.byte_lists(pa.array(texts, pa.string()), end) if tokenizer == "bytes" else pa.array([[*x, *([] if end is None else [end])] for x in encode(texts)], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array([path] * len(held)), pa.array([p for p, _ in held], pa.int64()), ids, pa.nulls(len(held), pa.string())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        for batch in batches:
            for path, start, stop in zip(*[batch.column(c).to_pylist() for c in ("path", "start", "stop")]):
                try:
                    held = []
                    for row in _texts(path, start, stop):
                        held.append(row)
                        if len(held) >= ROWS:
                            yield rows(path, held, encode)
                            held = []
                    if held:
                        yield rows(path, held, encode)
                except Exception as error:  # noqa: BLE001  (the file's failure is an output)
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([start], pa.int64()), pa.nulls(1, pa.list_(pa.int32())), pa.array([f"{type(error).__name__}: {str(error)[:300]}"])], names)

    return run


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for batch in batches:
        for uri in batch.column("path").to_pylist():
            groups = rows = error = None
            try:
                system, path = files.opened(uri)
                with system.open_input_file(path) as f:
                    meta = pq.ParquetFile(f).metadata
                    groups, rows = meta.num_row_groups, meta.num_rows
            except Exception as problem:  # noqa: BLE001
                error = f"{type(problem).__name__}: {str(problem)[:300]}"
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([groups], pa.int64()), pa.array([rows], pa.int64()), pa.array([error], pa.string())], ["path", "groups", "rows", "error"])


def dry_run(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size, groups, rows, error) of the JSON Lines and Parquet files below a folder; of Parquet only footers are read, of JSON Lines nothing."""
    found = readers.listing(spark, folder).where(F.col("path").rlike(r"\.(parquet|json|jsonl)(/|$)")).select("path", "size")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parquet = found.where(F.col("path").endswith(".parquet")).select("path").repartition(parts, "path").mapInArrow(_footers, "path string, groups long, rows long, error string")
    return found.join(parquet, "path", "left")


def tokenize_files(spark: SparkSession, folder: str, out: str, tokenizer: str = "bytes", end: int | None = 1, span: int = SPAN) -> None:
    """Token ids of all files below ``folder``, written below ``out`` with the failures beside them, in one pass."""
    plan = dry_run(spark, folder)
    cuts = lambda n: F.sequence(F.lit(0).cast("long"), F.greatest(n - 1, F.lit(0)), F.lit(1).cast("long"))
    lines = plan.where(~F.col("path").endswith(".parquet")).select("path", F.explode(cuts(F.ceil(F.col("size") / span))).alias("k")).select("path", (F.col("k") * span).alias("start"), ((F.col("k") + 1) * span).alias("stop"))
    groups = plan.where(F.col("path").endswith(".parquet")).select("path", F.explode(cuts(F.coalesce("groups", F.lit(1)))).alias("start")).select("path", "start", (F.col("start") + 1).alias("stop"))
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = lines.unionByName(groups).repartition(parts, "path", "start")
    made = ranges.mapInArrow(_encoded(tokenizer, end), "path string, place long, tokens array<int>, error string")
    made.withColumn("kind", F.when(F.col("error").isNull(), "rows").otherwise("failures")).write.partitionBy("kind").parquet(out)


_OUT = "path string, place long, tokens array<int>, error string, kind string"


def failures(spark: SparkSession, out: str) -> DataFrame:
    """(path, error): the first failure of each file that has one; a file in parts is a file."""
    return spark.read.schema(_OUT).parquet(out).where("kind = 'failures'").groupBy(readers.whole(F.col("path")).alias("path")).agg(F.min_by("error", F.struct(F.col("path"), F.col("place"))).alias("error"))


def tokenized(spark: SparkSession, out: str) -> DataFrame:
    """(path, place, tokens) of the files without failures."""
    rows = spark.read.schema(_OUT).parquet(out).where("kind = 'rows'")
    # A row for each file that failed; a join by files would bring all rows of a large one together.
    bad = F.broadcast(failures(spark, out).select(F.col("path").alias("_bad")))
    return rows.join(bad, readers.whole(F.col("path")) == F.col("_bad"), "left_anti").select("path", "place", "tokens")
