"""Texts alone in a JSON Lines file for each value of some columns, as a Spark data source, read and written.

Files lie as Spark's own writer puts them, in a folder for each column and
value. Tasks open, write and list them by pyarrow: where there is a file for
every few hundred rows, what a file costs besides its rows is what counts.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import files

#: Bytes and files of a partition, and bytes of a batch.
SPAN, MOST, BATCH = 64 << 20, 1000, 8 << 20
#: The folder of a null or empty value, and characters of others that Spark escapes in a folder's name.
NONE, _ESCAPED = "__HIVE_DEFAULT_PARTITION__", re.compile("[\x00-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def folder_name(column: str, value: str | None) -> str:
    return f"{column}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', value) if value else NONE}"


def folder_value(name: str) -> str | None:
    value = name.partition("=")[2]
    return None if value == NONE else re.sub("%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)


class _Message(WriterCommitMessage):
    def __init__(self, parts: list[tuple[str, str]]):
        self.parts = parts


class _Writer(DataSourceArrowWriter):
    """Rows of lines and of strings that name folders; rows of a folder follow one another. Files are hidden until all tasks have ended."""

    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path.rstrip("/"), names

    def write(self, batches) -> _Message:
        done, stream, last = [], None, None
        system, root = files.opened(self.path)
        for batch in batches:
            lines, at = batch.column(0), 0
            for values, rows in groupby(zip(*[batch.column(1 + k).to_pylist() for k in range(len(self.names))])):
                n = len(list(rows))
                if values != last:
                    if stream:
                        stream.close()
                    folder, name, last = "/".join([root, *map(folder_name, self.names, values)]), f"part-{uuid.uuid4().hex}.json", values
                    system.create_dir(folder, recursive=True)
                    stream = system.open_output_stream(f"{folder}/.{name}.tmp", compression=None)
                    done.append((folder, name))
                for line in lines.slice(at, n).to_pylist():
                    stream.write(line.encode() + b"\n")
                at += n
        if stream:
            stream.close()
        return _Message(done)

    def commit(self, messages) -> None:
        system, root = files.opened(self.path)
        system.create_dir(root, recursive=True)
        for m in messages:
            for folder, name in m.parts if m else ():
                system.move(f"{folder}/.{name}.tmp", f"{folder}/{name}")

    def abort(self, messages) -> None:
        system, _ = files.opened(self.path)
        for m in messages:
            for folder, name in m.parts if m else ():
                if files.exists(f"{folder}/.{name}.tmp"):
                    system.delete_file(f"{folder}/.{name}.tmp")


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths[:1])
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, path: str, names: list[str]):
        self.path, self.names = path, names

    def partitions(self):
        from pyarrow import fs

        system, path = files.opened(self.path)
        found = system.get_file_info(fs.FileSelector(path, recursive=True))
        out, held = [[]], 0
        for name, size in sorted((x.path, x.size or 0) for x in found if x.type == fs.FileType.File and re.search(r"/[^/._][^/]*\.json$", x.path)):
            if out[-1] and (held + size > SPAN or len(out[-1]) >= MOST):
                out.append([])
                held = 0
            out[-1].append(name)
            held += size
        return [_Files(x) for x in out]

    def read(self, part) -> Iterator[pa.RecordBatch]:
        system, _ = files.opened(self.path)
        columns, held = [[] for _ in range(1 + len(self.names))], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["line", *self.names])

        for path in part.paths:
            values = [folder_value(x) for x in path.split("/")[-1 - len(self.names) : -1]]
            with system.open_input_stream(path, compression=None) as f:
                rest = b""
                while data := f.read(BATCH):
                    *lines, rest = (rest + data).split(b"\n") if b"\n" in data else [rest + data]
                    for column, x in zip(columns, ([x.decode() for x in lines], *([v] * len(lines) for v in values))):
                        column.extend(x)
                    held += len(data)
                    if held > BATCH:
                        yield batch()
                        columns, held = [[] for _ in columns], 0
                if rest:
                    raise ValueError(f"{path} does not end with a line feed")
        yield batch()


class ChunkFiles(DataSource):
    """Option ``columns`` has the folders' columns, joined by commas."""

    @classmethod
    def name(cls) -> str:
        return "chunk_files"

    def _columns(self) -> list[str]:
        return self.options["columns"].split(",")

    def schema(self) -> str:
        return ", ".join(f"{x} string" for x in ("line", *self._columns()))

    def reader(self, schema):
        return _Reader(self.options["path"], self._columns())

    def writer(self, schema, overwrite):
        return _Writer(self.options["path"], self._columns())


def write(rows: DataFrame, path: str, by: tuple) -> None:
    """Add (text) of all rows to files in a folder for each value of ``by``."""
    rows.sparkSession.dataSource.register(ChunkFiles)
    lines = rows.select(F.to_json(F.struct("text"), {"ignoreNullFields": "true"}).alias("line"), *[F.col(c).cast("string").alias(c) for c in by])
    lines.sortWithinPartitions(*by).write.format("chunk_files").option("path", path).option("columns", ",".join(by)).mode("append").save()


def read(spark: SparkSession, path: str, by: dict[str, str]) -> DataFrame:
    """(text, the columns of ``by`` in the types that it gives) of all files below a folder."""
    spark.dataSource.register(ChunkFiles)
    rows = spark.read.format("chunk_files").option("columns", ",".join(by)).load(path)
    return rows.select(F.from_json("line", "text string", {"mode": "FAILFAST"})["text"].alias("text"), *[F.col(c).cast(t).alias(c) for c, t in by.items()])
