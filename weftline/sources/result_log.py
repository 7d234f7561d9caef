"""A log of results that holds each batch once, as a data source.

Tasks write files under names of their own. A batch's commit is one small file,
named by the writer and the batch, that lists them; a batch that is run again
after a failure finds its commit and takes its new files back. Readers see the
files that commits list and no others, so neither a lost task nor a stopped
driver leaves half a batch or two copies of it.

    rows.writeStream.format("result_log").option("path", log)...
    rows.write.format("result_log").option("batch", "run-7").mode("append").save(log)
    spark.read.format("result_log").schema(...).load(log)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, InputPartition, WriterCommitMessage

from . import files


class _File(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class _Message(WriterCommitMessage):
    def __init__(self, name: str | None, rows: int):
        self.name, self.rows = name, rows


def _written(path: str, batches: Iterator[pa.RecordBatch]) -> _Message:
    import pyarrow.parquet as pq

    name, writer, rows = f"data/{uuid.uuid4().hex}.parquet", None, 0
    for batch in batches:
        if batch.num_rows:
            if writer is None:
                system, root = files.opened(path)
                system.create_dir(f"{root}/data", recursive=True)
                writer = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=system)
            writer.write_batch(batch)
            rows += batch.num_rows
    if writer is None:
        return _Message(None, 0)
    writer.close()
    return _Message(name, rows)


def _dropped(path: str, messages) -> None:
    for m in messages:
        if m and m.name and files.exists(f"{path}/{m.name}"):
            system, root = files.opened(path)
            system.delete_file(f"{root}/{m.name}")


def committed(path: str, batch: str, messages) -> bool:
    """Whether this call is the one that committed the batch."""
    where = f"{path}/commits/{batch}.json"
    if files.exists(where):
        _dropped(path, messages)
        return False
    files.put(where, json.dumps({"files": [m.name for m in messages if m and m.name], "rows": sum(m.rows for m in messages if m)}).encode())
    return True


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.batch = options["path"].rstrip("/"), options.get("batch") or uuid.uuid4().hex

    def write(self, iterator) -> _Message:
        return _written(self.path, iterator)

    def commit(self, messages) -> None:
        committed(self.path, f"batch-{self.batch}", messages)

    def abort(self, messages) -> None:
        _dropped(self.path, messages)


class _StreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: dict):
        self.path, self.name = options["path"].rstrip("/"), options.get("writer", "stream")

    def write(self, iterator) -> _Message:
        return _written(self.path, iterator)

    def commit(self, messages, batchId: int) -> None:
        committed(self.path, f"{self.name}-{batchId:012d}", messages)

    def abort(self, messages, batchId: int) -> None:
        _dropped(self.path, messages)


class _Reader(DataSourceReader):
    def __init__(self, options: dict, names: list[str]):
        self.path, self.names = options["path"].rstrip("/"), names

    def partitions(self):
        listed = [f for c in files.below(f"{self.path}/commits", ".json") for f in json.loads(files.get(c))["files"]]
        return [_File(f"{self.path}/{f}") for f in listed] or [_File("")]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        if partition.path:
            system, path = files.opened(partition.path)
            with system.open_input_file(path) as f:
                yield from pq.ParquetFile(f).iter_batches(columns=self.names)


class ResultLog(DataSource):
    """Options ``path``, ``writer`` (of a stream: its name, if several write to one log) and ``batch`` (of a batch: its name)."""

    @classmethod
    def name(cls) -> str:
        return "result_log"

    def reader(self, schema):
        return _Reader(self.options, schema.fieldNames())

    def writer(self, schema, overwrite):
        return _Writer(self.options)

    def streamWriter(self, schema, overwrite):
        return _StreamWriter(self.options)


def register(spark) -> None:
    spark.dataSource.register(ResultLog)
