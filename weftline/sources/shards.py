"""Shards of an adapter as a Python data source, read as a table or as a stream that goes on where it stopped.

A shard is a Parquet file below a folder, or a folder ``*.parquet`` there whose
files are its parts in the order of their names, as Spark writes them. Its
language is the name of the folder that it is in (``lang=de`` or ``de``). The
stream's offset is a place in the shards' row groups, so a shard may come in
several batches. Each row group is a partition of a table; a stream's partition
has small ones that follow one another in their file. Behind a shard's last row group comes a row with ``last`` and
nothing else, which tells later operators that the shard is over.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from . import files

SCHEMA = "shard string, lang string, row bigint, text string, token_count bigint, last boolean"
_ARROW = pa.schema([("shard", pa.string()), ("lang", pa.string()), ("row", pa.int64()), ("text", pa.string()), ("token_count", pa.int64()), ("last", pa.bool_())])

#: A stream's partition takes row groups of a file until it has so many bytes.
SPAN = 4 << 20


class _Group(InputPartition):
    """So many row groups of a file, the first one and its first row's place in the shard, and whether they end it."""

    def __init__(self, shard: str, path: str, group: int, first: int, last: bool, size: int = 0, n: int = 1):
        super().__init__((path, group))
        self.shard, self.path, self.group, self.first, self.last, self.size, self.n = shard, path, group, first, last, size, n


def lang_of(path: str) -> str:
    return path.split("/")[-2].rpartition("=")[2] if "/" in path else ""


def _rows(part: _Group) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    system, path = files.opened(part.path)
    with system.open_input_file(path) as f:
        file = pq.ParquetFile(f)
        have = [c for c in ("text", "token_count") if c in file.schema_arrow.names]
        at = part.first
        for batch in file.iter_batches(10_000, list(range(part.group, part.group + part.n)), have):
            n = batch.num_rows
            column = lambda name, kind: batch.column(name).cast(kind) if name in have else pa.nulls(n, kind)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([pa.array([part.shard] * n), pa.array([lang_of(part.shard)] * n), pa.array(np.arange(at, at + n)), column("text", pa.string()), column("token_count", pa.int64()), pa.array([False] * n)], schema=_ARROW)
            at += n
    if part.last:
        yield pa.RecordBatch.from_arrays([pa.array([part.shard]), pa.array([lang_of(part.shard)]), pa.array([at], pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([True])], schema=_ARROW)


class _Shards:
    """Row groups in order; only footers are read, each once."""

    def __init__(self, options: dict):
        self.folder = options["path"]
        self.langs = {x for x in options.get("langs", "").replace(" ", "").split(",") if x}
        self.footers: dict[str, list[tuple[int, int]]] = {}
        self.files: dict[str, list[str]] = {}

    def names(self) -> list[str]:
        self.files = {}
        for path in files.below(self.folder, ".parquet"):
            shard = files.whole(path, self.folder)
            if not self.langs or lang_of(shard) in self.langs:
                self.files.setdefault(shard, []).append(path)
        return sorted(self.files)

    def _footer(self, path: str) -> list[tuple[int, int]]:
        """(rows, bytes) of each row group; a file without rows may have one group of none."""
        import pyarrow.parquet as pq

        if path not in self.footers:
            system, name = files.opened(path)
            with system.open_input_file(name) as f:
                meta = pq.ParquetFile(f).metadata
                self.footers[path] = [(g.num_rows, g.total_byte_size) for g in map(meta.row_group, range(meta.num_row_groups))]
        return self.footers[path]

    def groups(self, shard: str) -> list[tuple[int, int]]:
        """(rows, bytes) of the row groups of all parts."""
        return [g for path in self.files[shard] for g in self._footer(path)]

    def parts(self, shard: str, lo: int = 0, hi: int | None = None) -> list[_Group]:
        out, first = [], 0
        for path in self.files[shard]:
            for k, (rows, size) in enumerate(self._footer(path)):
                out.append(_Group(shard, path, k, first, False, size))
                first += rows
        if out:
            out[-1].last = True
        return out[lo:hi]

    def spans(self, shard: str, lo: int = 0, hi: int | None = None) -> list[_Group]:
        """The same with row groups that follow one another in a file together, up to SPAN bytes."""
        out: list[_Group] = []
        for g in self.parts(shard, lo, hi):
            if out and out[-1].path == g.path and out[-1].size + g.size <= SPAN:
                out[-1].n, out[-1].size, out[-1].last = out[-1].n + 1, out[-1].size + g.size, g.last
            else:
                out.append(g)
        return out


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.shards = _Shards(options)

    def partitions(self):
        return [g for p in self.shards.names() for g in self.shards.parts(p)] or [_Group("", "", 0, 0, False)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        yield from _rows(partition) if partition.path else ()


class _Stream(DataSourceStreamReader):
    """Offsets are {"shard": the last one that was begun, "group": how many of its row groups are read}; shards come in the order of their names, so later ones have to sort behind."""

    def __init__(self, options: dict):
        self.shards, self.most, self.least = _Shards(options), int(options.get("groupsPerBatch", "64")), int(options.get("bytesPerBatch", "0"))
        # Spark asks for the latest offset before it says where it is; ``progress`` tells what a checkpoint holds.
        self.at = json.loads(options["after"]) if "after" in options else None

    def initialOffset(self) -> dict:
        return {"shard": "", "group": 0}

    def _left(self, start: dict) -> Iterator[tuple[str, int, list[int]]]:
        """(shard, its first row group that is left, bytes of those from there on)."""
        for path in self.shards.names():
            if path >= start["shard"]:
                lo, sizes = start["group"] if path == start["shard"] else 0, [size for _, size in self.shards.groups(path)]
                if lo < len(sizes):
                    yield path, lo, sizes[lo:]

    def latestOffset(self) -> dict:
        # Where it is not known what has been read, a batch takes all there is.
        most, least, end = (self.most, self.least, self.at) if self.at is not None else (1 << 60, 0, {"shard": "", "group": 0})
        for path, lo, sizes in self._left(end):
            for size in sizes:
                if most <= 0 and least <= 0:
                    return end
                lo, most, least = lo + 1, most - 1, least - size
                end = {"shard": path, "group": lo}
        return end

    def partitions(self, start: dict, end: dict):
        self.at = end
        out = []
        for path, lo, _ in self._left(start):
            if path > end["shard"]:
                break
            out += self.shards.spans(path, lo, end["group"] if path == end["shard"] else None)
        return out

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        yield from _rows(partition)

    def commit(self, end: dict) -> None:
        self.at = end


def progress(checkpoint: str) -> str:
    """The offset up to which a query with this checkpoint has planned its batches, for option ``after``; that of a new query if there is none."""
    logged = [p for p in files.below(f"{checkpoint}/offsets") if p.rpartition("/")[2].isdigit()]
    if not logged:
        return json.dumps({"shard": "", "group": 0})
    return files.get(max(logged, key=lambda p: int(p.rpartition("/")[2]))).decode().strip().splitlines()[-1]


class CorpusShards(DataSource):
    """``spark.read.format("corpus_shards").load(folder)``, or ``spark.readStream``; options ``langs``, ``groupsPerBatch``, ``bytesPerBatch`` (a batch takes more row groups than that until it has so many bytes, however small they are) and ``after``, the offset at which a stream goes on."""

    @classmethod
    def name(cls) -> str:
        return "corpus_shards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def streamReader(self, schema):
        return _Stream(self.options)


def register(spark) -> None:
    spark.dataSource.register(CorpusShards)
