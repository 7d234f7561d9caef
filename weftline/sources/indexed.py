"""Index and token files of tokenised corpora as a Spark data source, read and written.

An index is a magic, a version, a code for the type of a token, the numbers of
sequences and documents, lengths and byte offsets of the sequences, and the
documents' first sequences. A row is (source, seq_no, length, pointer) and, if
asked for, its tokens; stretches of files are partitions, so that a large file
is read by many tasks. Rows are read and written in Arrow batches.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator
from contextlib import nullcontext
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import files

# Fixed values of the format.
MAGIC, VERSION = b"MMIDIDX\x00\x00", 1
HEAD = struct.Struct("<QBQQ")
TYPES = {1: np.uint8, 2: np.int8, 3: np.int16, 4: np.int32, 5: np.int64, 6: np.float64, 7: np.float32, 8: np.uint16}


def read_head(data: bytes) -> tuple[np.dtype, int]:
    """(type of tokens, number of sequences) from an index's first bytes."""
    if data[:9] != MAGIC:
        raise ValueError("no index: the magic differs")
    version, kind, sequences, _ = HEAD.unpack_from(data, 9)
    if version != VERSION:
        raise ValueError(f"index version {version} is not known")
    return np.dtype(TYPES[kind]), sequences


def read_index(data: bytes) -> tuple[np.dtype, np.ndarray, np.ndarray]:
    """(type of tokens, lengths, byte offsets)."""
    kind, sequences = read_head(data)
    at = 9 + HEAD.size
    return kind, np.frombuffer(data, "<i4", sequences, at), np.frombuffer(data, "<i8", sequences, at + 4 * sequences)


def write_index(lengths, kind: int = 4) -> bytes:
    lengths = np.asarray(lengths, np.int64)
    n, size = len(lengths), np.dtype(TYPES[kind]).itemsize
    ends = np.concatenate([[0], np.cumsum(lengths)]) * size
    return MAGIC + struct.pack("<QBQQ", VERSION, kind, n, n + 1) + lengths.astype("<i4").tobytes() + ends[:-1].astype("<i8").tobytes() + np.arange(n + 1, dtype="<i8").tobytes()


class _Stretch(InputPartition):
    """So many sequences of a file, from one on."""

    def __init__(self, path: str, first: int, stop: int):
        super().__init__((path, first))
        self.path, self.first, self.stop = path, first, stop


#: Bytes of tokens, or of an index, in a partition, and rows and bytes of tokens in a batch.
SPAN, ROWS, BATCH = 64 << 20, 4096, 8 << 20
_ROW = pa.schema([("source", pa.string()), ("seq_no", pa.int64()), ("length", pa.int32()), ("pointer", pa.int64()), ("tokens", pa.list_(pa.int32()))])


def _tokens(f, kind: np.dtype, lengths: np.ndarray, at: np.ndarray) -> pa.Array:
    """The sequences at byte offsets; those that follow one another are read at once."""
    ends = at + lengths * kind.itemsize
    cuts = [0, *(np.flatnonzero(at[1:] != ends[:-1]) + 1).tolist(), len(at)]
    data = []
    for lo, hi in zip(cuts, cuts[1:]):
        f.seek(int(at[lo]))
        data.append(np.frombuffer(f.read(int(ends[hi - 1] - at[lo])), kind).astype(np.int32))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(np.concatenate(data)))


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.tokens = options["path"], str(options.get("tokens", "false")).lower() == "true"

    def partitions(self):
        found = [self.path] if self.path.endswith(".idx") else files.below(self.path, ".idx")
        out = []
        for uri in found:
            system, path = files.opened(uri)
            with system.open_input_file(path) as f:
                _, n = read_head(f.read(9 + HEAD.size))
            data = uri.removesuffix(".idx") + ".bin" if self.tokens and n else uri
            size = system.get_file_info(files.opened(data)[1]).size or 0
            parts = min(max(1, -(-size // SPAN)), max(1, n))
            out += [_Stretch(uri, n * k // parts, n * (k + 1) // parts) for k in range(parts)]
        return out or [_Stretch("", 0, 0)]

    def read(self, part) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        system, path = files.opened(part.path)
        with system.open_input_file(path) as f:
            kind, n = read_head(f.read(9 + HEAD.size))
            k, many, start = part.first, part.stop - part.first, 9 + HEAD.size
            f.seek(start + 4 * k)
            lengths = np.frombuffer(f.read(4 * many), "<i4").astype(np.int64)
            f.seek(start + 4 * n + 8 * k)
            at = np.frombuffer(f.read(8 * many), "<i8")
        source = part.path.rpartition("/")[2].removesuffix(".idx")
        system, path = files.opened(part.path.removesuffix(".idx") + ".bin")
        sums, lo = np.cumsum(lengths) * kind.itemsize, 0
        with system.open_input_file(path) if self.tokens and lengths.sum() else nullcontext() as f:
            while lo < many:
                before = int(sums[lo - 1]) if lo else 0
                hi = min(lo + ROWS, max(lo + 1, int(np.searchsorted(sums, before + BATCH, "right"))))
                ids = pa.nulls(hi - lo, pa.list_(pa.int32())) if f is None else _tokens(f, kind, lengths[lo:hi], at[lo:hi])
                yield pa.RecordBatch.from_arrays([pa.array([source] * (hi - lo)), pa.array(np.arange(k + lo, k + hi)), pa.array(lengths[lo:hi], pa.int32()), pa.array(at[lo:hi]), ids], schema=_ROW)
                lo = hi


class _Message(WriterCommitMessage):
    def __init__(self, parts: list[str]):
        self.parts = parts


class _Pair:
    """An index and a token file that are being written, under names that no other attempt has."""

    def __init__(self, folder: str):
        self.system, root = files.opened(folder)
        self.system.create_dir(root, recursive=True)
        self.name, self.lengths = f"{folder}/part-{uuid.uuid4().hex}", []
        self.stream = self.system.open_output_stream(files.opened(self.name)[1] + ".bin.tmp", compression=None)

    def add(self, rows: pa.Array) -> None:
        """A batch's arrays of ids."""
        if rows.null_count:
            raise ValueError("tokens must not be null")
        self.stream.write(rows.flatten().cast(pa.int32()).to_numpy(zero_copy_only=False).astype("<i4", copy=False).tobytes())
        self.lengths.append(rows.value_lengths().to_numpy(zero_copy_only=False))

    def close(self) -> str:
        self.stream.close()
        with self.system.open_output_stream(files.opened(self.name)[1] + ".idx.tmp", compression=None) as f:
            f.write(write_index(np.concatenate(self.lengths) if self.lengths else []))
        return self.name


class _Writer(DataSourceArrowWriter):
    """Rows with an array ``tokens``: each task writes a pair of files, or with option ``folder``, a column, one in each folder that it names; rows of a folder should follow one another."""

    def __init__(self, options: dict, schema):
        names = schema.fieldNames()
        self.path, self.at = options["path"].rstrip("/"), names.index("tokens")
        self.folder_at = names.index(options["folder"]) if options.get("folder") else None

    def write(self, batches) -> _Message:
        done, pair, last = [], None, None
        for batch in batches:
            tokens, at = batch.column(self.at), 0
            names = [None] * batch.num_rows if self.folder_at is None else batch.column(self.folder_at).to_pylist()
            for name, rows in groupby(names):
                folder, n = self.path if self.folder_at is None else f"{self.path}/{name}", len(list(rows))
                if folder != last:
                    done += [pair.close()] if pair else []
                    pair, last = _Pair(folder), folder
                pair.add(tokens.slice(at, n))
                at += n
        if pair is None and self.folder_at is None:
            pair = _Pair(self.path)
        return _Message(done + ([pair.close()] if pair else []))

    def commit(self, messages) -> None:
        for m in messages:
            for name in m.parts if m else ():
                system, path = files.opened(name)
                # The index last: a pair is read by it.
                for ext in (".bin", ".idx"):
                    system.move(path + ext + ".tmp", path + ext)

    def abort(self, messages) -> None:
        for m in messages:
            for name in m.parts if m else ():
                system, path = files.opened(name)
                for ext in (".bin", ".idx"):
                    if files.exists(name + ext + ".tmp"):
                        system.delete_file(path + ext + ".tmp")


class IndexedTokens(DataSource):
    """``spark.read.format("indexed_tokens").load(folder)``; ``option("tokens", True)`` adds the token ids. Files are on any file system that pyarrow opens."""

    @classmethod
    def name(cls) -> str:
        return "indexed_tokens"

    def schema(self) -> str:
        return "source string, seq_no bigint, length int, pointer bigint, tokens array<int>"

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options, schema)


def register(spark) -> None:
    spark.dataSource.register(IndexedTokens)
