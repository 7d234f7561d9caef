"""Exact deduplication by Grace hashing.

Each task first meets its own rows in an open-addressing table, so a text of
which there are very many copies leaves a task as one row. The shuffle is the
first level of partitioning. A partition that does not fit the table's budget
is written to spill files by further bits of the hash, and each file is
treated the same way until it fits; the table compares complete contents, so
equal hashes alone never make two texts equal. Spill files are in the task's
own temporary folder and go with it: a task that is run again makes them anew.

Texts are equal when they are the same bytes without ASCII white space. Of
equal texts, the row with the most code points in its original text stays,
then the one with the smallest key (a null key comes last).

Defined results: a null text is empty, and all empty texts are equal; a very long
text is compared whole; rows
that repeat key and text count in their group's size, and one of them is
kept; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .op1_chunk_store import _arrow

#: Bytes of contents that a table may hold, spill files at each level, and the levels that the hash has bits for.
BUDGET, FAN, LEVELS = 48 << 20, 16, 12
_BLANKS = b" \t\n\x0b\x0c\r"


def normal(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, _BLANKS)


def better(a: tuple, b: tuple) -> tuple:
    """Of (code points, key), that with more code points, then the smaller key."""
    if a[0] != b[0]:
        return a if a[0] > b[0] else b
    if a[1] is None or b[1] is None:
        return b if a[1] is None else a
    return a if a[1] <= b[1] else b


class OpenTable:
    """Linear probing over a power of two of slots, at most two thirds full. An entry is [hash, content, best, count]."""

    def __init__(self) -> None:
        self.slots: list = [None] * 1024
        self.size = self.bytes = 0

    def add(self, code: int, content: bytes, best: tuple, count: int) -> None:
        mask = len(self.slots) - 1
        at = code & mask
        while (entry := self.slots[at]) is not None:
            if entry[0] == code and entry[1] == content:
                entry[2], entry[3] = better(entry[2], best), entry[3] + count
                return
            at = (at + 1) & mask
        self.slots[at] = [code, content, best, count]
        self.size, self.bytes = self.size + 1, self.bytes + len(content) + 200
        if 3 * self.size > 2 * len(self.slots):
            self._grow()

    def _grow(self) -> None:
        entries = list(self)
        self.slots = [None] * (4 * len(self.slots))
        mask = len(self.slots) - 1
        for entry in entries:
            at = entry[0] & mask
            while self.slots[at] is not None:
                at = (at + 1) & mask
            self.slots[at] = entry

    def __iter__(self) -> Iterator[list]:
        return (e for e in self.slots if e is not None)


class Spill:
    """A file of rows, in compressed Arrow batches of a few MB."""

    def __init__(self, path: str, schema: pa.Schema):
        self.path, self.schema, self.rows, self.bytes = path, schema, [], 0
        self.out = pa.ipc.new_stream(path, schema, options=pa.ipc.IpcWriteOptions(compression="zstd"))

    def add(self, code, content, best, count) -> None:
        self.rows.append((code.to_bytes(8, "big"), content, best[0], best[1], count))
        self.bytes += len(content) + 40
        if self.bytes > 1 << 20:
            self._flush()

    def _flush(self) -> None:
        if self.rows:
            self.out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema))
            self.rows, self.bytes = [], 0

    def read(self) -> Iterator[tuple]:
        self._flush()
        self.out.close()
        with pa.ipc.open_stream(self.path) as stream:
            for batch in stream:
                for code, content, chars, key, count in zip(*[c.to_pylist() for c in batch.columns]):
                    yield int.from_bytes(code, "big"), content, (chars, key), count
        os.unlink(self.path)


def grace(rows: Iterable[tuple], key_type: pa.DataType, budget: int = BUDGET, level: int = 0, folder: str | None = None) -> Iterator[list]:
    """The entries of all rows (hash, content, best, count), by a table where they fit and by spill files where they don't."""
    table, spills = OpenTable(), None
    schema = pa.schema([("code", pa.binary()), ("content", pa.binary()), ("chars", pa.int64()), ("key", key_type), ("count", pa.int64())])
    with tempfile.TemporaryDirectory(dir=folder) as own:
        for row in rows:
            if spills is not None:
                spills[(row[0] >> (60 - 4 * level)) % FAN].add(*row)
                continue
            table.add(*row)
            # Beyond the last level the hashes are the same: what is left are copies, or texts whose hashes clash.
            if table.bytes > budget and level < LEVELS:
                spills = [Spill(f"{own}/{k}", schema) for k in range(FAN)]
                for entry in table:
                    spills[(entry[0] >> (60 - 4 * level)) % FAN].add(*entry)
                table = OpenTable()
        if spills is None:
            yield from table
            return
        for spill in spills:
            yield from grace(spill.read(), key_type, budget, level + 1, own)


#: The first 8 bytes of the digest deal out rows; the next 8 are the hash of the tables.
def _code(digest: bytes) -> int:
    return int.from_bytes(digest[8:16], "big")


def _local(key_type: pa.DataType, budget: int):
    """Each task's rows, met in a table that is emptied when it is full."""
    names = ["digest", "content", "chars", "key", "count"]
    kinds = [pa.binary(), pa.binary(), pa.int64(), key_type, pa.int64()]

    def emptied(table: OpenTable):
        rows, held = [], 0
        for code, content, best, count in table:
            rows.append((hashlib.sha256(content).digest(), content, best[0], best[1], count))
            held += len(content)
            if held > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable()
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                content = normal(text)
                table.add(_code(hashlib.blake2b(content, digest_size=16).digest()), content, (len(text or ""), key), 1)
                if table.bytes > budget:
                    yield from emptied(table)
                    table = OpenTable()
        yield from emptied(table)

    return run


def _met(key_type: pa.DataType, budget: int):
    names, kinds = ["digest", "keep_id", "group_size"], [pa.binary(), key_type, pa.int64()]

    def rows(batches):
        for batch in batches:
            for digest, content, chars, key, count in zip(*[batch.column(c).to_pylist() for c in ("digest", "content", "chars", "key", "count")]):
                yield _code(digest), content, (chars, key), count

    def run(batches):
        out = []
        for _, content, best, count in grace(rows(batches), key_type, budget):
            out.append((hashlib.sha256(content).digest(), best[1], count))
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


def groups(df: DataFrame, key: str, text: str, budget: int = BUDGET) -> DataFrame:
    """(text_sha256, keep_id, group_size) of every group of equal texts."""
    kind = df.schema[key].dataType
    sql = kind.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    local = rows.mapInArrow(_local(_arrow(kind), budget), f"digest binary, content binary, chars long, key {sql}, count long")
    met = local.repartition("digest").mapInArrow(_met(_arrow(kind), budget), f"digest binary, keep_id {sql}, group_size long")
    return met.select(F.lower(F.hex("digest")).alias("text_sha256"), "keep_id", "group_size")


def text_sha256(text) -> F.Column:
    """The digest of a text without ASCII white space, as lowercase hex."""
    bare = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    for blank in _BLANKS.decode():
        bare = F.replace(bare, F.lit(blank), F.lit(""))
    return F.sha2(bare, 256)


def exact_groups(df: DataFrame, key: str, text: str, budget: int = BUDGET) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256) of every row of ``df``."""
    members = df.select(F.col(key).alias("key"), text_sha256(text).alias("text_sha256"))
    members = members.withColumn("again", F.row_number().over(Window.partitionBy("key", "text_sha256").orderBy("key")))
    # Copies of one text may be a third of all members: a plain inner join, with nothing above it, which Spark splits where it is skewed.
    joined = members.join(groups(df, key, text, budget), "text_sha256")
    return joined.select("key", "keep_id", "group_size", (F.col("key").eqNullSafe(F.col("keep_id")) & (F.col("again") == 1)).alias("kept"), "text_sha256")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_groups(docs, "doc_id", "text").withColumnRenamed("key", "doc_id")


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare
  FROM documents
), g AS (
  SELECT doc_id, bare,
         first_value(doc_id) OVER w AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size
  FROM d WINDOW w AS (PARTITION BY bare ORDER BY length(t) DESC, doc_id)
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256 FROM g
"""
