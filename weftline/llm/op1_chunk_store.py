"""A content-addressed store of token ids.

A rolling hash over the last WINDOW ids marks the places at which a document's
id stream is cut, so equal stretches are cut alike wherever they stand. A chunk
is addressed by a hash of its bytes and stored once. Documents are kept as
recipes, the addresses of their chunks in order, each under a Merkle root.

Layout below a folder, all Parquet compressed with zstd:

* ``pack/kind=0``: chunks, key = address, ids = little-endian unsigned
  integers of 2 bytes (4 if the vocabulary needs them), one row an address;
* ``pack/kind=1``: recipes as they were made, one row for each document;
* ``manifest``: recipes in ascending order of the key, with the number of ids
  before the document and the Merkle root of its chunks.

One pass encodes: chunks and recipes go through one shuffle by address, or by
document, into their files. A chunk that repeats within a task is sent once by
it, so a chunk that a third of all documents share costs a row for each task.

Reading back: each chunk is read from its file, its address is recomputed, and
its length and CRC are joined to the recipes; the CRC of a document follows
from those of its chunks and the bytes after each, as CRCs are linear. No task
holds more than a batch of chunks. ``documents_ids`` restores whole streams.

Defined results: a null text is empty and has the end id alone; a very long text
is one stream of chunks; keys are integers; rows with the same key are documents
of their own, in the order of their recipes; an empty table gives empty files;
further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import exclusive_prefix, work_folder, written

#: Ids that the rolling hash covers, least and most ids of a chunk, and the bits that have to be zero at a cut (one place in 2 ** BITS).
WINDOW, LEAST, MOST, BITS = 16, 128, 4096, 9
#: Bytes of an address.
ADDRESS = 16
#: Addresses that a task remembers having sent; bytes of ids in a batch that it sends.
SENT, OUT = 500_000, 8 << 20


def _table() -> np.ndarray:
    """A 64-bit mix of every id below 2 ** 16; other ids use the entry of their low bits plus a mix of the high ones."""
    x = (np.arange(1 << 16, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MIX = _table()


def rolling(ids: np.ndarray) -> np.ndarray:
    """At each place a hash of it and the WINDOW - 1 ids before: the sum of their mixes, each shifted by its distance, by doubling."""
    h = _MIX[ids & 0xFFFF] + (ids >> 16).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    width = 1
    while width < WINDOW:
        longer = h.copy()
        longer[width:] += h[:-width] << np.uint64(width)
        h, width = longer, 2 * width
    return h


def cuts(candidates: np.ndarray, length: int) -> list[int]:
    """Ends of the chunks of a stream, given the places after which the hash allows a cut."""
    ends, last = [], 0
    for at in candidates.tolist():
        while at - last > MOST:
            last += MOST
            ends.append(last)
        if at - last >= LEAST and at < length:
            last = at
            ends.append(at)
    while length - last > MOST:
        last += MOST
        ends.append(last)
    return [*ends, length]


def chunk(ids: np.ndarray) -> list[np.ndarray]:
    """A stream's chunks."""
    ends = cuts(np.flatnonzero((rolling(ids) >> np.uint64(64 - BITS)) == 0) + 1, len(ids))
    return [ids[a:b] for a, b in zip([0, *ends], ends)]


def address(part: bytes) -> bytes:
    return hashlib.blake2b(part, digest_size=ADDRESS).digest()


def merkle_root(leaves: list[bytes]) -> bytes:
    """The root over chunk addresses; leaves and nodes are hashed apart, an odd one moves up."""
    level = [hashlib.sha256(b"\x00" + x).digest() for x in leaves]
    while len(level) > 1:
        level = [hashlib.sha256(b"\x01" + b"".join(level[k : k + 2])).digest() if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0] if level else hashlib.sha256(b"").digest()


def _pack(path: str, end_id: int, wide: bool, key_type: pa.DataType):
    """Rows of both kinds: (0, address, ids) and (1, document's number, addresses, lengths)."""
    store = "<u4" if wide else "<u2"
    schema = pa.schema([("kind", pa.int32()), ("key", pa.binary()), ("ids", pa.binary()), ("doc", key_type), ("lengths", pa.binary()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, sent = tokens.raw_ids_of_all(path), set()
        end = np.array([end_id], "<u4").tobytes()

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)

        for batch in batches:
            rows, held = [], 0
            for doc, number, raw in zip(batch.column("doc").to_pylist(), batch.column("number").to_pylist(), encode(batch.column("text"))):
                ids = np.frombuffer(raw + end, "<u4")
                parts = chunk(ids)
                addresses = []
                for part in parts:
                    a = address(part.tobytes())
                    addresses.append(a)
                    if a not in sent:
                        if len(sent) >= SENT:
                            sent.clear()
                        sent.add(a)
                        rows.append((0, a, part.astype(store).tobytes(), None, None, len(part)))
                rows.append((1, number.to_bytes(8, "big"), b"".join(addresses), doc, np.array([len(p) for p in parts], "<u4").tobytes(), len(ids)))
                held += len(raw)
                if held > OUT:
                    yield batch_of(rows)
                    rows, held = [], 0
            yield batch_of(rows)

    return run


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def write_store(df: DataFrame, key: str, text: str, folder: str, path: str, end_id: int = 0, wide: bool = False) -> DataFrame:
    """Encode every row's whole text with the vocabulary at ``path``, append ``end_id``, and write the store; returns the manifest as read back."""
    spark = df.sparkSession
    kind = df.schema[key].dataType
    rows = df.select(F.col(key).alias("doc"), F.monotonically_increasing_id().alias("number"), F.col(text).alias("text"))
    packed = rows.mapInArrow(_pack(path, end_id, wide, _arrow(kind)), f"kind int, key binary, ids binary, doc {kind.simpleString()}, lengths binary, n_tokens long")
    # One row an address: tasks have met their own rows, and a row of each meets the others'.
    once = packed.repartition("kind", "key").groupBy("kind", "key").agg(*[F.first(c).alias(c) for c in ("ids", "doc", "lengths", "n_tokens")])
    recipes = written(once, f"{folder}/pack", ["kind"]).where("kind = 1")
    ordered = exclusive_prefix(recipes.select("doc", "key", "n_tokens"), "doc", "n_tokens", "start", ["key"])
    roots = F.udf(lambda a: merkle_root([bytes(a[k : k + ADDRESS]) for k in range(0, len(a), ADDRESS)]), T.BinaryType(), useArrow=True)
    manifest = recipes.select("key", F.col("ids").alias("addresses"), "lengths").join(ordered, "key").select("doc", "key", "start", "n_tokens", "addresses", "lengths", roots("addresses").alias("root"))
    # Files in ascending order of the key.
    return written(manifest.repartitionByRange("doc", "key").sortWithinPartitions("doc", "key"), f"{folder}/manifest")


def chunks(spark: SparkSession, folder: str) -> DataFrame:
    schema = "key binary, ids binary, doc long, lengths binary, n_tokens long, kind int"
    return spark.read.schema(schema).parquet(f"{folder}/pack").where("kind = 0").select("key", "ids")


def _digest(wide: bool):
    """(address, its ids' number, their CRC) of chunks as they are in their files; an address that does not fit its bytes is an error."""
    store = "<u4" if wide else "<u2"

    def run(batches):
        for batch in batches:
            keys, n, crc = batch.column("key").to_pylist(), [], []
            for k, ids in zip(keys, batch.column("ids").to_pylist()):
                raw = np.frombuffer(ids, store).astype("<u4").tobytes()
                if address(raw) != k:
                    raise ValueError(f"chunk {k.hex()} does not hold what its address says")
                n.append(len(raw) // 4)
                crc.append(zlib.crc32(raw))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["key", "n", "crc"])

    return run


def _shift_tables(bits: int = 48) -> np.ndarray:
    """For each k, by byte of a CRC, what 2 ** k zero bytes after it make of it."""
    poly = 0xEDB88320
    one = np.array([1 << k for k in range(32)], dtype=np.uint64)

    def step(rows: np.ndarray) -> np.ndarray:  # a zero bit after
        return np.where(rows & 1, (rows >> np.uint64(1)) ^ np.uint64(poly), rows >> np.uint64(1))

    rows = one
    for _ in range(8):
        rows = step(rows)
    tables = []
    for _ in range(bits):
        table = np.zeros((4, 256), dtype=np.uint64)
        for byte in range(4):
            for bit in range(8):
                on = (np.arange(256) >> bit) & 1 == 1
                table[byte, on] ^= rows[8 * byte + bit]
        tables.append(table)
        rows = _apply(table, rows)
    return np.array(tables)


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = np.zeros(len(crc), dtype=np.uint64)
    for byte in range(4):
        out ^= table[byte][((crc >> np.uint64(8 * byte)) & np.uint64(255)).astype(np.int64)]
    return out


def crc_shift(crc: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What each CRC adds to that of a stream in which ``after`` bytes follow its part: the exclusive or of these is the stream's CRC."""
    tables = tokens.shared(("crc",), _shift_tables)
    crc, after = crc.astype(np.uint64), after.astype(np.int64)
    for k in range(int(after.max(initial=0)).bit_length()):
        on = (after >> k) & 1 == 1
        if on.any():
            crc[on] = _apply(tables[k], crc[on])
    return crc


def _steps(batches):
    """The chunks of recipes: (document, address, number in it, ids, bytes after). A recipe that does not fit its Merkle root is an error."""
    names = ["doc_key", "key", "seq", "len", "after"]
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            out = [[] for _ in names]
            for doc, addresses, lengths, root in zip(*[part.column(c).to_pylist() for c in ("key", "addresses", "lengths", "root")]):
                if merkle_root([addresses[k : k + ADDRESS] for k in range(0, len(addresses), ADDRESS)]) != root:
                    raise ValueError("a recipe does not fit its Merkle root")
                n = np.frombuffer(lengths, "<u4").astype(np.int64)
                out[0].extend([doc] * len(n))
                out[1].extend(addresses[k : k + ADDRESS] for k in range(0, len(addresses), ADDRESS))
                out[2].extend(range(len(n)))
                out[3].extend(n.tolist())
                out[4].extend((4 * (n.sum() - n.cumsum())).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))], names)


def read_digests(manifest: DataFrame, folder: str, wide: bool = False) -> DataFrame:
    """(doc, start, n_tokens, ids_crc32, chunks) of every document from the files; n_tokens and the CRC come from the chunks' own bytes."""
    spark = manifest.sparkSession
    stored = chunks(spark, folder).mapInArrow(_digest(wide), "key binary, n long, crc long")
    steps = manifest.select("key", "addresses", "lengths", "root").mapInArrow(_steps, "doc_key binary, key binary, seq long, len long, after long")

    @F.pandas_udf("long")
    def moved(crc, after):
        import pandas as pd

        return pd.Series(crc_shift(crc.to_numpy(), after.to_numpy()).astype(np.int64))

    read = steps.join(stored, "key").select("doc_key", "n", moved("crc", "after").alias("part"))
    sums = read.groupBy("doc_key").agg(F.sum("n").alias("n_read"), F.bit_xor("part").alias("ids_crc32"), F.count("*").alias("chunks"))
    # A missing chunk or one of another length shows as another number of ids than the manifest has.
    sure = F.when(F.col("n_read") == F.col("n_tokens"), F.col("n_read")).otherwise(F.raise_error(F.lit("a document's chunks do not add up")))
    return manifest.select("doc", "start", "key", "n_tokens").join(sums, F.col("key") == F.col("doc_key")).select("doc", "start", sure.cast("long").alias("n_tokens"), "ids_crc32", "chunks")


def documents_ids(manifest: DataFrame, folder: str, wide: bool = False) -> DataFrame:
    """(doc, ids binary of little-endian 32-bit integers): whole streams restored from the store, each checked against its Merkle root."""
    store = "<u4" if wide else "<u2"
    steps = manifest.select("key", "addresses", "lengths", "root").mapInArrow(_steps, "doc_key binary, key binary, seq long, len long, after long")
    parts = steps.join(chunks(manifest.sparkSession, folder), "key").groupBy("doc_key").agg(F.array_sort(F.collect_list(F.struct("seq", "ids", "key"))).alias("parts"))

    @F.udf(T.BinaryType())
    def restored(rows, root):
        raw = [np.frombuffer(r["ids"], store).astype("<u4").tobytes() for r in rows]
        if merkle_root([address(r) for r in raw]) != bytes(root):
            raise ValueError("a document does not fit its Merkle root")
        return b"".join(raw)

    return manifest.join(parts, F.col("key") == F.col("doc_key")).select("doc", restored("parts", "root").alias("ids"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = work_folder(spark)
    manifest = write_store(docs, "doc_id", "text", folder, tokens.vocabulary("byte_bpe_50k.json"))
    return read_digests(manifest, folder).withColumnRenamed("doc", "doc_id")
