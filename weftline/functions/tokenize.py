"""Tokenizers by name, applied in Arrow batches; the byte tokenizer needs no vocabulary and works on a batch's bytes at once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col

#: Name to a function that makes, in the worker, a function from texts to lists of ids.
TOKENIZERS: dict[str, Callable[[], Callable[[list[str]], list[list[int]]]]] = {}


def register(name: str, make: Callable[[], Callable[[list[str]], list[list[int]]]]) -> None:
    TOKENIZERS[name] = make


def _bytes() -> Callable[[list[str]], list[list[int]]]:
    return lambda texts: [[b + 2 for b in t.encode()] for t in texts]


def _of_file(path: str) -> Callable[[], Callable[[list[str]], list[list[int]]]]:
    """An exact tokenizer by its vocabulary's file: of the tokenizers library (``.json``) or of sentencepiece (``.model``)."""

    def json():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def model():
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: pieces.encode(texts, num_threads=1)

    return json if path.endswith(".json") else model


def maker(tokenizer: str) -> Callable[[], Callable[[list[str]], list[list[int]]]]:
    """What makes the tokenizer of a name, or of a vocabulary's file, in a worker."""
    if tokenizer == "bytes":
        return _bytes
    if tokenizer.endswith((".json", ".model")):
        return _of_file(tokenizer)
    return TOKENIZERS[tokenizer]


def _gapless(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of the texts of a batch, a null as an empty one."""
    column = column.fill_null("") if column.null_count else column
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return ends.astype(np.int64) - ends[0], data[ends[0] : ends[-1]]


def byte_lists(texts: pa.Array, end: int | None = 1, shift: int = 2) -> pa.Array:
    """What ``text.byte_ids`` gives, for a whole batch."""
    texts = texts.cast(pa.string())
    at, data = _gapless(texts)
    n, own = len(texts), end is not None
    out = np.empty(len(data) + n * own, np.int32)
    at = at + np.arange(n + 1) * own
    inside = np.ones(len(out), bool)
    if own:
        inside[at[1:] - 1] = False
        out[at[1:] - 1] = end
    out[inside] = data.astype(np.int32) + shift
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out), mask=texts.is_null())


def byte_strings(ids: pa.Array, shift: int = 2) -> pa.Array:
    """What ``text.byte_text`` gives, for a whole batch."""
    sizes = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = ids.flatten().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    keep = flat >= shift
    at = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
    data = (flat[keep] - shift).astype(np.uint8)
    whole = pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(at), pa.py_buffer(data)]).cast(pa.string())
    return pa.compute.if_else(ids.is_null(), pa.scalar(None, pa.string()), whole)


def texts(c) -> Column:
    """The texts of byte ids; ids that are marks go."""
    import pyarrow.compute  # noqa: F401

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        import pyarrow.compute  # noqa: F401

        return byte_strings(column)

    return decode(col(c))


def ids(c, tokenizer: str = "bytes", end: int | None = 1) -> Column:
    """An array of token ids; ``bytes`` is the built-in one, and the path of a vocabulary's file names its tokenizer."""
    if tokenizer == "bytes":

        @F.arrow_udf("array<int>")
        def of_bytes(column: pa.Array) -> pa.Array:
            return byte_lists(column, end)

        return of_bytes(col(c))
    make = maker(tokenizer)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = make()  # once a task
        for texts in batches:
            yield pd.Series([x + ([] if end is None else [end]) for x in run(texts.fillna("").tolist())])

    return encode(col(c))


def tokenize(df: DataFrame, text: str = "text", tokenizer: str = "bytes", end: int | None = 1, least: int = 0) -> DataFrame:
    """Columns tokens and n_tokens; rows with fewer than ``least`` tokens go."""
    if tokenizer == "bytes":
        # So many bytes, so that short rows go before they are tokenized.
        out = df.withColumn("n_tokens", (F.octet_length(F.encode(col(text), "UTF-8")) + (0 if end is None else 1)).cast("long"))
        out = out.where(F.col("n_tokens") >= least) if least else out
        return out.select(*[x for x in out.columns if x not in ("tokens", "n_tokens")], ids(text, tokenizer, end).alias("tokens"), "n_tokens")
    out = df.withColumn("tokens", ids(text, tokenizer, end)).withColumn("n_tokens", F.size("tokens").cast("long"))
    return out.where(F.col("n_tokens") >= least) if least else out
