"""What the operators of this package share: written tables, and text as numpy arrays."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.scratch import scratch

SLICE_BYTES = 8 << 20
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the cluster's shared folder and read again: computed once, its lineage
    cut, its size known to the planner. Zstandard keeps the files that later stages hold on disk small."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each doc_id and text, a null text being empty, with all columns, whatever their names."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.sha2(F.coalesce(F.col("row.text"), F.lit("")), 256)
    return row.select("row", F.col("row.doc_id").alias("id"), text.alias("sha")).dropDuplicates(["id", "sha"]).select("row.*")


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches again, in pieces whose `column` has about `most` bytes, one row at least.

    At the end free memory goes back to the system: a worker lives on for tasks of other kinds.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False)
        cut = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // most)) + 1
        for start, end in zip([0, *cut], [*cut, batch.num_rows]):
            yield batch.slice(start, end - start)
    trim()


def trim() -> None:
    """Give the process's freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def whole(column: pa.Array, kind: pa.DataType) -> pa.Array:
    """A batch column as one array of `kind` that starts at its buffers' start; nulls become empty."""
    return pa.concat_arrays([pc.fill_null(column.cast(kind), b"" if pa.types.is_binary(kind) or pa.types.is_large_binary(kind) else "")])


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets) of a text or binary column; nulls are empty."""
    column = whole(column, pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1)
    return np.frombuffer(data, dtype=np.uint8, count=int(at[-1])) if data is not None and at[-1] else np.zeros(0, np.uint8), at


def words_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word codes of all texts in a row, offsets by text, words by code): what ASCII white space parts."""
    texts = whole(column, pa.large_string())
    # a text that begins or ends with white space gives empty words there
    parts = pc.ascii_split_whitespace(texts)
    offsets = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    words = coded.dictionary
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        keep = codes != empty
        offsets = np.concatenate([[0], np.cumsum(keep)])[offsets]
        codes = codes[keep]
    return codes, offsets, words


def hash_words(words: pa.Array, key: str = "millrace-llm-key") -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    values = np.array(words.to_pylist(), dtype=object)
    return pd.util.hash_array(values, hash_key=key, categorize=False) if len(values) else np.zeros(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX[0]
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX[1]
    return x ^ (x >> np.uint64(31))


def owners(offsets: np.ndarray) -> np.ndarray:
    """For each element of a flat array, the row that it belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Rows of a flat numpy array as binary cells; `offsets` count elements."""
    width = values.dtype.itemsize
    at = pa.py_buffer(np.ascontiguousarray(offsets * width, dtype=np.int32 if offsets[-1] * width < 2**31 else np.int64))
    kind = pa.binary() if offsets[-1] * width < 2**31 else pa.large_binary()
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(values))])
