"""Token ids in files: one concatenated array in order of doc_id, document ends in Elias-Fano form.

A dataset is a folder of blocks, a row each (Parquet is only the box: Spark's commit makes a
lost task's output vanish, and any store that Spark writes will do):

    shard, block    place in the order of all documents: shards by id range, blocks inside
    first           ids of the shard before this block
    n_docs, n_ids   of this block
    width           bytes of an id, little endian: 2 for vocabularies up to 65,536, else 4
    least, most     doc_id of the first and last document that has one
    doc_ids         64-bit, ascending
    ids             the documents' ids in a row
    low_bits, low, high, samples   the n_docs + 1 boundaries, see `EliasFano`

The boundaries take about 2 + log2(ids / documents) bits each instead of 64.

Documents are dealt by ranges of (doc_id, hash of the text), so an id that very many rows
repeat is cut too; such rows lie in order of that hash. A null doc_id comes first. A null
text is empty: its only id is the end id. An empty table gives no block; further columns are
not read. A block ends with the document that fills it, so memory is a block and a text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import slices
from millrace.llm.tokens import SLICE_BYTES, default_tokenizer, encoder
from millrace.sources.scratch import scratch

BLOCK_IDS = 1 << 20
STEP = 64  # ones between two samples
RUN = 4096  # documents read at a time
BLOCKS = ("shard int, block bigint, first bigint, n_docs bigint, n_ids bigint, width int, least bigint, most bigint, doc_ids binary, null_ids bigint, "
          "ids binary, low_bits int, low binary, high binary, samples binary")


class EliasFano:
    """A rising sequence of n numbers up to u: the low bits of each in a row, the rest as gaps in
    unary. Number i is `(select(i) - i) << low_bits | low[i]`, where select gives the place of the
    i-th one; every STEP-th place is kept, so a look-up reads a few words."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n, most = len(values), int(values[-1]) if len(values) else 0
        low_bits = max(0, (most // max(n, 1)).bit_length() - 1)
        low = (values[:, None] >> np.arange(low_bits)) & 1 if n else np.zeros((0, 0))
        places = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[places] = 1
        return cls(n, low_bits, np.packbits(low.astype(np.uint8).ravel(), bitorder="little"),
                   np.packbits(bits, bitorder="little"), places[::STEP].astype("<u4"))

    def select(self, i: int) -> int:
        """Place of the i-th one, from the sample before it."""
        at, left = int(self.samples[i // STEP]), i % STEP
        byte = at >> 3
        word = int(self.high[byte]) >> (at & 7) << (at & 7)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        return (byte << 3) + (word & -word).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        rest = 0
        for k in range(self.low_bits):
            at = i * self.low_bits + k
            rest |= (int(self.low[at >> 3]) >> (at & 7) & 1) << k
        return (self.select(i) - i) << self.low_bits | rest

    def stretch(self, a: int, b: int) -> np.ndarray:
        """Numbers a to b - 1; the high bits are read from the sample at or before a to the one at or after b."""
        if a >= b:
            return np.zeros(0, dtype=np.int64)
        near, after = a // STEP, -(-b // STEP)
        start, byte = int(self.samples[near]), int(self.samples[near]) >> 3
        stop = (int(self.samples[after]) >> 3) + 1 if after < len(self.samples) else len(self.high)
        places = np.flatnonzero(np.unpackbits(self.high[byte:stop], bitorder="little")) + 8 * byte
        nth = np.arange(a, b, dtype=np.int64)
        places = places[places >= start][a - near * STEP:b - near * STEP]
        bits = nth[:, None] * self.low_bits + np.arange(self.low_bits)
        low = (self.low[bits >> 3] >> (bits & 7).astype(np.uint8) & 1).astype(np.int64)
        return ((places - nth) << self.low_bits) + (low << np.arange(self.low_bits)).sum(axis=1)

    def all(self) -> np.ndarray:
        return self.stretch(0, self.n)


def _block(shard: int, block: int, first: int, doc_ids: list, ids: list[np.ndarray], width: int) -> pa.RecordBatch:
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    ends = EliasFano.of(np.concatenate([[0], np.cumsum(sizes)]))
    known = [i for i in doc_ids if i is not None]
    row = {
        "shard": shard, "block": block, "first": first, "n_docs": len(ids), "n_ids": int(sizes.sum()), "width": width,
        "least": known[0] if known else None, "most": known[-1] if known else None,
        "doc_ids": np.array(known, dtype="<i8").tobytes(), "null_ids": len(doc_ids) - len(known),
        "ids": np.concatenate(ids).astype(f"<u{width}").tobytes(), "low_bits": ends.low_bits,
        "low": ends.low.tobytes(), "high": ends.high.tobytes(), "samples": ends.samples.tobytes(),
    }
    kinds = {"shard": pa.int32(), "width": pa.int32(), "low_bits": pa.int32()}
    return pa.RecordBatch.from_arrays(
        [pa.array([v], kinds.get(k, pa.binary() if isinstance(v, bytes) else pa.int64())) for k, v in row.items()], list(row))


def write(docs: DataFrame, path: str, tokenizer: str | None = None, by_word: bool = True, block_ids: int = BLOCK_IDS) -> str:
    """Encode every text and write the dataset."""
    tokenizer = tokenizer or default_tokenizer()
    text = F.coalesce(F.col("text"), F.lit(""))
    ordered = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
               .repartitionByRange(F.asc_nulls_first("doc_id"), F.asc("tie"))
               .sortWithinPartitions(F.asc_nulls_first("doc_id"), "tie", "text").drop("tie"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard = encoder(tokenizer, by_word), TaskContext.get().partitionId()
        block, first, held, doc_ids, ids = 0, 0, 0, [], []
        for batch in slices(batches, "text", SLICE_BYTES):
            flat, at = own.encode(batch["text"])
            flat = flat.astype(f"<u{own.width}")
            for doc_id, a, b in zip(batch["doc_id"].to_pylist(), at[:-1].tolist(), at[1:].tolist()):
                doc_ids.append(doc_id)
                ids.append(flat[a:b])
                held += b - a
                if held >= block_ids:
                    yield _block(shard, block, first, doc_ids, ids, own.width)
                    block, first, held, doc_ids, ids = block + 1, first + held, 0, [], []
        if ids:
            yield _block(shard, block, first, doc_ids, ids, own.width)

    ordered.mapInArrow(run, BLOCKS).write.option("compression", "zstd").option("parquet.block.size", 32 << 20).parquet(path)
    return path


def _bases(blocks: DataFrame) -> DataFrame:
    """Ids before each shard: one row per shard, of which there are as many as a shuffle has partitions."""
    sums = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def _boundaries(row: dict) -> EliasFano:
    return EliasFano(row["n_docs"] + 1, row["low_bits"], np.frombuffer(row["low"], np.uint8),
                     np.frombuffer(row["high"], np.uint8), np.frombuffer(row["samples"], "<u4"))


def read(spark, path: str) -> DataFrame:
    """One row per document of a dataset, in the order written: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The boundaries are read through the samples, `RUN` documents at a time; no table of them is made.
    """
    blocks = spark.read.schema(BLOCKS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, nulls = _boundaries(row), row["null_ids"]
                ids, doc_ids = np.frombuffer(row["ids"], f"<u{row['width']}"), np.frombuffer(row["doc_ids"], "<i8")
                for a in range(0, row["n_docs"], RUN):
                    b = min(a + RUN, row["n_docs"])
                    ends = held.stretch(a, b + 1)
                    raw = memoryview(ids[ends[0]:ends[-1]].astype("<u4")).cast("B")
                    at = 4 * (ends - ends[0])
                    crc = [zlib.crc32(raw[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
                    named = [None] * max(0, min(nulls, b) - a) + doc_ids[max(a - nulls, 0):max(b - nulls, 0)].tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["shard"]] * len(crc), pa.int32()), pa.array(named, pa.int64()),
                         pa.array(ends[:-1] + row["first"]), pa.array(np.diff(ends)), pa.array(crc, pa.int64())],
                        ["shard", "doc_id", "inside", "n_tokens", "ids_crc32"])

    docs = blocks.mapInArrow(run, "shard int, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint")
    return docs.join(F.broadcast(_bases(blocks)), "shard").select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def look_up(spark, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """doc_id, start and ids (array) of the documents asked for, one row for each that has the id; unknown ids give none.

    Only blocks whose range holds an id asked for are opened, and of those two boundaries by
    document, each by `select`. The ids asked for go along with every task, so they are a short list.
    """
    asked = sorted(set(doc_ids))
    if not asked:
        return spark.createDataFrame([], "doc_id bigint, start bigint, ids array<bigint>")
    blocks = spark.read.schema(BLOCKS).parquet(path)
    held_ids = F.exists(F.array(*map(F.lit, asked)), lambda i: i.between(F.col("least"), F.col("most")))
    near = blocks.where((F.col("least") <= asked[-1]) & (F.col("most") >= asked[0]) & held_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends, ids = _boundaries(row), np.frombuffer(row["ids"], f"<u{row['width']}")
                known = np.frombuffer(row["doc_ids"], "<i8")
                lo, hi = np.searchsorted(known, asked, "left"), np.searchsorted(known, asked, "right")
                for i in (i for a, b in zip(lo.tolist(), hi.tolist()) for i in range(a, b)):
                    start, end = ends[i + row["null_ids"]], ends[i + row["null_ids"] + 1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["shard"]], pa.int32()), pa.array([int(known[i])], pa.int64()),
                         pa.array([start + row["first"]], pa.int64()),
                         pa.array([ids[start:end].astype(np.int64)], pa.list_(pa.int64()))], ["shard", "doc_id", "inside", "ids"])

    found = near.mapInArrow(run, "shard int, doc_id bigint, inside bigint, ids array<bigint>")
    return found.join(F.broadcast(_bases(blocks)), "shard").select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "ids")


def write_and_read(docs: DataFrame, **options) -> DataFrame:
    path = write(docs, scratch(docs.sparkSession, "ids"), **options)
    return read(docs.sparkSession, path)
