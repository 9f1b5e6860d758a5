"""Packing documents into sequences by shortest-pack-first over the length histogram.

A document's ids are cut at every multiple of the sequence length; the rest is a piece of
its own. The histogram of piece lengths (at most as many rows as a sequence has places) goes
to the driver, which places lengths longest first, always into the packs that are shortest
so far, and opens new packs where a length fits into none. Packs of equal make-up are one
pattern with a count, so the work depends on the number of lengths, not of documents.

Pieces take their place by rank: the pieces of a length are numbered, and each (pattern,
length) owns a range of numbers. The table of ranges has a proven bound: placing a length
splits at most one pattern, so there are at most two patterns for every length, and a
pattern has at most sqrt(2 * places) different lengths.

Hot lengths: numbers are given inside (length, bucket of a hash), and the counts of the
buckets before are added, so a length that a third of all pieces have is no single task.

Nulls and ties: a null text is empty, so its only id is the end id. Pieces of one length
are interchangeable; rows that repeat a doc_id are packed row by row. An empty table gives
no sequences; further columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import owners, slices, written
from millrace.llm.tokens import SLICE_BYTES, default_tokenizer, encoder

PLACES = 4096
BUCKETS = 256


def pieces(docs: DataFrame, tokenizer: str, places: int = PLACES, by_word: bool = True) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens for every piece of every document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, by_word)
        for batch in slices(batches, "text", SLICE_BYTES):
            ids, at = own.encode(batch["text"])
            lengths = np.diff(at)
            counts = -(-lengths // places)
            first = np.concatenate([[0], np.cumsum(counts)])
            row = owners(first)
            start = (np.arange(first[-1]) - first[row]) * places
            length = np.minimum(lengths[row] - start, places)
            data = memoryview(ids.astype("<u4")).cast("B")
            begin = at[row] + start
            crc = [zlib.crc32(data[4 * b:4 * (b + n)]) for b, n in zip(begin.tolist(), length.tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(lengths[row])],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def shortest_pack_first(histogram: dict[int, int], places: int = PLACES) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of packs, [(length, times in a pack), ...]) that hold every piece of a histogram."""
    heap: list[tuple[int, int, int, tuple]] = []  # (filled, order of making, packs, make-up as nested pairs)
    made = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= places:
            raise ValueError(f"no piece of {length} ids fits")
        while left:
            if heap and heap[0][0] + length <= places:
                filled, _, packs, inside = heapq.heappop(heap)
            else:
                filled, packs, inside = 0, left, ()
            used = min(packs, left)
            if used < packs:
                made += 1
                heapq.heappush(heap, (filled, made, packs - used, inside))
            # as often in each pack as there is room and all of them get their share
            times = 1
            if inside and inside[0][0] == length:
                inside, times = inside[1], inside[0][1] + 1
            made += 1
            heapq.heappush(heap, (filled + length, made, used, ((length, times), inside)))
            left -= used
    out = []
    for _, _, packs, inside in sorted(heap, key=lambda x: x[1]):
        parts = []
        while inside:
            parts.append(inside[0])
            inside = inside[1]
        out.append((packs, parts[::-1]))
    return out


def ranges(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[str, np.ndarray]:
    """For every (pattern, length): the first rank it owns, its first sequence, offset and times in a pack, by length and rank."""
    rows, taken, sequence = [], {}, 0
    for packs, parts in patterns:
        offset = 0
        for length, times in parts:
            rank = taken.get(length, 0)
            rows.append((length, rank, sequence, offset, times))
            taken[length] = rank + packs * times
            offset += length * times
        sequence += packs
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "offset", "times"), table.T))


def numbered(cut: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """`cut` with the rank of a piece among those of its length."""
    dealt = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = (dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    return (dealt.withColumn("nth", F.row_number().over(own) - 1).join(counts, ["length", "bucket"])
            .withColumn("rank", F.col("before") + F.col("nth")).drop("bucket", "nth", "before", "n"))


def placed(ranked: DataFrame, table: dict[str, np.ndarray]) -> DataFrame:
    """Pieces with sequence_id and offset, each looked up by (length, rank) among the ranges."""
    fields = [f for f in ranked.schema.fields if f.name != "rank"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "sequence_id bigint", "offset bigint"])
    shared = ranked.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        # ranges lie in order of (length, rank); a length's first range is found by search, the one of a rank by a second one
        start = {int(n): i for n, i in zip(*np.unique(t["length"], return_index=True))}
        stop = dict(zip(start, [*list(start.values())[1:], len(t["length"])]))
        for batch in batches:
            length, rank = (batch[c].to_numpy() for c in ("length", "rank"))
            row = np.zeros(len(length), dtype=np.int64)
            for n in np.unique(length):
                mine = length == n
                a, b = start[int(n)], stop[int(n)]
                row[mine] = a + np.searchsorted(t["rank"][a:b], rank[mine], side="right") - 1
            nth = rank - t["rank"][row]
            sequence = t["sequence"][row] + nth // t["times"][row]
            offset = t["offset"][row] + nth % t["times"][row] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch[f.name] for f in fields), pa.array(sequence), pa.array(offset)],
                [*(f.name for f in fields), "sequence_id", "offset"])

    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str | None = None, places: int = PLACES, by_word: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = written(pieces(docs, tokenizer or default_tokenizer(), places, by_word), "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `places` rows
    return placed(numbered(cut), ranges(shortest_pack_first(histogram, places)))
