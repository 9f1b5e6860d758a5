"""Near-equal documents by improved consistent weighted sampling over TF-IDF shingles.

* A shingle is five words in a row (all words of a shorter text) and weighs its number of
  times in the text by its idf. Above the share `COMMON` of documents that is
  `ln((N + PRIOR) / df) / ln(1 / COMMON)`, 1 at that share and `FLOOR` at least; below, it
  rises on by `ln((COMMON (N + PRIOR) + PRIOR) / (df + PRIOR)) / ln(1 / COMMON)`. So every
  shingle needs its count. Slices of documents are inverted: ranges of hashes are counted
  where they meet, and the counts go back to their slice, where the documents are put together
  again; no text is shuffled, and a shingle that is everywhere is counted once by slice.
* A sample of a text is the shingle (and its weight step) of the smallest
  `a = c / (y e^r)`, with r, c from Gamma(2, 1), b uniform, `t = floor(ln w / r + b)` and
  `y = e^(r (t - b))`. Two texts agree in a sample with the chance of their weighted Jaccard
  similarity. `BANDS` bands of `ROWS` samples: at similarity 0.8 a pair shares no band in
  0.2 % of cases, at 0.9 in fewer than one of 10,000.
* The texts of a band's bucket are verified against its smallest one by weighted Jaccard
  similarity. Buckets in which more than one class is left then compare what is outside
  their largest class with all others, in blocks, until nothing links; so no link of a
  bucket is lost, and a group of n copies costs n comparisons and no pairs.

Equal texts are one class without any sampling, and only one of them is compared. Hot
buckets: counts and smallest members are partial aggregates; comparisons with one text are
dealt over a salt for every `BLOCK` members.

Nulls and ties: a null text is empty; texts without words link with equal texts only. A
document is a doc_id with a text: different texts under one doc_id, null too, are documents
of their own. The smallest (doc_id, text hash) of a class stays, and its doc_id names the
class; a null doc_id is the smallest. Of rows that repeat both one stays. An empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.frames import hash_words, mixed, one_of_each, slices, words_of, written

SHINGLE = 5
LEAST = 0.8
ROWS, BANDS = 4, 12
COMMON = 0.25
PRIOR = 100
FLOOR = 0.01
BLOCK = 256
PART_BYTES = 16 << 20  # of text whose shingles are counted together, about
SLICE_BYTES = 2 << 20  # of text looked at together: a worker holds some ten numbers for each of its words
_BITS = 50  # of a shingle's hash
_CHUNK = 1 << 15
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NULL = -2**63


def _gamma_table() -> np.ndarray:
    """Quantiles of Gamma(2, 1) at the middles of 2**16 equal shares: the x with 1 - (1 + x) e^-x = u."""
    u = (np.arange(1 << 16) + 0.5) / (1 << 16)
    x = np.maximum(np.sqrt(2 * u), -np.log1p(-u))
    for _ in range(60):
        x = np.maximum(x - (1 - (1 + x) * np.exp(-x) - u) / np.maximum(x * np.exp(-x), 1e-300), x / 4)
    return x


_GAMMA = _gamma_table().astype(np.float32)
_LOG_GAMMA = np.log(_gamma_table()).astype(np.float32)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingle hash, row, times): each different shingle of each text, by row and hash."""
    codes, at, words = words_of(column)
    own = hash_words(words)[codes]
    sizes = np.diff(at)
    n = np.where(sizes >= SHINGLE, sizes - SHINGLE + 1, np.minimum(sizes, 1))
    row = np.repeat(np.arange(len(sizes)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + at[:-1][row]
    length = np.minimum(sizes, SHINGLE)[row]
    hashes = length.astype(np.uint64)
    padded = np.concatenate([own, np.zeros(SHINGLE, np.uint64)])
    for k in range(SHINGLE):
        part = padded[start + k]
        hashes = np.where(k < length, (hashes ^ (hashes >> np.uint64(29))) * _STEP + part, hashes)
    hashes = mixed(hashes) >> np.uint64(64 - _BITS)
    if len(sizes) <= 1 << 64 - _BITS:  # one number to sort by
        keys = np.sort(row.astype(np.uint64) << np.uint64(_BITS) | hashes)
        row, hashes = (keys >> np.uint64(_BITS)).astype(np.int64), keys & np.uint64((1 << _BITS) - 1)
    else:
        order = np.lexsort((hashes, row))
        hashes, row = hashes[order], row[order]
    first = np.ones(len(row), dtype=bool)
    first[1:] = (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])
    places = np.flatnonzero(first)
    return hashes[places], row[places], np.diff(np.append(places, len(row)))


class Weights:
    """TF-IDF weights from the counts of all shingles; `hashes` and `idf` are those of the common ones.

    `documents` has (node, tie, keys, dfs) for every document with words: its band keys, and the
    document counts of its shingles, packed in the order of their hashes.
    """

    def __init__(self, hashes: np.ndarray, df: np.ndarray, n: int, documents: DataFrame | None = None):
        order = np.argsort(hashes)
        self.n, self.documents = n, documents
        self.hashes, self.idf = hashes[order], idf(df[order], n)


def idf(df: np.ndarray, n: int) -> np.ndarray:
    """ln((n + PRIOR) / df) in units of ln(1 / COMMON) above the share COMMON, where it is 1; below it rises on, PRIOR more documents on both sides."""
    unit, edge = math.log(1 / COMMON), (n + PRIOR) * COMMON
    df = np.maximum(df, 1)
    return np.where(df > edge, np.maximum(np.log((n + PRIOR) / df) / unit, FLOOR), 1 + np.log((edge + PRIOR) / (np.minimum(df, edge) + PRIOR)) / unit)


def weigh(times: np.ndarray, df: np.ndarray, n: int) -> np.ndarray:
    """Weights of shingles, in units of one that stands once in one document."""
    return times * (idf(df, n) / idf(np.ones(1), n))


def _weighed(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of weights other than one, their logarithms)."""
    other = np.flatnonzero(weights != 1)
    return other, np.log(weights[other]).astype(np.float32)


def samples(hashes: np.ndarray, weights: np.ndarray, first: np.ndarray, k: int, weighed: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """Sample `k` of each row; rows begin at `first` and none is empty."""
    x = hashes * _STEP + np.uint64(int(_STEP) * (2 * k + 1) % 2**64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    r, c = _GAMMA[x >> np.uint64(48)], _LOG_GAMMA[(x >> np.uint64(32)) & np.uint64(0xFFFF)]
    b = ((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.float32) * np.float32(2**-16)
    log_a = c - r * (np.float32(1) - b)  # of weight 1, where t is 0
    name = hashes & np.uint64(0xFFFFFFFF)
    other, logs = _weighed(weights) if weighed is None else weighed
    if len(other):
        own, part = r[other], b[other]
        t = np.floor(logs / own + part)
        log_a[other] = c[other] - own * (t - part + np.float32(1))
        name[other] = (hashes[other] ^ (t.astype(np.int64).view(np.uint64) * _STEP)) & np.uint64(0xFFFFFFFF)
    # positive floats are in the order of their bits; far below the range all are equal, and the name decides
    rising = np.maximum(log_a + np.float32(128), np.float32(0)).view(np.uint32).astype(np.uint64)
    return np.minimum.reduceat(rising << np.uint64(32) | name, first) & np.uint64(0xFFFFFFFF)


def bands(hashes: np.ndarray, row: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have shingles, their band keys as columns)."""
    if not len(row):
        return np.zeros(0, np.int64), np.zeros((0, BANDS), np.uint64)
    starts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    ends = np.append(starts[1:], len(row))
    # whole rows at a time, about _CHUNK shingles
    cuts = [0, *(np.flatnonzero(np.diff(starts // _CHUNK)) + 1), len(starts)]
    out = np.zeros((len(starts), BANDS), dtype=np.uint64)
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = slice(starts[a], ends[b - 1])
        h, w, first = hashes[part], weights[part], starts[a:b] - starts[a]
        weighed = _weighed(w)
        for band in range(BANDS):
            key = np.full(b - a, band + 1, dtype=np.uint64)
            for k in range(band * ROWS, (band + 1) * ROWS):
                key = mixed(key * _STEP + samples(h, w, first, k, weighed))
            out[a:b, band] = key
    return row[starts], out


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sorted shingle sets."""
    place = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = b[place] == a
    common = np.minimum(wa[both], wb[place[both]]).sum()
    return common / (wa.sum() + wb.sum() - common)


def _base(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    node = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NULL)) if "doc_id" in docs.columns else F.lit(_NULL)
    return docs.select(node.alias("node"), text.alias("text"), F.xxhash64(text).alias("tie"))


def _packed(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary cells `values[at[i]:at[i + 1]]` of unsigned numbers, each of as many bytes as the largest needs; none where all are 0."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    data = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width])
    offsets = pa.py_buffer(np.ascontiguousarray(at * width, dtype=np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, offsets, pa.py_buffer(data)]).cast(pa.binary())


def _unpacked(cell: bytes, n: int) -> np.ndarray:
    """The `n` numbers of a packed cell."""
    if not cell:
        return np.zeros(n, np.uint64)
    width = len(cell) // n
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(cell, np.uint8).reshape(n, width)
    return out.view("<u8").ravel()


_CELLS = "slice bigint, part bigint, n int, a binary, b binary, c binary, d binary"
_CELL_NAMES = ["slice", "part", "n", "a", "b", "c", "d"]
_WHOLE = np.array([0, 1])  # _packed's offsets of one cell are this times its length


def _inverted(base: DataFrame, bits: int) -> DataFrame:
    """Each slice of documents, inverted: a row for each of 2 ** `bits` ranges of hashes, and one that says where they stand.

    Of a range: a its different hashes as steps, b in how many documents of the slice each is, less one.
    The other row, whose part is below 0: a the documents of the hashes in turn, b times less one, c and d
    their node and tie. So a shingle that is everywhere is in a range but once by slice.
    """
    shift = _BITS - bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", SLICE_BYTES):
            hashes, row, times = shingles(batch["text"])
            if not len(hashes):
                continue
            order = np.argsort(hashes)
            hashes = hashes[order]
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            seen, df = hashes[first], np.diff(np.append(first, len(hashes)))
            ranges = (seen >> np.uint64(shift)).astype(np.int64)
            at = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]]))
            steps = np.diff(seen, prepend=seen[:1])
            steps[at] = seen[at] & np.uint64((1 << shift) - 1)
            part, at = ranges[at], np.append(at, len(seen))
            none = pa.nulls(len(part), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), number)), pa.array(part), pa.array(np.diff(at).astype(np.int32)), _packed(steps, at), _packed(df - 1, at), none, none],
                _CELL_NAMES)
            ends = _WHOLE * len(hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([-1 - number]), pa.array([len(seen)], pa.int32()), _packed(row[order], ends), _packed(times[order] - 1, ends),
                 pa.array([batch["node"].to_numpy().tobytes()], pa.binary()), pa.array([batch["tie"].to_numpy().tobytes()], pa.binary())], _CELL_NAMES)
            number += 1

    return base.select("node", "tie", "text").mapInArrow(run, _CELLS)


def _hashes(part: int, cell: bytes, n: int, shift: int) -> np.ndarray:
    return np.cumsum(_unpacked(cell, n), dtype=np.uint64) + np.uint64(part << shift)


def _counted(inverted: DataFrame, bits: int, n: int) -> DataFrame:
    """The same rows with c of a range the document counts of its hashes, less one, over all slices; and rows of a
    slice below 0 with the common hashes (a) and their counts (b)."""
    shift = _BITS - bits

    def run(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        if part < 0:
            return table
        sizes, a, b = table["n"].to_numpy(), table["a"].to_pylist(), table["b"].to_pylist()
        hashes, place = np.unique(np.concatenate([_hashes(part, x, k, shift) for x, k in zip(a, sizes)]), return_inverse=True)
        # exact below 2 ** 53 documents
        df = np.bincount(place, np.concatenate([_unpacked(x, k) for x, k in zip(b, sizes)]) + np.uint64(1), len(hashes)).astype(np.uint64)
        at = np.append(0, np.cumsum(sizes, dtype=np.int64))
        counts = df[place] - np.uint64(1)
        out = table.set_column(5, "c", pa.concat_arrays([_packed(counts[i:j], _WHOLE * (j - i)) for i, j in zip(at[:-1], at[1:])]))
        common = df > (n + PRIOR) * COMMON
        if not common.any():
            return out
        row = [[-1 - part], [part], [int(common.sum())], [hashes[common].tobytes()], [df[common].tobytes()], [None], [None]]
        return pa.concat_tables([out, pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(row, out.schema)], schema=out.schema)])

    return inverted.groupBy("part").applyInArrow(run, _CELLS)


def _weighed_documents(counted: DataFrame, bits: int, n: int) -> DataFrame:
    """(node, tie, keys, dfs) of every document with words; rows without a node have common hashes (dfs) and their counts (counts)."""
    shift = _BITS - bits
    schema = pa.schema([("node", pa.int64()), ("tie", pa.int64()), ("keys", pa.list_(pa.int64())), ("dfs", pa.binary()), ("counts", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        if table["slice"][0].as_py() < 0:
            none = [pa.nulls(len(table), f.type) for f in list(schema)[:3]]
            return pa.Table.from_arrays([*none, table["a"].combine_chunks(), table["b"].combine_chunks()], schema=schema)
        rows = sorted(table.to_pylist(), key=lambda x: x["part"])
        where, ranges = rows[0], rows[1:]
        if where["part"] >= 0 or sum(x["n"] for x in ranges) != where["n"]:
            raise RuntimeError("a slice of documents changed while its shingles were counted")
        times = np.concatenate([_unpacked(x["b"], x["n"]) for x in ranges]).astype(np.int64) + 1
        hashes = np.repeat(np.concatenate([_hashes(x["part"], x["a"], x["n"], shift) for x in ranges]), times)
        df = np.repeat(np.concatenate([_unpacked(x["c"], x["n"]) for x in ranges]) + np.uint64(1), times)
        row = _unpacked(where["a"], len(hashes))
        order = np.argsort(row.astype(np.uint16) if int(row.max()) < 1 << 16 else row, kind="stable")
        hashes, df, row = hashes[order], df[order], row[order].astype(np.int64)
        docs, keys = bands(hashes, row, weigh(_unpacked(where["b"], len(hashes))[order] + 1.0, df, n))
        at = np.append(np.flatnonzero(np.diff(row, prepend=-1)), len(row))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(docs) + 1) * BANDS, pa.int32()), pa.array(keys.ravel().view(np.int64)))
        node, tie = (np.frombuffer(where[c], np.int64)[docs] for c in "cd")
        return pa.Table.from_arrays([pa.array(node), pa.array(tie), lists, _packed(df - np.uint64(1), at), pa.nulls(len(docs), pa.binary())], schema=schema)

    return counted.groupBy("slice").applyInArrow(run, "node bigint, tie bigint, keys array<bigint>, dfs binary, counts binary")


def weights_of(docs: DataFrame) -> Weights:
    """Counts of all shingles over all documents, and what is weighed by them: two shuffles of five bytes for
    each shingle of a slice and two for each of a document; counts are exact and none leaves its range or document."""
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    bits = min(max(int(size) // PART_BYTES, 1 << 8).bit_length(), 16)
    found = written(_weighed_documents(_counted(_inverted(_base(docs), bits), bits, n), bits, n), "weighed")
    # at most 4 / COMMON times the shingles of a mean document
    common = found.where("node IS NULL").select("dfs", "counts").collect()
    hashes, df = (np.frombuffer(b"".join(bytes(r[c]) for r in common), np.uint64) for c in ("dfs", "counts"))
    return Weights(hashes, df, n, found.where("node IS NOT NULL").drop("counts"))


def band_keys(documents: DataFrame) -> DataFrame:
    """(key, node, tie) for every band of every text with words."""
    return documents.select(F.explode("keys").alias("key"), "node", "tie")


def shingle_sets(texts: DataFrame, weights: Weights) -> DataFrame:
    """(node, tie, shingles, weights) with the two as arrays of 64-bit and 32-bit cells; weights that are all one are left out."""
    n = weights.n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            hashes, row, times = shingles(batch["text"])
            cut = np.searchsorted(row, np.arange(1, batch.num_rows))
            sizes = np.diff(cut, prepend=0, append=len(row))
            df = np.concatenate([_unpacked(x, k) for x, k in zip(batch["dfs"].to_pylist(), sizes)]) + np.uint64(1)
            weight = weigh(times, df, n).astype("<f4")
            sets = [x.tobytes() for x in np.split(hashes, cut)]
            own = [b"" if (x == 1).all() else x.tobytes() for x in np.split(weight, cut)]
            yield pa.RecordBatch.from_arrays([batch["node"], batch["tie"], pa.array(sets, pa.binary()), pa.array(own, pa.binary())],
                                             ["node", "tie", "shingles", "weights"])

    return texts.select("node", "tie", "text", "dfs").mapInArrow(run, "node bigint, tie bigint, shingles binary, weights binary")


def _sets(group: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for cell, own in zip(group["shingles"], group["weights"]):
        hashes = np.frombuffer(cell, np.uint64)
        out.append((hashes, np.frombuffer(own, "<f4").astype(float) if own else np.ones(len(hashes))))
    return out


_EDGE = "a bigint, a_tie bigint, b bigint, b_tie bigint"


def _document(node: str, tie: str) -> Column:
    return F.struct(F.col(node).alias("node"), F.col(tie).alias("tie"))


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(_document("a", "a_tie").alias("a"), _document("b", "b_tie").alias("b"))


def _star(buckets: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Edges of texts to the smallest one of a bucket of theirs."""
    pairs = buckets.where("node <> lead.node OR tie <> lead.tie").select("lead", "node", "tie").distinct()
    counts = pairs.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).alias("salts"))
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1))
    members = (pairs.join(counts, "lead").withColumn("salt", F.pmod(F.xxhash64("node", "tie"), F.col("salts")))
               .select("lead", "salt", "node", "tie", F.lit(False).alias("leads")))
    leads = counts.withColumn("salt", salts).select("lead", "salt", "lead.node", "lead.tie", F.lit(True).alias("leads"))
    rows = members.unionByName(leads).join(sets, ["node", "tie"])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        own = _sets(group)
        leads = np.flatnonzero(group["leads"].to_numpy())
        if not len(leads):
            return pd.DataFrame({c: [] for c in ("a", "a_tie", "b", "b_tie")}, dtype=np.int64)
        lead, node, tie = leads[0], group["node"].to_numpy(), group["tie"].to_numpy()
        hit = [i for i in range(len(own)) if i != lead and similarity(*own[i], *own[lead]) >= least]
        return pd.DataFrame({"a": node[hit], "a_tie": tie[hit], "b": node[lead], "b_tie": tie[lead]})

    return _ends(rows.groupBy("lead", "salt").applyInPandas(run, _EDGE))


def _rest(open_buckets: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Edges between the classes of a bucket: what is outside its largest class against all of it, in blocks."""
    sizes = open_buckets.groupBy("key", "class").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("key").agg(F.max_by("class", F.struct("n", "class")).alias("largest"), F.sum("n").alias("n"), F.max("n").alias("most"))
    plan = largest.select("key", "largest", F.ceil(F.col("n") / BLOCK).alias("all_blocks"), F.ceil((F.col("n") - F.col("most")) / BLOCK).alias("out_blocks"))
    rows = open_buckets.join(plan, "key").withColumn("hash", F.xxhash64("node", "tie"))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    every = (rows.withColumn("first", F.pmod("hash", F.col("all_blocks"))).withColumn("second", upto("out_blocks")).withColumn("outside", F.lit(False)))
    outside = (rows.where(F.col("class") != F.col("largest")).withColumn("second", F.pmod("hash", F.col("out_blocks")))
               .withColumn("first", upto("all_blocks")).withColumn("outside", F.lit(True)))
    dealt = every.unionByName(outside).select("key", "first", "second", "outside", F.concat_ws("/", "class.node", "class.tie").alias("class"), "node", "tie").join(sets, ["node", "tie"])

    def run(group: pd.DataFrame) -> pd.DataFrame:
        own, node, tie, out = _sets(group), group["node"].to_numpy(), group["tie"].to_numpy(), group["outside"].to_numpy()
        total = np.array([w.sum() for _, w in own])
        _, root = np.unique(group["class"].to_numpy(), return_inverse=True)
        edges = []
        for i in np.flatnonzero(out):
            for j in np.flatnonzero(~out):
                # sets of very different weight can't be similar
                if root[i] != root[j] and min(total[i], total[j]) >= least * max(total[i], total[j]) * (1 - 1e-9) and similarity(*own[i], *own[j]) >= least:
                    edges.append((node[i], tie[i], node[j], tie[j]))
                    root[root == root[i]] = root[j]
        return pd.DataFrame(np.array(edges, dtype=np.int64).reshape(-1, 4), columns=["a", "a_tie", "b", "b_tie"])

    return _ends(dealt.groupBy("key", "first", "second").applyInPandas(run, _EDGE))


def near_classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(node, tie, sha, n_rows, own, class) for every doc_id and text: own is its (node, tie), class the smallest one of its class."""
    base = _base(docs)
    weights = weights_of(docs)
    texts = written(base.select("node", "tie", F.sha2("text", 256).alias("sha")).groupBy("node", "tie", "sha").agg(F.count("*").alias("n_rows")), "texts")
    firsts = texts.groupBy("sha").agg(F.min(F.struct("node", "tie")).alias("first"), F.count("*").alias("n"))
    copies = written(texts.join(firsts.where("n > 1"), "sha").select("node", "tie", "first"), "copies")
    not_first = copies.where("node <> first.node OR tie <> first.tie").select("node", "tie")
    keys = written(band_keys(weights.documents.select("node", "tie", "keys").join(not_first, ["node", "tie"], "left_anti")).distinct(), "keys")
    buckets = keys.groupBy("key").agg(F.min(F.struct("node", "tie")).alias("lead"), F.count("*").alias("n")).where("n > 1")
    crowded = written(keys.join(buckets.select("key", "lead"), "key"), "buckets")
    # the asked grow with the table, so they are never sent whole, on small tables neither
    asked = written(crowded.select("node", "tie").distinct(), "asked").hint("merge")
    dfs = weights.documents.select("node", "tie", "dfs").join(asked, ["node", "tie"]).dropDuplicates(["node", "tie"])
    sets = written(shingle_sets(base.join(asked, ["node", "tie"]).dropDuplicates(["node", "tie"]).join(dfs.hint("merge"), ["node", "tie"]), weights), "sets")
    same = copies.select(_document("node", "tie").alias("a"), F.col("first").alias("b"))
    edges = written(same.unionByName(_star(crowded, sets, least)), "links")
    classes = components(edges)
    known = lambda c: (crowded.withColumn("own", _document("node", "tie"))
                       .join(c.select(F.col("node").alias("own"), F.col("root").alias("class")), "own", "left").withColumn("class", F.coalesce("class", "own")))
    seen = known(classes)
    split = seen.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high").select("key")
    more = written(_rest(seen.join(split, "key").select("key", "class", "node", "tie"), sets, least), "more-links")
    if not more.isEmpty():
        classes = components(edges.unionByName(more))
    return (texts.withColumn("own", _document("node", "tie")).join(classes.withColumnRenamed("node", "own"), "own", "left")
            .select("node", "tie", "sha", "n_rows", "own", F.coalesce("root", "own").alias("class")))


def _id(node: Column) -> Column:
    return F.when(node > _NULL, node)


def near_dedup(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id and kept (one row of every class)."""
    found = near_classes(docs, least)
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows")))
    first = found.where("own = class").groupBy("own").agg(F.min("sha").alias("keep_sha")).alias("f")
    rows = found.withColumn("copy", copy).alias("r").join(first, F.col("r.own") == F.col("f.own"), "left")
    kept = F.coalesce((F.col("copy") == 1) & (F.col("r.sha") == F.col("f.keep_sha")), F.lit(False))
    return rows.select(_id(F.col("r.node")).alias("doc_id"), _id(F.col("class.node")).alias("class_id"), kept.alias("kept"))


def keep_one(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    found = near_classes(docs, least)
    gone = written(found.where("own <> class").select("node", "tie").distinct(), "gone").alias("g")
    repeated = written(found.where("own = class").groupBy("node", "tie").agg(F.sum("n_rows").alias("n")).where("n > 1"), "repeated")
    node = F.coalesce(F.col("d.doc_id").cast("bigint"), F.lit(_NULL))
    text = F.xxhash64(F.coalesce(F.col("d.text"), F.lit("")))
    same = (node == F.col("g.node")) & (text == F.col("g.tie"))
    left = docs.alias("d").join(gone, same, "left_anti")
    if repeated.isEmpty():
        return left
    again = repeated.alias("g")
    one = one_of_each(left.alias("d").join(again, same, "left_semi"))
    return left.alias("d").join(again, same, "left_anti").unionByName(one)
