"""Hard negatives from an inverted multi-index.

* A vector's two halves each have a codebook of about the fourth root of the number of rows,
  fitted on at most `SAMPLE` halves; a row is filed in the cell of its two nearest codes. For
  each code the radius is the largest distance of any row's half to it, over all rows.
* An anchor's score with any row of a cell is at most the sum over both halves of
  `anchor . code + |anchor| * radius`, and at least the same with a minus. A heap of pairs of
  codes, ordered by the sum, gives cells from the highest bound down without listing them all.
* Cells are dealt in shards of about `SHARD` rows. Blocks of anchors meet shards, and each
  anchor stops in a shard once its window is certified: as many rows found as wanted, the
  last of them above the bound of the next cell; or no cell left that can reach the window.
  An anchor is not sent to a shard whose bounds miss its windows.
* First each anchor finds its nearest rows of the same label, then, for the window of scores
  that each of these positives sets, the highest rows of other labels. Results are exact.

A task returns a bounded number of rows per anchor and window. Hot cells: rows of one cell
are dealt over as many shards as they fill.

Scores are inner products of whole numbers, `floor(SCALE * x)` as double. Rows with a null
label, a null vector or a null or non-finite component take no part. A shorter vector counts
as filled up with zeros. Components beyond 2^62 are cut there and scores beyond 64 bits at
their ends. Equal scores go by vec_id, a null one first; rows that repeat a vec_id are rows of
their own, in no given order. An empty table, or one without anchors, gives no
rows; further columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import mixed, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90      # percent of the positive's score
EVERY = 100             # anchors
SAMPLE = 8192           # rows, of which the codes are fitted
MOST_CODES = 256        # per half, so there are at most 65,536 cells
ROUNDS = 8              # of k-means
SHARD = 8192
ANCHORS = 1024
_SLICE = 2048
_EXACT = float(1 << 53)
_ENDS = (1 - (1 << 63), (1 << 63) - 1)
_NULL = -2**63


def parse(vectors: DataFrame) -> DataFrame:
    """(id, vec_id, label, vector): the rows that take part; `id` orders rows of equal score."""
    cells = F.col("embedding").cast("array<double>")
    good = F.coalesce(~F.exists(cells, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))
    rows = vectors.where(F.col("label").isNotNull()).where(good).select("vec_id", "label", cells.alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with np.errstate(over="ignore"):
                whole = [np.clip(np.floor(np.array(x, dtype=np.float64) * SCALE), -2.0**62, 2.0**62).astype("<i8").tobytes() for x in batch["embedding"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], pa.array(whole, pa.binary())], ["vec_id", "label", "vector"])

    return rows.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), "embedding").mapInArrow(run, "vec_id bigint, label bigint, vector binary")


def _matrix(cells: list[bytes], dim: int) -> np.ndarray:
    out = np.zeros((len(cells), dim), dtype=np.int64)
    for i, cell in enumerate(cells):
        own = np.frombuffer(cell, "<i8")
        out[i, :len(own)] = own
    return out


def exact(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both in a type in which their inner products are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    kind = np.float64 if most < _EXACT else object
    return a.astype(kind), b.astype(kind)


def scores(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Inner products of rows with a vector."""
    out = rows @ one
    return (out if out.dtype == np.float64 else np.clip(out, *_ENDS)).astype(np.int64)


def _nearest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), dtype=np.int64)
    for at in range(0, len(x), _SLICE):
        part = x[at:at + _SLICE]
        out[at:at + _SLICE] = (-2 * part @ codes.T + (codes * codes).sum(axis=1)).argmin(axis=1)
    return out


def codebook(x: np.ndarray, n: int, rounds: int = ROUNDS) -> np.ndarray:
    """At most `n` different codes of the rows of `x`, by k-means from the first different rows."""
    _, first = np.unique(x, axis=0, return_index=True)
    codes = x[np.sort(first)[:n]]
    for _ in range(rounds):
        own = _nearest(x, codes)
        size = np.bincount(own, minlength=len(codes))
        sums = np.zeros_like(codes)
        np.add.at(sums, own, x)
        codes = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], codes)
    return codes


class Codes:
    """Two codebooks, the radius of every code, and the cells that hold rows."""

    def __init__(self, books: tuple[np.ndarray, np.ndarray]):
        self.books = books
        self.half = books[0].shape[1]
        self.radius = [np.zeros(len(b)) for b in books]

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = x.astype(np.float64)
        return x[:, :self.half], x[:, self.half:]

    def file(self, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """(code, distance to it) of each half of each row."""
        own = [_nearest(h, b) for h, b in zip(self.halves(x), self.books)]
        far = [np.sqrt(((h - b[c]) ** 2).sum(axis=1)) for h, b, c in zip(self.halves(x), self.books, own)]
        return own, far

    def bounds(self, x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(most, least) of each half's score of each row with each code; a little wide, for rounding."""
        out = []
        for h, b, r in zip(self.halves(x), self.books, self.radius):
            size = np.sqrt((h * h).sum(axis=1))[:, None]
            reach = size * r * (1 + 1e-9) + size * np.sqrt((b * b).sum(axis=1)) * 1e-9 + 1e-3
            middle = h @ b.T
            out.append((middle + reach, middle - reach))
        return out


def visits(first: np.ndarray, second: np.ndarray, held: dict[tuple[int, int], int]) -> Iterator[tuple[float, int]]:
    """(bound, cell) of the cells of `held`, by (code, code), from the highest sum of half bounds down: the multi-sequence heap."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    left, heap = len(held), [(-(first[a[0]] + second[b[0]]), 0, 0)] if held else []
    seen = {(0, 0)}
    while heap and left:
        bound, i, j = heapq.heappop(heap)
        cell = held.get((int(a[i]), int(b[j])))
        if cell is not None:
            left -= 1
            yield -bound, cell
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(a) and y < len(b) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (-(first[a[x]] + second[b[y]]), x, y))


class Shard:
    """The rows of a task, by cell; rows of a cell by id."""

    def __init__(self, codes: Codes, x: np.ndarray, order: np.ndarray, label: np.ndarray, cell: np.ndarray):
        by = np.lexsort((order, cell))
        self.x, self.order, self.label, cell = x[by], order[by], label[by], cell[by]
        self.codes, self.rows = codes, by
        starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]])) if len(cell) else np.zeros(0, int)
        self.slots = list(zip(starts, np.append(starts[1:], len(cell))))
        pairs = [divmod(int(cell[s]), MOST_CODES) for s in starts]
        # only the codes that occur here are in the heap
        self.used = [np.unique([p[k] for p in pairs]).astype(int) for k in (0, 1)]
        place = [{c: i for i, c in enumerate(u)} for u in self.used]
        self.held = {(place[0][p], place[1][q]): k for k, (p, q) in enumerate(pairs)}
        self.pairs = pairs

    def top(self, anchors: np.ndarray, wanted: Callable[[int, np.ndarray, np.ndarray], list[tuple[np.ndarray, int, int, int]]]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For anchor i and each window (rows allowed, low, high, n) that `wanted(i, label, order)` gives for the shard's
        rows: (i, window, places, scores) of its first n rows, by score and then by order."""
        if not len(self.x) or not len(anchors):
            return
        (most1, least1), (most2, least2) = self.codes.bounds(anchors)
        anchors, rows = exact(anchors, self.x)
        for i in range(len(anchors)):
            windows = {w: x for w, x in enumerate(wanted(i, self.label, self.order)) if x[1] <= x[2]}
            if not windows:
                continue
            low, high = min(w[1] for w in windows.values()), max(w[2] for w in windows.values())
            found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            certain: dict[int, int] = {}  # the last score of windows that are full; equal ones may still come, of smaller id
            for bound, cell in visits(most1[i][self.used[0]], most2[i][self.used[1]], self.held):
                bound = max(bound, _ENDS[0])
                if bound < low or len(certain) == len(windows) and bound < min(certain.values()):
                    break
                p, q = self.pairs[cell]
                if min(least1[i][p] + least2[i][q], _ENDS[1]) > high:
                    continue
                a, b = self.slots[cell]
                own = scores(rows[a:b], anchors[i])
                for w, (allowed, least, most, n) in windows.items():
                    got = np.flatnonzero(allowed[a:b] & (own >= max(least, certain.get(w, least))) & (own <= most))
                    if len(got):
                        place, score = np.concatenate([found[w][0], got + a]) if w in found else got + a, np.concatenate([found[w][1], own[got]]) if w in found else own[got]
                        best = np.lexsort((self.order[place], -score))[:n]
                        found[w] = place[best], score[best]
                        if len(best) == n:
                            certain[w] = int(score[best[-1]])
            for w, (place, score) in found.items():
                yield i, w, self.rows[place], score


def fit(rows: DataFrame, dim: int, n: int, sample: int) -> Codes:
    """Codes of a bounded sample, the smallest by hash; radii are over all rows."""
    size = min(MOST_CODES, max(1, round(n ** 0.25)))
    some = _matrix(list(rows.orderBy(F.xxhash64("vector", "id"), "id").limit(sample).select("vector").toPandas()["vector"]), dim).astype(np.float64)
    half = (dim + 1) // 2
    return Codes((codebook(some[:, :half], size), codebook(some[:, half:], size)))


def _plus(rows: DataFrame, **columns: str) -> str:
    """The schema of `rows` with further columns."""
    return ", ".join(f"{c} {kind}" for c, kind in [*rows.dtypes, *columns.items()])


def _filed(rows: DataFrame, codes: Codes, dim: int) -> DataFrame:
    """`rows` with their cell and distances."""
    shared = rows.sparkSession.sparkContext.broadcast(codes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                own, far = shared.value.file(_matrix(part["vector"].to_pylist(), dim))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own[0] * MOST_CODES + own[1]), pa.array(far[0]), pa.array(far[1])],
                                                 [*part.schema.names, "cell", "far1", "far2"])

    return rows.mapInArrow(run, _plus(rows, cell="bigint", far1="double", far2="double"))


def _sharded(filed: DataFrame, shard: int) -> tuple[DataFrame, np.ndarray]:
    """Rows with their shard, and (cell, first shard, shards) of every cell; a large cell's rows are dealt over the shards that they fill."""
    cells = filed.groupBy("cell").agg(F.count("*").alias("n"))  # at most MOST_CODES squared
    upto = F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    plan = written(cells.withColumn("upto", upto).select("cell", F.floor((F.col("upto") - F.col("n")) / shard).alias("first"),
                                                         F.when(F.col("n") < shard, 1).otherwise(F.ceil(F.col("n") / shard)).alias("salts")), "shards")
    dealt = filed.join(F.broadcast(plan), "cell").withColumn("shard", F.col("first") + F.pmod(F.xxhash64("id", F.lit("shard")), "salts"))
    return dealt.drop("first", "salts"), plan.orderBy("cell").toPandas()[["cell", "first", "salts"]].to_numpy(dtype=np.int64).reshape(-1, 3)


def _sent(anchors: DataFrame, codes: Codes, plan: np.ndarray, dim: int, windows: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Each anchor once for every shard that has a cell whose bounds reach its (low, high)."""
    shared = anchors.sparkSession.sparkContext.broadcast((codes, plan))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, plan = shared.value
        cell = np.repeat(np.arange(len(plan)), plan[:, 2])
        shard = plan[cell, 1] + np.arange(len(cell)) - np.repeat(np.cumsum(plan[:, 2]) - plan[:, 2], plan[:, 2])
        cell, shard = cell[np.argsort(shard, kind="stable")], np.sort(shard)
        starts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else np.zeros(0, int)
        p, q = np.divmod(plan[:, 0], MOST_CODES)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                (most1, least1), (most2, least2) = own.bounds(_matrix(part["vector"].to_pylist(), dim))
                low, high = windows(part)
                reach = (most1[:, p] + most2[:, q] >= low[:, None]) & (least1[:, p] + least2[:, q] <= high[:, None])
                row, which = np.nonzero(np.logical_or.reduceat(reach[:, cell], starts, axis=1)) if len(starts) else (np.zeros(0, int), np.zeros(0, int))
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(row)) for c in part.columns), pa.array(shard[starts[which]])], [*part.schema.names, "shard"])

    return anchors.mapInArrow(run, _plus(anchors, shard="bigint"))


def _searched(shards: DataFrame, sent: DataFrame, codes: Codes, dim: int, blocks: int, schema: str, search: Callable) -> DataFrame:
    """`search(shard, table of anchors, table of rows)` for every block of anchors in every shard."""
    shared = shards.sparkSession.sparkContext.broadcast(codes)
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.lit(blocks))
    asked = written(sent.select("shard", block.alias("block"), *[c for c in sent.columns if c != "shard"]), "sent")
    met = asked.select("shard", "block").distinct().toDF("shard", "met").withColumnRenamed("met", "block")
    rows = shards.select("shard", "id", "vec_id", "label", "vector", "cell").join(met, "shard")
    keys = lambda df: df.groupBy("shard", "block")

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        shard = Shard(shared.value, _matrix(rows["vector"].to_pylist(), dim), _order(rows), rows["label"].to_numpy(), rows["cell"].to_numpy())
        return search(shard, anchors, rows)

    return keys(asked).cogroup(keys(rows)).applyInArrow(run, schema)


def _order(rows: pa.Table) -> np.ndarray:
    """Places by vec_id, a null one first, then by id."""
    vec_id = rows["vec_id"].fill_null(_NULL).to_numpy()
    out = np.empty(len(vec_id), dtype=np.int64)
    out[np.lexsort((rows["id"].to_numpy(), vec_id))] = np.arange(len(vec_id))
    return out


def hard_negatives(rows: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   shard: int = SHARD, block: int = ANCHORS, sample: int = SAMPLE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; `rows` as `parse` gives them, `anchors` a condition on them."""
    rows = written(rows.withColumn("id", F.monotonically_increasing_id()), "rows")
    n, dim, n_anchors = rows.agg(F.count("*"), F.coalesce(F.max(F.octet_length("vector")), F.lit(0)), F.count_if(anchors)).first()
    dim = max(dim // 8, 2)
    codes = fit(rows, dim, n, sample)
    filed = written(_filed(rows, codes, dim), "filed")
    for k, far in enumerate(("far1", "far2")):
        code = F.floor(F.col("cell") / MOST_CODES) if k == 0 else F.col("cell") % MOST_CODES
        for c, r in filed.groupBy(code.alias("code")).agg(F.max(far)).collect():  # at most MOST_CODES
            codes.radius[k][c] = r
    dealt, plan = _sharded(filed.drop("far1", "far2"), shard)
    shards = written(dealt, "dealt")
    blocks = max(1, math.ceil(n_anchors / block))
    asks = rows.where(anchors)
    out = "anchor bigint, anchor_id bigint, vector binary, label bigint, id bigint, vec_id bigint, score bigint"

    def same_label(own: Shard, asked: pa.Table, held: pa.Table) -> pa.Table:
        who, label = asked["id"].to_numpy(), asked["label"].to_numpy()
        ids = held["id"].to_numpy()[own.rows]
        x = _matrix(asked["vector"].to_pylist(), dim)
        found = list(own.top(x, lambda i, labels, _: [((labels == label[i]) & (ids != who[i]), *_ENDS, positives)]))
        return _gathered(asked, held, found, ["id", "vec_id", "vector", "label"], ["anchor", "anchor_id", "vector", "label"])

    reach = lambda part: (np.full(part.num_rows, -np.inf), np.full(part.num_rows, np.inf))
    near = _searched(shards, _sent(asks, codes, plan, dim, reach), codes, dim, blocks, out, same_label)
    first = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"), "id"))
    pos = written(near.withColumn("place", first).where(F.col("place") <= positives), "positives")
    # equal scores of an anchor set one window
    ask = written(pos.groupBy("anchor", "anchor_id", "vector", "label").agg(F.sort_array(F.collect_set("score")).alias("wants"))
                  .withColumnsRenamed({"anchor": "id", "anchor_id": "vec_id"}), "windows")

    def window(score: int) -> tuple[int, int]:
        return -(-low * score // 100), high * score // 100

    def widest(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        both = [[window(s) for s in x] for x in part["wants"].to_pylist()]
        both = [[(a, b) for a, b in x if a <= b] or [(math.inf, -math.inf)] for x in both]
        return np.array([min(a for a, _ in x) for x in both], dtype=np.float64), np.array([max(b for _, b in x) for x in both], dtype=np.float64)

    def other_label(own: Shard, asked: pa.Table, held: pa.Table) -> pa.Table:
        label, wants = asked["label"].to_numpy(), asked["wants"].to_pylist()
        x = _matrix(asked["vector"].to_pylist(), dim)
        found = list(own.top(x, lambda i, labels, _: [(labels != label[i], *window(s), negatives) for s in wants[i]]))
        table = _gathered(asked, held, found, ["id"], ["anchor"])
        set_by = pa.array([wants[i][w] for i, w, places, _ in found for _ in places], pa.int64())
        return table.append_column("positive_score", set_by).select(["anchor", "positive_score", "id", "vec_id", "score"])

    met = _searched(shards, _sent(ask, codes, plan, dim, widest), codes, dim, blocks,
                    "anchor bigint, positive_score bigint, id bigint, vec_id bigint, score bigint", other_label)
    rank = F.row_number().over(Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"), "id"))
    mined = met.withColumn("rank", rank).where(F.col("rank") <= negatives).alias("n")
    p = pos.alias("p")
    return (p.join(mined, (F.col("p.anchor") == F.col("n.anchor")) & (F.col("p.score") == F.col("n.positive_score")))
            .select("p.anchor_id", F.col("p.vec_id").alias("positive_id"), "n.rank", F.col("n.vec_id").alias("negative_id"),
                    F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score")))


def mined(vectors: DataFrame, every: int = EVERY, **options) -> DataFrame:
    """Hard negatives of every `every`-th vec_id; labels of each seventh one are moved by one first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(parse(vectors.select("vec_id", moved.alias("label"), "embedding")), F.col("vec_id") % every == 0, **options)


SQL = """
    WITH p AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
      FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
      FROM p a JOIN p b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    pos AS (
      SELECT * FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
    neg AS (
      SELECT pos.anchor_id, pos.vec_id AS positive_id, s.vec_id AS negative_id, pos.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY pos.anchor_id, pos.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM pos JOIN s ON pos.anchor_id = s.anchor_id AND s.label <> s.own AND 30 * pos.score <= 100 * s.score AND 100 * s.score <= 90 * pos.score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10"""


def _gathered(asked: pa.Table, held: pa.Table, found: list, take: list[str], names: list[str]) -> pa.Table:
    """Rows found, with columns of their anchor under other names."""
    who = pa.array([i for i, _, places, _ in found for _ in places], pa.int64())
    places = pa.array(np.concatenate([p for _, _, p, _ in found]) if found else np.zeros(0, np.int64))
    own = [asked[c].combine_chunks().take(who) if len(who) else pa.array([], asked.schema.field(c).type) for c in take]
    score = pa.array(np.concatenate([s for _, _, _, s in found]) if found else np.zeros(0, np.int64))
    rest = [held[c].combine_chunks().take(places) if len(places) else pa.array([], held.schema.field(c).type) for c in ("id", "vec_id")]
    return pa.Table.from_arrays([*own, *rest, score], names=[*names, "id", "vec_id", "score"])
