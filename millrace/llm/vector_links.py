"""Near-equal vectors by a pivot-permutation index.

* Equal vectors are one class first, so copies cost nothing more.
* Pivots are vectors of a sample bounded by `SAMPLE` per pivot, no two closer than
  `APART`. There are about as many as the root of the number of classes, up to `MOST`.
* A vector is described by its `NEAREST` pivots in order of cosine, and is filed in the list
  of each. Within a list, vectors meet that share a second pivot of it, so a pair needs two
  shared pivots; it is looked at in the list of its smallest shared pivot only, under the
  second smallest. Pairs are verified by the cosine in double precision.
* Where all of the sample is closer than `APART` to one pivot, that is the only one: all
  classes are in its list, and every pair of them is looked at.
* A list longer than `BLOCK` is cut in blocks, and pairs of blocks go to tasks of their own.
  No pair leaves a task: it returns sums of links and the edges of a spanning forest.

All classes are indexed and searched for. A vector that is null, empty or zero or holds a
null or a component that is not finite links with nothing. A shorter vector counts as filled
up with zeros. Rows that repeat a vec_id are vectors of their own for n_links, and one node
of the component; a null vec_id is the smallest one. An empty table gives no rows; further
columns, labels too, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import components, roots
from millrace.llm.frames import written

LEAST = 0.95
NEAREST = 8
MOST = 4096
SAMPLE = 8
APART = 0.5
BLOCK = 512
_SLICE = 4096
_STRIPE = 512


def _valid(vector: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _tie(vector: str) -> Column:
    """128 bits that tell vectors apart."""
    return F.concat(F.hex(F.xxhash64(vector)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), vector)))


def _matrix(cells: list[bytes], dim: int) -> np.ndarray:
    """Rows as doubles, filled up to `dim`; each scaled by its largest component, so squares stay finite."""
    out = np.zeros((len(cells), dim))
    for i, cell in enumerate(cells):
        own = np.frombuffer(cell)
        out[i, :len(own)] = own
    return out / np.abs(out).max(axis=1, keepdims=True, initial=0) if len(cells) else out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """The first `n` rows of a sample of unit vectors of which no two are closer than APART, or as many as there are."""
    kept = np.zeros((0, sample.shape[1]))
    for row in sample:
        if len(kept) == n:
            break
        if not len(kept) or (kept @ row).max() <= APART:
            kept = np.vstack([kept, row])
    return kept


def described(classes: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Each class once for each of its nearest pivots: pivot, and all of them in order."""
    shared = classes.sparkSession.sparkContext.broadcast(pivots)
    nearest = min(NEAREST, len(pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                unit = _unit(_matrix(part["vector"].to_pylist(), pivots.shape[1]))
                order = np.argsort(-(unit @ shared.value.T), axis=1, kind="stable")[:, :nearest].astype(np.int32)
                row = pa.array(np.repeat(np.arange(len(order)), nearest))
                cells = pa.array([x.tobytes() for x in order], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(part[c].take(row) for c in ("rep", "tie", "size", "vector")), cells.take(row), pa.array(order.ravel())],
                    ["rep", "tie", "size", "vector", "nearest", "pivot"])

    return classes.mapInArrow(run, "rep bigint, tie string, size bigint, vector binary, nearest binary, pivot int")


def linked_pairs(pivot: int, x: np.ndarray, nearest: np.ndarray, left: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of a list with a cosine of `least` or more, looked at under their two smallest shared pivots.

    With `left` given as a mask, only pairs across it are wanted.
    """
    unit, found = _unit(x), []
    across = left.any() and not left.all()
    key, row = nearest.ravel(), np.repeat(np.arange(len(x)), nearest.shape[1])
    order = np.argsort(key, kind="stable")
    for mine in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
        if not len(mine) or key[mine[0]] == pivot and nearest.shape[1] > 1:  # all of the list share that one
            continue
        mine = row[mine]
        a, b = (mine[left[mine]], mine[~left[mine]]) if across else (mine, mine)
        for at in range(0, len(a), _STRIPE):
            rows = a[at:at + _STRIPE]
            i, j = np.nonzero(unit[rows] @ unit[b].T >= least - 1e-9)
            i, j = rows[i], b[j]
            keep = i < j if not across else np.ones(len(i), bool)
            found.append(i[keep] * len(x) + j[keep])
    i, j = np.divmod(np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64), max(len(x), 1))
    same = (nearest[i][:, :, None] == nearest[j][:, None, :]).any(axis=2)
    smallest = np.where(same, nearest[i], np.iinfo(np.int32).max).min(axis=1) if len(i) else np.zeros(0)
    cosine = np.einsum("ij,ij->i", x[i], x[j]) / np.sqrt(np.einsum("ij,ij->i", x[i], x[i]) * np.einsum("ij,ij->i", x[j], x[j]))
    keep = (same.sum(axis=1) >= min(2, nearest.shape[1])) & (smallest == pivot) & (cosine >= least)
    return i[keep], j[keep]


def links(lists: DataFrame, dim: int, least: float, block: int = BLOCK) -> DataFrame:
    """(rep, tie, n, root_rep, root_tie) for the members of every block pair that have a link in it."""
    counts = written(lists.groupBy("pivot").agg(F.ceil(F.count("*") / block).alias("blocks")), "lists")
    cut = (lists.join(F.broadcast(counts), "pivot")  # one row per pivot
           .withColumn("own", F.pmod(F.xxhash64("rep", "tie"), F.col("blocks"))))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    dealt = (cut.withColumn("other", other).withColumn("first", F.least("own", "other")).withColumn("second", F.greatest("own", "other"))
             .select("pivot", "first", "second", (F.col("own") == F.col("first")).alias("left"), "rep", "tie", "size", "vector", "nearest"))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(list(group["vector"]), dim)
        nearest = np.stack([np.frombuffer(c, np.int32) for c in group["nearest"]])
        i, j = linked_pairs(int(group["pivot"].iloc[0]), x, nearest, group["left"].to_numpy(), least)
        size = group["size"].to_numpy()
        n = np.bincount(i, size[j], minlength=len(x)) + np.bincount(j, size[i], minlength=len(x))
        order = np.lexsort((group["tie"], group["rep"]))
        place = np.argsort(order)
        root = order[roots(len(x), place[i], place[j])][place]
        out = group[["rep", "tie"]].assign(n=n.astype(np.int64), root_rep=group["rep"].to_numpy()[root], root_tie=group["tie"].to_numpy()[root])
        return out[n > 0]

    return dealt.groupBy("pivot", "first", "second").applyInPandas(run, "rep bigint, tie string, n bigint, root_rep bigint, root_tie string")


def link(vectors: DataFrame, least: float = LEAST, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of `vectors`."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.0).alias("embedding"))
    good = rows.where(_valid("embedding"))
    # a class keeps its smallest id, and a hash of the vector where one id has several
    classes = (good.groupBy("embedding")
               .agg(F.min(F.coalesce("vec_id", F.lit(-2**63))).alias("rep"), F.count("*").alias("size"))
               .withColumn("tie", _tie("embedding")))

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = pa.array([np.array(x).tobytes() for x in batch["embedding"].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("rep", "tie", "size")), cells], ["rep", "tie", "size", "vector"])

    classes = written(classes.mapInArrow(flat, "rep bigint, tie string, size bigint, vector binary"), "classes")
    n, longest = classes.agg(F.count("*"), F.coalesce(F.max(F.octet_length("vector")), F.lit(8))).first()
    wanted = min(MOST, max(32, 1 << math.ceil(math.log2(max(math.sqrt(n), 1)))))
    sample = classes.orderBy(F.xxhash64("tie"), "rep").limit(SAMPLE * wanted).select("vector").toPandas()
    dim = longest // 8
    pivots = choose_pivots(_unit(_matrix(list(sample["vector"]), dim)), wanted)
    ids = rows.select("vec_id", F.when(_valid("embedding"), _tie("embedding")).alias("tie"), F.coalesce("vec_id", F.lit(-2**63)).alias("node"))
    if not len(pivots):
        return _alone(ids, classes)
    found = written(links(described(classes, pivots), dim, least, block), "links")
    edges = found.select(F.col("rep").alias("a"), F.col("root_rep").alias("b"))
    members = ids.where("tie IS NOT NULL")
    firsts = members.groupBy("tie").agg(F.min("node").alias("b"))
    # rows of one vector hang together, as do the vectors of one id
    copies = members.join(firsts, "tie").select(F.col("node").alias("a"), "b").where("a <> b").distinct()
    component = components(edges.unionByName(copies)).alias("c")
    more = found.groupBy("tie", "rep").agg(F.sum("n").alias("n"))
    size = classes.select("tie", "rep", "size").join(more, ["tie", "rep"], "left").select(
        "tie", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links")).alias("s")
    root = F.coalesce("c.root", "i.node")
    smallest = F.when(root > -2**63, root)
    return (ids.alias("i").join(size, F.col("i.tie") == F.col("s.tie"), "left")
            .join(component, F.col("i.node") == F.col("c.node"), "left")
            .select("i.vec_id", F.coalesce("s.n_links", F.lit(0)).cast("bigint").alias("n_links"), smallest.alias("component_id"),
                    F.col("i.vec_id").eqNullSafe(smallest).alias("kept")))


def _alone(ids: DataFrame, classes: DataFrame) -> DataFrame:
    """No vector that counts: nothing links."""
    c = classes.alias("c")
    smallest = F.coalesce("c.rep", "i.node")
    smallest = F.when(smallest > -2**63, smallest)
    return (ids.alias("i").join(c, F.col("i.tie") == F.col("c.tie"), "left")
            .select("i.vec_id", F.coalesce(F.col("c.size") - 1, F.lit(0)).cast("bigint").alias("n_links"), smallest.alias("component_id"),
                    F.col("i.vec_id").eqNullSafe(smallest).alias("kept")))
