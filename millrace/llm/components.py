"""Connected components of an edge table, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b): the smallest node of its component.

    Every node goes to its smallest neighbour, and on along these parents until all have come
    to a node that has no smaller neighbour; the way halves with each step, however long the
    chain. Edges between equal ends fall away and the rest is done again. At most half of the
    nodes have no smaller neighbour, so both loops are short. A node's neighbours meet in a
    partial aggregate only; the joins have one row per node on one side.
    """
    edges = written(edges.select("a", "b").where("a <> b").distinct(), "edges")
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = written(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "parents")
        step = _to_roots(step)
        steps.append(step)
        ends = [step.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b")]
        edges = written(edges.join(ends[0], "a").join(ends[1], "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
                        .where("a <> b").distinct(), "edges")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps.pop()
    while steps:
        later = out.select(F.col("node").alias("root"), F.col("root").alias("last"))
        out = written(steps.pop().join(later, "root", "left").select("node", F.coalesce("last", "root").alias("root")), "roots")
    return out


def _to_roots(parents: DataFrame) -> DataFrame:
    """(node, root) from (node, root: its parent): every step doubles the way that is gone."""
    while True:
        later = parents.select(F.col("node").alias("root"), F.col("root").alias("last"))
        jumped = written(parents.join(later, "root").select("node", F.col("last").alias("root"), (F.col("last") < F.col("root")).alias("moved")), "parents")
        if jumped.where("moved").isEmpty():
            return jumped.drop("moved")
        parents = jumped.drop("moved")


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index of each index' component in a graph of `n` nodes, within one task."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new
