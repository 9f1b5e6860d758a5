"""Matrices as frames: entries `(i, j, v)`, or rows with an array column for dense data."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TWO_PI = 2 * math.pi


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def add(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("i", "j").agg(F.sum("v").alias("v"))


def scale(a: DataFrame, factor: float) -> DataFrame:
    return a.withColumn("v", F.col("v") * factor)


def multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of two entry frames: an equi-join on the inner index, then partial sums."""
    left = a.select("i", F.col("j").alias("k"), F.col("v").alias("x"))
    right = b.select(F.col("i").alias("k"), "j", F.col("v").alias("y"))
    return left.join(right, "k").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("v"))


def gram_of_rows(rows: DataFrame, column: str) -> DataFrame:
    """Entries of X'X for rows held as arrays.

    Each task adds its batches into one small square and emits that once, so the shuffle
    carries a square per task and never the products of a row.
    """

    def squares(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        total = None
        for b in batches:
            if len(b):
                x = np.stack(b["x"].to_numpy()).astype("float64")
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            i, j = np.indices(total.shape)
            yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    parts = rows.select(F.col(column).alias("x")).mapInPandas(squares, "i bigint, j bigint, v double")
    return parts.groupBy("i", "j").agg(F.sum("v").alias("v"))


def column_similarities(gram: DataFrame) -> DataFrame:
    """Cosine of every two columns, from the Gram entries (as many as columns squared)."""
    norms = gram.where("i = j").select(F.col("i").alias("d"), F.sqrt("v").alias("norm"))
    left = norms.select(F.col("d").alias("i"), F.col("norm").alias("ni"))
    right = norms.select(F.col("d").alias("j"), F.col("norm").alias("nj"))
    out = gram.where("i < j").join(left, "i").join(right, "j")
    return out.select("i", "j", (F.col("v") / (F.col("ni") * F.col("nj"))).alias("v"))


def kernel_density(df: DataFrame, column: str, points: list[float], bandwidth: float) -> DataFrame:
    """Mean Gaussian kernel at each given point: one aggregate per point in a single pass."""
    norm = 1 / (bandwidth * TWO_PI ** 0.5)
    sums = [
        F.avg(F.exp(-0.5 * F.pow((F.col(column) - p) / bandwidth, 2))).alias(str(n)) for n, p in enumerate(points)
    ]
    one = df.agg(*sums)
    rows = F.array(*[F.struct(F.lit(float(p)).alias("point"), (F.col(str(n)) * norm).alias("density")) for n, p in enumerate(points)])
    return one.select(F.inline(rows))
