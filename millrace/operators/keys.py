"""Set and edit operators on key columns (what an index or a composite index is here)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Keys on just one side: one aggregate over both, not two differences."""
    both = a.withColumn("_s", F.lit(1)).union(b.toDF(*a.columns).withColumn("_s", F.lit(2)))
    sides = both.groupBy(*a.columns).agg(F.min("_s").alias("_lo"), F.max("_s").alias("_hi"))
    return sides.where("_lo = _hi").select(*a.columns)


def is_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: whether no key is there twice."""
    counts = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    return counts.agg(F.coalesce(F.max("_n") <= 1, F.lit(True)).alias("unique"))


def from_product(df: DataFrame, column: str, labels: Sequence, name: str) -> DataFrame:
    """Every distinct `column` value with every given label."""
    return df.select(column).distinct().withColumn(name, F.explode(F.array(*[F.lit(v) for v in labels])))


def swap_levels(df: DataFrame, a: str, b: str) -> DataFrame:
    """Columns in the same order but for `a` and `b`, which change places."""
    swap = {a: b, b: a}
    return df.select(*[swap.get(c, c) for c in df.columns])


def repeat(df: DataFrame, n: int) -> DataFrame:
    return df.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("_i")
