"""Rank correlation from counts of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running, running_sum


def rank_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """rho, n: Spearman's correlation of two columns; ties have their mean rank.

    Rows are counted by (x, y) before any rank is made, so a value that repeats in a third of all
    rows is one row. Ranks of the different values come from their running counts, cut along
    the values; moments are sums weighted by the counts. Rows with a null in either column
    take no part; a column of one value, or no rows, give a null.
    """
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("n"))
    ranked = pairs
    for name in ("x", "y"):
        values = pairs.groupBy(name).agg(F.sum("n").alias("own"))
        upto = running(values, [], [name], {"upto": running_sum("own")})
        # the mean of the ranks upto - own + 1 .. upto
        ranked = ranked.join(upto.select(name, (F.col("upto") - (F.col("own") - 1) / 2).alias(f"rank_{name}")), name)
    # ranks of n rows have the mean (n + 1) / 2, with ties as well
    middle = pairs.agg(((F.sum("n") + 1) / 2).alias("middle")).scalar()
    da, db = F.col("rank_x") - F.col("middle"), F.col("rank_y") - F.col("middle")
    sums = ranked.withColumn("middle", middle).agg(F.sum("n").alias("n"), F.sum(F.col("n") * da * db).alias("ab"), F.sum(F.col("n") * da * da).alias("aa"), F.sum(F.col("n") * db * db).alias("bb"))
    return sums.select(F.try_divide("ab", F.sqrt(F.col("aa") * F.col("bb"))).alias("rho"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
