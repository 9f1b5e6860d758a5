"""Frame operators in the pandas manner, with keys as columns and order always explicit.

None of them brings a whole group to one task: each is a partial aggregate, a join that
adaptive execution can split, or one of the chunked operators of `ordered`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import ordered


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """First `n` rows of each key. The rank limit is applied before the shuffle as well,
    so at most `n` rows per key leave a task."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def duplicated(df: DataFrame, subset: Sequence[str], order: Sequence[str], keep: str | bool = "first",
               name: str = "duplicated") -> DataFrame:
    """Flag rows whose `subset` is also on another row; `keep` is the row left unflagged.

    One aggregate finds the kept row of each key; `order` must be unique.
    """
    at = F.struct(*order)
    kept = {"first": F.min(at), "last": F.max(at), False: F.min(at)}[keep]
    marks = df.groupBy(F.struct(*subset).alias("_key")).agg(kept.alias("_kept"), F.count("*").alias("_n"))
    out = df.withColumn("_key", F.struct(*subset)).join(marks, "_key")
    flag = F.col("_n") > 1 if keep is False else F.col("_kept") != at
    return out.select(*df.columns, flag.alias(name))


def _beside(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each row of `df` with the row of `stats` of its keys; null keys are keys like others."""
    if not keys:
        return df.crossJoin(stats)  # one row without keys
    own = stats.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], *[c for c in stats.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    return df.join(own, same).drop(*[f"_key{i}" for i in range(len(keys))])


def mode(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent values per key, all of a tie: counts by (key, value), then their maximum."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("_n"))
    most = counts.groupBy(*keys).agg(F.max("_n").alias("_most"))
    return _beside(counts, most, keys).where(F.col("_n") == F.col("_most")).select(*keys, column)


def value_counts(df: DataFrame, columns: Sequence[str], normalize: bool = False, dropna: bool = True) -> DataFrame:
    """Rows per value, or shares of all counted rows."""
    rows = df.dropna(subset=list(columns)) if dropna else df
    counts = rows.groupBy(*columns).agg(F.count("*").alias("count"))
    if not normalize:
        return counts
    total = counts.agg(F.sum("count").alias("_total"))  # one row
    return counts.crossJoin(total).select(*columns, (F.col("count") / F.col("_total")).alias("share"))


def factorize(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Add the zero-based place of each value among the sorted distinct ones; -1 for null."""
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    coded = ordered.global_position(values, [column], name)
    out = df.join(coded, column, "left")
    return out.select(*df.columns, F.coalesce(name, F.lit(-1).cast("bigint")).alias(name))


def mean_abs_deviation(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Mean distance from the key's mean: two aggregates, the first one small."""
    means = df.groupBy(*keys).agg(F.avg(column).alias("_mean"))
    return _beside(df, means, keys).groupBy(*keys).agg(F.avg(F.abs(F.col(column) - F.col("_mean"))).alias("mad"))


def is_monotonic(df: DataFrame, column: str, order: Sequence[str], increasing: bool = True) -> DataFrame:
    """One row: whether `column` never falls (or rises) along `order`; a null in it is a break, as in pandas."""
    after = ordered.shifted(df.select(*dict.fromkeys([column, *order])), [], order, {"_before": (column, 1)})
    step = F.col(column) >= F.col("_before") if increasing else F.col(column) <= F.col("_before")
    whole = F.bool_and(F.col(column).isNotNull())
    return after.agg((F.coalesce(F.bool_and(step), F.lit(True)) & F.coalesce(whole, F.lit(True))).alias("monotonic"))


def compare(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells that differ between two tables of the same keys: key, column name, both values as text.

    A key of one table only stops the job, as in pandas; null keys are keys like others.
    """
    columns = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.struct(*columns).alias("_a"))
    b = right.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.struct(*columns).alias("_b"))
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col("_a")[c].cast("string").alias("self"), F.col("_b")[c].cast("string").alias("other"),
            (~F.col("_a")[c].eqNullSafe(F.col("_b")[c])).alias("differs"),
        )
        for c in columns
    ])
    both = a.join(b, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)], "full")
    alone = F.col("_a").isNull() | F.col("_b").isNull()
    guard = F.when(alone, F.raise_error(F.lit("tables differ in their keys")).cast("boolean")).otherwise(F.lit(True))
    rows = both.where(guard).select(*keys, F.inline(F.filter(cells, lambda x: x["differs"])))
    return rows.drop("differs")


def equals(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: whether two tables hold the same rows with the same counts, in any order."""
    counts = left.groupBy(*left.columns).agg(F.count("*").alias("_n")).withColumn("_s", F.lit(1)).unionByName(
        right.groupBy(*right.columns).agg(F.count("*").alias("_n")).withColumn("_s", F.lit(-1))
    )
    rest = counts.groupBy(*left.columns).agg(F.sum(F.col("_n") * F.col("_s")).alias("_rest")).where("_rest <> 0")
    return rest.agg((F.count("*") == 0).alias("equal"))


def align(left: DataFrame, right: DataFrame, keys: Sequence[str], join: str = "outer") -> DataFrame:
    """Both tables on one set of keys, columns suffixed `_left` and `_right`."""
    a = left.select(*keys, *[F.col(c).alias(f"{c}_left") for c in left.columns if c not in keys])
    b = right.select(*keys, *[F.col(c).alias(f"{c}_right") for c in right.columns if c not in keys])
    return a.join(b, list(keys), join)


def reindex(df: DataFrame, labels: DataFrame, keys: Sequence[str], fill_value=None) -> DataFrame:
    """Rows for exactly the given labels; a label without a row gets nulls or `fill_value`."""
    marked = df.withColumn("_there", F.lit(True))
    out = labels.select(*keys).join(marked, list(keys), "left")
    if fill_value is not None:
        rest = [c for c in df.columns if c not in keys]
        out = out.select(*keys, *[F.when(F.col("_there"), F.col(c)).otherwise(fill_value).alias(c) for c in rest])
    return out.select(*df.columns)


def filter_groups(df: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Rows of the groups for which an aggregate condition holds."""
    good = df.groupBy(*keys).agg(condition.alias("_ok")).where("_ok").select(*keys)
    return df.join(good, list(keys), "left_semi")


def transform_groups(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """Group aggregates set beside every row: a partial aggregate and a join, not a window."""
    stats = df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()])
    return _beside(df, stats, keys).select(*df.columns, *aggregates)


def attach_id(df: DataFrame, order: Sequence[str], name: str = "id", kind: str = "sequence") -> DataFrame:
    """Row ids: `distributed` (unique, no shuffle) or `sequence` (0, 1, 2 ... in `order`)."""
    if kind == "distributed":
        return df.withColumn(name, F.monotonically_increasing_id())
    return ordered.global_position(df, order, name)


def histogram(df: DataFrame, column: str, edges: Sequence[float]) -> DataFrame:
    """Rows per bucket `[edge, next)`, the last bucket closed on the right; other values are left out."""
    value, last = F.col(column).cast("double"), len(edges) - 1
    place = F.width_bucket(value, F.lit(float(edges[0])), F.lit(float(edges[-1])), F.lit(last))
    steps = {round(b - a, 12) for a, b in zip(edges, edges[1:])}
    if len(steps) > 1:  # uneven buckets: the number of edges at or below the value
        place = F.size(F.filter(F.array(*[F.lit(float(e)) for e in edges]), lambda e: e <= value))
    bucket = F.least(place, F.lit(last)).cast("int") - 1
    inside = df.where(value.between(float(edges[0]), float(edges[-1])))
    return inside.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))


def zip_frames(a: DataFrame, b: DataFrame, order_a: Sequence[str], order_b: Sequence[str]) -> DataFrame:
    """Rows of two frames side by side by their place in order; refuses different lengths."""
    left = ordered.global_position(a, order_a, "_place").withColumn("_a", F.lit(True))
    right = ordered.global_position(b, order_b, "_place").withColumn("_b", F.lit(True))
    both = left.join(right, "_place", "full")
    alone = F.col("_a").isNull() | F.col("_b").isNull()
    guard = F.when(alone, F.raise_error(F.lit("frames differ in length")).cast("boolean")).otherwise(F.lit(True))
    return both.where(guard).drop("_place", "_a", "_b")


def first_period(df: DataFrame, time: str, span: str, last: bool = False) -> DataFrame:
    """Rows within an interval such as `3 DAYS` of the first time (or the last one)."""
    edge = df.agg((F.max(time) if last else F.min(time)).alias("_edge"))  # one row
    width = F.expr(f"INTERVAL {span}")
    inside = F.col(time) > F.col("_edge") - width if last else F.col(time) < F.col("_edge") + width
    return df.crossJoin(edge).where(inside).drop("_edge")
