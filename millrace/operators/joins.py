"""Joins Spark has no direct plan for: as-of, interval, and keyed updates of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import last_value, running

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark `df` for broadcast when it has at most `max_rows` rows and, written as text, `max_bytes`; else let the planner choose."""
    width = F.lit(0).cast("bigint")
    for c in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
    n, size = df.limit(max_rows + 1).agg(F.count("*"), F.sum(width)).first()
    return F.broadcast(df) if n <= max_rows and (size or 0) <= max_bytes else df


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str] = (),
    *,
    right_on: str | None = None,
    direction: str = "backward",
    tolerance: Column | None = None,
    exact: bool = True,
    how: str = "left",
    pieces: int | None = None,
) -> DataFrame:
    """For each left row, the right row of the same `by` that is nearest along `on`.

    Both sides are put in one frame and the last right row seen is carried along the
    order: no pair is ever made, and a hot `by` value is cut in chunks along `on`.
    `tolerance` bounds the distance `left - right` (same type as that difference).
    A right column named as a left one gets the suffix `_right`. On a distance tie,
    `nearest` takes the earlier row; among right rows equal on `on`, a hash of the row
    decides, so the same one is taken on every run and a crowded time can be cut too.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError(f"direction {direction!r}")
    right_on = right_on or on
    taken = [c for c in right.columns if c not in by]
    names = {c: f"{c}_right" if c in left.columns else c for c in taken}
    packed = F.struct(*[F.col(c).alias(names[c]) for c in taken])

    rights = right.where(F.col(right_on).isNotNull()).select(
        *by, F.col(right_on).alias("_on"), packed.alias("_match"), F.lit(None).cast(left.schema).alias("_row")
    )
    lefts = left.select(
        *by, F.col(on).alias("_on"), F.lit(None).cast(rights.schema["_match"].dataType).alias("_match"),
        F.struct(*left.columns).alias("_row"),
    )
    both = lefts.unionByName(rights).withColumn("_left", F.col("_row").isNotNull())

    def side(left_first: bool) -> Column:
        first = F.col("_left") if left_first else ~F.col("_left")
        spread = F.pmod(F.xxhash64("_row", "_match"), F.lit(1 << 32))
        return F.when(first, spread).otherwise(spread + F.lit(1 << 33))

    order = ["_on", "_tie", "_match"]

    def carry(df: DataFrame, left_first: bool, values: dict, onward: dict) -> DataFrame:
        tied = df.withColumn("_tie", side(left_first))
        return running(tied, list(by), order, values, onward=onward, pieces=pieces).drop("_tie")

    back = {"_back": last_value("_match", order)} if direction != "forward" else {}
    following = {"_next": last_value("_match", order, descending=True)} if direction != "backward" else {}
    if direction == "nearest" and exact:
        # right rows of the same time come before and are nearest, so only later ones are wanted from the other side
        out = carry(both, False, back, following)
    else:
        # right rows come before left rows of the same time when exact matches count; the other way round from the end
        out = carry(both, not exact, back, {}) if back else both
        out = carry(out, exact, {}, following) if following else out
    out = out.where("_left")

    if direction == "nearest":
        back_gap = F.col("_row")[on] - F.col("_back")[names[right_on]]
        next_gap = F.col("_next")[names[right_on]] - F.col("_row")[on]
        best = F.when(
            F.col("_back").isNull() | (F.col("_next").isNotNull() & (next_gap < back_gap)), F.col("_next")
        ).otherwise(F.col("_back"))
    else:
        best = F.col("_back" if direction == "backward" else "_next")
    # a left row without a time is nearest to nothing, wherever the order puts it
    out = out.select("_row", F.when(F.col("_row")[on].isNotNull(), best).alias("_match"))
    if tolerance is not None:
        gap = F.col("_row")[on] - F.col("_match")[names[right_on]]
        back = F.col("_match")[names[right_on]] <= F.col("_row")[on]
        gap = F.when(back, gap).otherwise(F.col("_match")[names[right_on]] - F.col("_row")[on])
        out = out.withColumn("_match", F.when(gap <= tolerance, F.col("_match")))
    if how == "inner":
        out = out.where(F.col("_match").isNotNull())
    return out.select("_row.*", *[F.col("_match")[n].alias(n) for n in names.values()])


def interval_join(
    points: DataFrame, intervals: DataFrame, point: str, start: str, end: str, by: Sequence[str] = ()
) -> DataFrame:
    """Rows of `points` paired with the intervals `[start, end)` that hold them.

    `point`, `start` and `end` are whole numbers (use `unix_micros` or `unix_seconds` for
    times). An interval is filed under the power of two next above its length, so it
    touches at most two cells of that size; a point is looked up once per size in use.
    The pairing is an equi-join on (keys, size, cell): a long interval does not blow up
    and a hot cell is split by adaptive execution like any skewed join key.
    """

    def cell(value: Column) -> Column:
        # an arithmetic shift is floor division, also below zero
        return F.call_function("shiftright", value.cast("bigint"), F.col("_level"))

    length = (F.col(end) - F.col(start)).cast("double")
    filed = intervals.where(F.col(end) > F.col(start)).withColumn("_level", F.ceil(F.log2(length)).cast("int"))
    # at most 64 sizes exist for 64-bit lengths
    levels = sorted(r[0] for r in filed.select("_level").distinct().collect()) or [0]
    cells = filed.withColumn("_cell", F.explode(F.sequence(cell(F.col(start)), cell(F.col(end) - 1))))
    looked = points.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels])))
    looked = looked.withColumn("_cell", cell(F.col(point)))
    inside = (F.col(point) >= F.col(start)) & (F.col(point) < F.col(end))
    return looked.join(cells, [*by, "_level", "_cell"]).where(inside).drop("_level", "_cell")


def update(left: DataFrame, right: DataFrame, keys: Sequence[str], *, keep_left: bool = False) -> DataFrame:
    """Left rows with their columns replaced by the right's non-null values of the same key.

    With `keep_left`, a left value wins and the right only fills its nulls.
    """
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    other = right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in shared])
    joined = left.join(other, list(keys), "left")

    def pick(c: str) -> Column:
        pair = (F.col(c), F.col(f"_r_{c}"))
        return F.coalesce(*(pair if keep_left else pair[::-1])).alias(c)

    return joined.select(*[pick(c) if c in shared else F.col(c) for c in left.columns])


def combine_first(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys of both sides; the left's value where it has one, else the right's."""
    columns = [*left.columns, *[c for c in right.columns if c not in left.columns]]
    a = left.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in left.columns if c not in keys])
    b = right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in right.columns if c not in keys])
    joined = a.join(b, list(keys), "full")
    out = []
    for c in columns:
        if c in keys:
            out.append(F.col(c))
            continue
        parts = [F.col(p) for p in (f"_l_{c}", f"_r_{c}") if p in joined.columns]
        out.append(F.coalesce(*parts).alias(c))
    return joined.select(*out)
