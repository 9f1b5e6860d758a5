"""Event-time operators: windows, sessions, joins of streams, and state kept per key."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def windowed(
    stream: DataFrame, time: str, keys: Sequence[str], aggregates: Sequence[Column], width: str, slide: str | None = None,
    start: str | None = None,
) -> DataFrame:
    """Aggregates by tumbling or sliding windows; the watermark lets old windows go."""
    out = stream.groupBy(F.window(time, width, slide, start).alias("window"), *keys).agg(*aggregates)
    rest = [c for c in out.columns if c not in {"window", *keys}]
    return out.select("window.start", "window.end", *keys, *rest)


def windows_of_panes(panes: DataFrame, start: str, keys: Sequence[str], sums: Sequence[str], width: int, slide: int) -> DataFrame:
    """start, keys and `sums` of every sliding window of `width` seconds that holds a pane, from sums of panes of `slide` seconds.

    A pane enters the windows from one start on and leaves them at another, so it is two rows, one
    added and one taken off, whatever the ratio of width to slide. Between two such times the
    windows of a key are equal. Sums must be whole numbers or decimals, which add and subtract
    exactly; a pane without rows is not there. A key's panes, which its span of time bounds, are in one task.
    """
    if width % slide:
        raise ValueError("the width must be a multiple of the slide")
    at = F.unix_seconds(F.col(start))
    moves = F.explode(F.array(
        F.struct((at - (width - slide)).alias("at"), F.lit(1).alias("sign")), F.struct((at + slide).alias("at"), F.lit(-1).alias("sign"))))
    rows = panes.select(*keys, *sums, moves.alias("move")).select(*keys, "move.at", *[(F.col(s) * F.col("move.sign")).alias(s) for s in sums], F.col("move.sign").alias("_held"))
    steps = rows.groupBy(*keys, "at").agg(*[F.sum(s).alias(s) for s in [*sums, "_held"]])
    along = Window.partitionBy(*keys).orderBy("at")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = steps.select(*keys, "at", F.lead("at").over(along).alias("_next"), *[F.sum(s).over(upto).alias(s) for s in [*sums, "_held"]])
    each = F.explode(F.sequence(F.col("at"), F.col("_next") - slide, F.lit(slide)))
    return totals.where("_held > 0").withColumn("_each", each).select(F.timestamp_seconds("_each").alias("start"), *keys, *sums)


def sessions(stream: DataFrame, time: str, keys: Sequence[str], aggregates: Sequence[Column], gap: str | Column) -> DataFrame:
    """Aggregates by session: rows closer than `gap`. The state is the sums, never the rows."""
    out = stream.groupBy(F.session_window(time, gap).alias("window"), *keys).agg(*aggregates)
    rest = [c for c in out.columns if c not in {"window", *keys}]
    return out.select("window.start", "window.end", *keys, *rest)


def first_seen(stream: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key within the watermark's delay."""
    return stream.dropDuplicatesWithinWatermark(list(keys))


def within(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, span: str, how: str = "inner") -> DataFrame:
    """Rows of two streams of one key where the right one comes at most `span` after the left.

    Both sides carry a watermark and the time bound, so rows leave the state once they
    can meet no more. Key columns of the right side must be named `<key>_right`.
    """
    on = [F.col(k) == F.col(f"{k}_right") for k in keys]
    late = F.col(left_time) + F.expr(f"INTERVAL {span}")
    on += [F.col(right_time) >= F.col(left_time), F.col(right_time) <= late]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    return left.join(right, condition, how)


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Count and sum per key over all batches so far, kept as a small state per key.

    The rows of a key come as an iterator of Arrow batches: a hot key is never one frame.
    """

    def update(name: tuple, batches: Iterator, state) -> Iterator:
        import pandas as pd

        n, total = state.get if state.exists else (0, 0.0)
        for b in batches:
            n += len(b)
            total += float(b[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [name[0]], "n": [n], "total": [total]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.select(key, value).groupBy(key).applyInPandasWithState(
        update, f"{key} {kind}, n bigint, total double", "n bigint, total double", "update", GroupStateTimeout.NoTimeout
    )
