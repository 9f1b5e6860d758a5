"""Sessions of a batch table, for keys of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import along, cut, one_back, running_sum


def sessionize(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str], gap: Column, name: str = "session", **options
) -> DataFrame:
    """Number the sessions of each key: one starts where the time before is `gap` or more ago.

    The time before and the running count of starts go along one cut of the keys, so no task
    sorts all rows of a key and the rows are shuffled once. `ties` make the order total.
    """
    order = [time, *ties]
    # rows are no longer dealt in blocks, so `block_rows` of older calls says nothing
    cuts = {k: v for k, v in options.items() if k != "block_rows"}
    placed = along(cut(df, keys, order, **cuts), order, {"_before": one_back(time)})
    fresh = F.when(F.col(time) - F.col("_before") < gap, 0).otherwise(1)
    numbered = along(placed.withColumn("_fresh", fresh), order, {name: running_sum("_fresh")})
    return numbered.select(*df.columns, name)
