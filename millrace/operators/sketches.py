"""Counts of different values by mergeable sketches, kept by day and rolled up without the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 16  # log2 of a sketch's cells; a rolled-up estimate's error is about 1.04 / sqrt(cells), one of a single pass a little less


def day_sketches(rows: DataFrame, day: Column, keys: Sequence[str], value: str, cells: int = CELLS) -> DataFrame:
    """day, keys and sketch: one small row for each day and key, made by partial aggregates. Nulls are not counted."""
    return rows.groupBy(day.alias("day"), *keys).agg(F.hll_sketch_agg(value, F.lit(cells)).alias("sketch"))


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys and sketch: the union of the sketches of each key; unions made in another order may differ within the error."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def rolled_up(sketches: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """keys and the estimated number of different values of all sketches of each key."""
    return merged(sketches, keys).select(*keys, F.hll_sketch_estimate("sketch").alias(name))
