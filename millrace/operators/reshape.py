"""Wide to long and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import fits

TRANSPOSE_ROWS = 1000


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    """One row per id and value column, null cells kept."""
    return df.unpivot(list(ids), list(values), name, value)


def stack(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "level", value: str = "value") -> DataFrame:
    """As `melt`, without null cells."""
    return melt(df, ids, values, name, value).where(F.col(value).isNotNull())


def pivot_table(df: DataFrame, index: Sequence[str], column: str, labels: Sequence, aggregate: Column, fill=None) -> DataFrame:
    """One column per label of `column`, filled by an aggregate; the labels are given."""
    out = df.groupBy(*index).pivot(column, list(labels)).agg(aggregate)
    return out if fill is None else out.fillna(fill)


def dummies(df: DataFrame, column: str, labels: Sequence, prefix: str | None = None, sep: str = "_") -> DataFrame:
    """A 0/1 column per label in place of `column`."""
    head = column if prefix is None else prefix
    flags = [(F.col(column).eqNullSafe(v)).cast("int").alias(f"{head}{sep}{v}") for v in labels]
    return df.select(*[c for c in df.columns if c != column], *flags)


def transpose(df: DataFrame, key: str) -> DataFrame:
    """Rows to columns for a small result table: refuses more than `TRANSPOSE_ROWS` rows."""
    if not fits(df, TRANSPOSE_ROWS):
        raise ValueError(f"transpose takes at most {TRANSPOSE_ROWS} rows")
    return df.transpose(key)
