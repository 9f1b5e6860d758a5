"""Tables filed by values made from their columns: a filter on the column finds the folders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import partitions as pt

_TIMES = {"years": pt.years, "months": pt.months, "days": pt.days, "hours": pt.hours}


@dataclass(frozen=True)
class Filed:
    """One partition value: years, months, days or hours of a time, or a bucket of any column."""

    source: str
    kind: str
    buckets: int = 0

    def __post_init__(self):
        if self.kind not in (*_TIMES, "bucket") or (self.kind == "bucket") != (self.buckets > 0):
            raise ValueError(f"{self.kind} of {self.source} with {self.buckets} buckets")

    @property
    def name(self) -> str:
        return f"{self.source}_{self.kind}"

    def value(self, c: Column) -> Column:
        return pt.bucket(self.buckets, c) if self.kind == "bucket" else _TIMES[self.kind](c).cast("int")


def with_folders(df: DataFrame, filed: Sequence[Filed]) -> DataFrame:
    """`df` with a column for each partition value; a null time has a null value."""
    return df.withColumns({f.name: F.when(F.col(f.source).isNotNull(), f.value(F.col(f.source))) for f in filed})


def in_range(df: DataFrame, filed: Sequence[Filed], source: str, low=None, high=None) -> DataFrame:
    """Rows with `low` <= source < `high`, either end open where it is None.

    The time values rise with the time, so the ends' own values bound the folders that are
    read; the rows in them are filtered by the column itself. Null is in no range.
    """
    c, kind = F.col(source), df.schema[source].dataType
    out = df.where(c.isNotNull())
    for end, holds in ((low, Column.__ge__), (high, Column.__le__)):
        if end is None:
            continue
        end = F.lit(end).cast(kind)
        out = out.where(c >= end if holds is Column.__ge__ else c < end)
        for f in filed:
            if f.source == source and f.kind != "bucket":
                out = out.where(holds(F.col(f.name), f.value(end)))
    return out


def equal(df: DataFrame, filed: Sequence[Filed], source: str, values: Sequence) -> DataFrame:
    """Rows whose `source` is one of `values`, from the folders that these values have."""
    kind = df.schema[source].dataType
    wanted = [F.lit(v).cast(kind) for v in values if v is not None]
    if not wanted:
        return df.limit(0)
    out = df.where(F.col(source).isin(*wanted))
    for f in filed:
        if f.source == source:
            out = out.where(F.col(f.name).isin(*[f.value(v) for v in wanted]))
    return out
