"""Partition values made from a column, as derived columns of a partitioned table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the year the counts start from.
EPOCH_YEAR = 1970


def years(c: Column) -> Column:
    """Years since 1970."""
    return F.year(c) - EPOCH_YEAR


def months(c: Column) -> Column:
    """Months since January 1970."""
    return (F.year(c) - EPOCH_YEAR) * 12 + F.month(c) - 1


def days(c: Column) -> Column:
    return F.unix_date(F.to_date(c))


def hours(c: Column) -> Column:
    return F.floor(F.unix_seconds(c.cast("timestamp")) / 3600)


def bucket(n: int, *columns: Column) -> Column:
    """Hash bucket, as bucketed tables number them."""
    return F.pmod(F.hash(*columns), F.lit(n))
