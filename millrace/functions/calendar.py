"""Calendar fields and tests of a time column, in the pandas manner (Monday is 0)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def weekday(c: Column) -> Column:
    return F.weekday(c)


def day_name(c: Column) -> Column:
    return F.date_format(c, "EEEE")


def month_name(c: Column) -> Column:
    return F.date_format(c, "MMMM")


def days_in_month(c: Column) -> Column:
    return F.dayofmonth(F.last_day(c))


def microsecond(c: Column) -> Column:
    return F.date_format(c, "SSSSSS").cast("int")


def is_month_start(c: Column) -> Column:
    return F.dayofmonth(c) == 1


def is_month_end(c: Column) -> Column:
    return F.to_date(c) == F.last_day(c)


def is_quarter_start(c: Column) -> Column:
    return is_month_start(c) & (F.month(c) % 3 == 1)


def is_quarter_end(c: Column) -> Column:
    return is_month_end(c) & (F.month(c) % 3 == 0)


def is_year_start(c: Column) -> Column:
    return F.dayofyear(c) == 1


def is_year_end(c: Column) -> Column:
    return (F.month(c) == 12) & (F.dayofmonth(c) == 31)


def is_leap_year(c: Column) -> Column:
    y = F.year(c)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def floor_to(c: Column, seconds: int) -> Column:
    """Time rounded down to a multiple of `seconds` since the epoch."""
    return F.timestamp_micros(_micros(c) - F.pmod(_micros(c), F.lit(seconds * 1_000_000)))


def ceil_to(c: Column, seconds: int) -> Column:
    step = F.lit(seconds * 1_000_000)
    return F.timestamp_micros(_micros(c) + F.pmod(-_micros(c), step))


def round_to(c: Column, seconds: int) -> Column:
    """Time rounded to the nearest multiple; a tie goes to the even multiple."""
    step = F.lit(seconds * 1_000_000)
    rest = F.pmod(_micros(c), step)
    low = _micros(c) - rest
    odd = F.pmod((low / step).cast("bigint"), F.lit(2)) == 1
    up = (rest * 2 > step) | ((rest * 2 == step) & odd)
    return F.timestamp_micros(F.when(up, low + step).otherwise(low))


def normalize(c: Column) -> Column:
    """Midnight of the day."""
    return F.date_trunc("day", c)


def between_time(c: Column, start: str, end: str) -> Column:
    """Time of day within `HH:mm:ss` bounds, both included; a range past midnight wraps."""
    at = F.date_format(c, "HH:mm:ss.SSSSSS")
    low, high = F.lit(f"{start}.000000"), F.lit(f"{end}.000000")
    return at.between(low, high) if start <= end else (at >= low) | (at <= high)


def at_time(c: Column, when: str) -> Column:
    return F.date_format(c, "HH:mm:ss") == when


def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))
