"""Arithmetic with Python's rules, limits, and lenient parsing of cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE = ("tinyint", "smallint", "int", "bigint")


def floordiv(a: Column, b: Column) -> Column:
    """Quotient rounded down; null for a zero divisor. Exact where both are whole numbers of at most 64 bits."""
    exact = F.typeof(a).isin(*WHOLE) & F.typeof(b).isin(*WHOLE)
    x, y = a.cast("bigint"), b.cast("bigint")
    # `div` cuts towards zero: one less where there is a rest and the signs differ
    whole = F.call_function("div", x, y) - F.when((x % y != 0) & ((x < 0) != (y < 0)), 1).otherwise(0)
    return F.when(b != 0, F.when(exact, whole).otherwise(F.floor(F.try_divide(a, b))))


def mod(a: Column, b: Column) -> Column:
    """Rest with the sign of the divisor; null for a zero divisor."""
    rest = a % b
    return F.when(b != 0, F.when((rest != 0) & ((rest < 0) != (b < 0)), rest + b).otherwise(rest))


def divmod_(a: Column, b: Column) -> tuple[Column, Column]:
    return floordiv(a, b), mod(a, b)


def clip(c: Column, lower=None, upper=None) -> Column:
    """Values moved to the nearer bound; a null stays null."""
    out = c
    if lower is not None:
        out = F.greatest(out, F.lit(lower))
    if upper is not None:
        out = F.least(out, F.lit(upper))
    return F.when(c.isNotNull(), out)


def to_numeric(c: Column, errors: str = "coerce") -> Column:
    return c.cast("double") if errors == "raise" else c.try_cast("double")


def to_timedelta(c: Column, unit: str = "SECOND") -> Column:
    """Whole numbers to a day-time interval of the unit."""
    parts = {"DAY": "days", "HOUR": "hours", "MINUTE": "mins", "SECOND": "secs"}
    return F.make_dt_interval(**{parts[unit]: c})


def codes(c: Column, categories: list) -> Column:
    """Zero-based place of a value in its category list; -1 for none."""
    place = F.array_position(F.array(*[F.lit(v) for v in categories]), c)
    return F.coalesce(place - 1, F.lit(-1)).cast("int")


def of_code(code: Column, categories: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in categories]), code)


def set_categories(c: Column, categories: list) -> Column:
    """Value when it is among the categories, else null."""
    return F.when(c.isin(*categories), c)
