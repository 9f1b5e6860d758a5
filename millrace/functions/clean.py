"""Cleaning rules for text cells: every rule gives null for a bad cell and never an error.

Marks are dropped with `translate`, which costs a fraction of a pattern match.
The rules do not lean on the session's ANSI flag, so they give the same rows in
any caller's session. Each is idempotent: cleaning a clean value changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The number shapes an integer cell may have.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)\s*$"
# Marks dropped from an identifier, and the day format of landed files.
IDENTIFIER_MARKS = ".-/"
DAY_FORMAT = "dd/MM/yyyy"


def clean_name(name: str) -> str:
    """Column name without dashes, doubled blanks joined, blanks as `_`, in lower case."""
    return name.replace("-", "").replace("  ", " ").replace(" ", "_").lower()


def clean_names(names: Sequence[str]) -> list[str]:
    """All names cleaned; refuses two names that become one."""
    cleaned = [clean_name(n) for n in names]
    clashes = sorted({c for c in cleaned if cleaned.count(c) > 1})
    if clashes:
        raise ValueError(f"column names clash after cleaning: {clashes}")
    return cleaned


def parse_day(text: Column, pattern: str = DAY_FORMAT) -> Column:
    """Date of a text day; null when the text is not one."""
    return F.try_to_date(text, pattern)


def clean_identifier(text: Column) -> Column:
    """Identifier without dots, dashes and slashes, trimmed."""
    return F.trim(F.translate(text, IDENTIFIER_MARKS, ""))


def clean_postcode(text: Column) -> Column:
    return F.translate(text, "-", "")


def parse_number(text: Column, thousands: str | None = None, kind: str = "float") -> Column:
    """Number from text with a comma as decimal mark; null when it is none.

    With `thousands` set (for example "."), that mark is dropped first; without it
    a text such as `1.234,56` has two marks and becomes null.
    """
    if thousands:
        text = F.replace(text, F.lit(thousands), F.lit(""))
    return F.translate(text, ",", ".").try_cast(kind)


def parse_int(text: Column) -> Column:
    """Whole part of a number cell after dropping commas; null for other text or out of range."""
    digits = F.translate(text, ",", "")
    return F.when(digits.rlike(NUMBER_PATTERN), digits.try_cast("double").try_cast("int"))


def label_of(code: Column, labels: Mapping) -> Column:
    """Label of a code from a small fixed map; null for an unknown or null code."""
    pairs = iter(labels.items())
    first_code, first_label = next(pairs)
    out = F.when(code == first_code, first_label)
    for value, label in pairs:
        out = out.when(code == value, label)
    return out


def comma_text(number: Column, scale: int = 2) -> Column:
    """Number as text with a comma as decimal mark: the inverse of `parse_number`."""
    return F.translate(number.cast(f"decimal(38,{scale})").cast("string"), ".", ",")
