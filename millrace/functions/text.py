"""String operators in the pandas manner, as columns: zero-based places, -1 for "not there"."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chars(s: Column) -> Column:
    """Characters of the text as an array."""
    return F.filter(F.split(s, ""), lambda c: c != "")


def capitalize(s: Column) -> Column:
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, F.lit(2), F.length(s))))


def title(s: Column) -> Column:
    """Every letter that follows no letter in upper case, the others in lower case."""
    return F.array_join(F.transform(F.split(s, r"(?<!\p{L})(?=\p{L})"), capitalize), "")


def swapcase(s: Column) -> Column:
    return F.array_join(F.transform(chars(s), lambda c: F.when(c == F.upper(c), F.lower(c)).otherwise(F.upper(c))), "")


def ljust(s: Column, width: int, fill: str = " ") -> Column:
    return F.rpad(s, F.greatest(F.length(s), F.lit(width)), F.lit(fill))


def rjust(s: Column, width: int, fill: str = " ") -> Column:
    return F.lpad(s, F.greatest(F.length(s), F.lit(width)), F.lit(fill))


def center(s: Column, width: int, fill: str = " ") -> Column:
    """Pad on both sides; an odd rest goes left only when the width is odd too."""
    spare = F.greatest(F.lit(width) - F.length(s), F.lit(0))
    left = F.floor(spare / 2).cast("int") + spare.bitwiseAND(width & 1)
    return F.concat(F.repeat(F.lit(fill), left), s, F.repeat(F.lit(fill), spare - left))


def pad(s: Column, width: int, side: str = "left", fill: str = " ") -> Column:
    return {"left": rjust, "right": ljust, "both": center}[side](s, width, fill)


def zfill(s: Column, width: int) -> Column:
    """Zeros after a leading sign."""
    sign = F.regexp_extract(s, "^[+-]", 0)
    rest = F.regexp_replace(s, "^[+-]", "")
    return F.concat(sign, F.lpad(rest, F.greatest(F.length(rest), F.lit(width) - F.length(sign)), F.lit("0")))


def slice_text(s: Column, start: int | None = None, stop: int | None = None, step: int = 1) -> Column:
    """Characters `start` to `stop`; negative places count from the end."""
    size = F.length(s)

    def place(value: int | None, default: Column) -> Column:
        if value is None:
            return default
        return F.lit(value) if value >= 0 else F.greatest(size + value, F.lit(0))

    begin, end = place(start, F.lit(0)), place(stop, size)
    cut = F.substring(s, begin + 1, F.greatest(end - begin, F.lit(0)))
    if step == 1:
        return cut
    return F.array_join(F.filter(chars(cut), lambda _, i: i % step == 0), "")


def slice_replace(s: Column, start: int, stop: int, repl: str) -> Column:
    return F.concat(slice_text(s, 0, start), F.lit(repl), slice_text(s, stop))


def find(s: Column, sub: str, start: int = 0) -> Column:
    return F.locate(sub, s, start + 1) - 1


def rfind(s: Column, sub: str) -> Column:
    back = F.instr(F.reverse(s), sub[::-1])
    return F.when(back == 0, -1).otherwise(F.length(s) - back - len(sub) + 1)


def index_of(s: Column, sub: str, last: bool = False) -> Column:
    """As `find`, but a text without `sub` stops the query."""
    place = rfind(s, sub) if last else find(s, sub)
    return F.when(place < 0, F.raise_error(F.lit("substring not found")).cast("int")).otherwise(place)


def findall(s: Column, pattern: str) -> Column:
    return F.regexp_extract_all(s, F.lit(pattern), F.lit(0))


def count(s: Column, pattern: str) -> Column:
    return F.regexp_count(s, F.lit(pattern))


def matches(s: Column, pattern: str) -> Column:
    """The pattern at the text's start."""
    return s.rlike(f"^(?:{pattern})")


def split_n(s: Column, sep: str, n: int = -1) -> Column:
    """Split on a plain separator, at most `n` times from the left."""
    return F.split(s, _quoted(sep), n + 1 if n > 0 else -1)


def rsplit_n(s: Column, sep: str, n: int = -1) -> Column:
    """Split on a plain separator, at most `n` times from the right."""
    if n <= 0:
        return split_n(s, sep)
    turned = F.split(F.reverse(s), _quoted(sep[::-1]), n + 1)
    return F.reverse(F.transform(turned, lambda part: F.reverse(part)))


def partition(s: Column, sep: str) -> Column:
    """Text before, the separator, text after; the whole text first when it is not there."""
    place = F.instr(s, sep)
    tail = F.substring(s, place + len(sep), F.length(s))
    return F.when(place == 0, F.array(s, F.lit(""), F.lit(""))).otherwise(
        F.array(F.substring(s, F.lit(1), place - 1), F.lit(sep), tail)
    )


def rpartition(s: Column, sep: str) -> Column:
    place = rfind(s, sep)
    return F.when(place < 0, F.array(F.lit(""), F.lit(""), s)).otherwise(
        F.array(F.substring(s, F.lit(1), place), F.lit(sep), F.substring(s, place + len(sep) + 1, F.length(s)))
    )


def flags(s: Column, values: list[str], sep: str = "|") -> dict[str, Column]:
    """One 0/1 column per value for a text that lists values."""
    parts = F.split(s, _quoted(sep))
    return {v: F.array_contains(parts, v).cast("int") for v in values}


def replace(s: Column, pattern: str, repl: str, n: int = -1, regex: bool = True) -> Column:
    """Replace all, or the first `n`, matches; `repl` is plain text when `n` is set."""
    if n < 0:
        return F.regexp_replace(s, pattern, repl) if regex else F.replace(s, F.lit(pattern), F.lit(repl))
    return F.concat_ws(repl, F.split(s, pattern if regex else _quoted(pattern), n + 1))


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r".^$*+?{}[]\|()-" else c for c in text)


# Character classes of the text tests.
_TESTS = {
    "isalnum": r"^[\p{L}\p{N}]+$",
    "isalpha": r"^\p{L}+$",
    "isdigit": r"^\p{Nd}+$",
    "isdecimal": r"^\p{Nd}+$",
    "isnumeric": r"^\p{N}+$",
    "isspace": r"^\s+$",
    "islower": r"^(?=.*\p{Ll})[^\p{Lu}\p{Lt}]*$",
    "isupper": r"^(?=.*\p{Lu})[^\p{Ll}\p{Lt}]*$",
    "istitle": r"^(?=.*\p{Lu})(?:\P{L}|\p{Lu}\p{Ll}*(?!\p{Lu}))*$",
}


def is_class(s: Column, test: str) -> Column:
    """Python's text tests by name, such as `isalpha`; an empty text is in no class."""
    return s.rlike(f"(?s){_TESTS[test]}")


def wrap(s: Column, width: int) -> Column:
    """Lines of at most `width` characters, broken at blanks."""

    @F.pandas_udf("string")
    def wrapped(texts):
        import textwrap

        return texts.map(lambda x: None if x is None else "\n".join(textwrap.wrap(x, width)))

    return wrapped(s)


def normalize(s: Column, form: str = "NFC") -> Column:
    """Unicode normal form, in Arrow batches: no column function has it."""

    @F.pandas_udf("string")
    def normal(texts):
        return texts.str.normalize(form)

    return normal(s)
