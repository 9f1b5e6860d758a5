"""Text, number and calendar columns against Python's own answers."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import calendar as cal
from millrace.functions import numbers as num
from millrace.functions import text as tx

TEXTS = [
    "", "a", "Ab", "hello world", "Hello World", "HELLO", "o'neil mc-donald", "x1y2", "123", "+7", "-42", "  pad ", "a/b/c", "no sep", "/lead",
    "trail/", "été Ça", "Title Case", "Bad Title case", "aXbXc", "tab\tx", "A1 B2",
]

CASES = {
    "capitalize": (tx.capitalize, str.capitalize),
    "title": (tx.title, str.title),
    "swapcase": (tx.swapcase, str.swapcase),
    "center even": (lambda c: tx.center(c, 12, "*"), lambda s: s.center(12, "*")),
    "center odd": (lambda c: tx.center(c, 9, "*"), lambda s: s.center(9, "*")),
    "ljust": (lambda c: tx.ljust(c, 8, "."), lambda s: s.ljust(8, ".")),
    "rjust": (lambda c: tx.rjust(c, 8, "."), lambda s: s.rjust(8, ".")),
    "zfill": (lambda c: tx.zfill(c, 6), lambda s: s.zfill(6)),
    "slice": (lambda c: tx.slice_text(c, 1, 4), lambda s: s[1:4]),
    "slice tail": (lambda c: tx.slice_text(c, -3), lambda s: s[-3:]),
    "slice to end": (lambda c: tx.slice_text(c, 2, -1), lambda s: s[2:-1]),
    "slice step": (lambda c: tx.slice_text(c, 0, None, 3), lambda s: s[::3]),
    "slice replace": (lambda c: tx.slice_replace(c, 1, 3, "#"), lambda s: s[:1] + "#" + s[3:]),
    "find": (lambda c: tx.find(c, "o"), lambda s: s.find("o")),
    "find from": (lambda c: tx.find(c, "o", 5), lambda s: s.find("o", 5)),
    "rfind": (lambda c: tx.rfind(c, "o"), lambda s: s.rfind("o")),
    "count": (lambda c: tx.count(c, "[a-z]"), lambda s: sum("a" <= x <= "z" for x in s)),
    "partition": (lambda c: F.array_join(tx.partition(c, "/"), "|"), lambda s: "|".join(s.partition("/"))),
    "rpartition": (lambda c: F.array_join(tx.rpartition(c, "/"), "|"), lambda s: "|".join(s.rpartition("/"))),
    "split": (lambda c: F.array_join(tx.split_n(c, "/"), "|"), lambda s: "|".join(s.split("/"))),
    "split n": (lambda c: F.array_join(tx.split_n(c, "/", 1), "|"), lambda s: "|".join(s.split("/", 1))),
    "rsplit n": (lambda c: F.array_join(tx.rsplit_n(c, "/", 1), "|"), lambda s: "|".join(s.rsplit("/", 1))),
    "replace": (lambda c: tx.replace(c, "X", "-", regex=False), lambda s: s.replace("X", "-")),
    "replace once": (lambda c: tx.replace(c, "X", "-", n=1, regex=False), lambda s: s.replace("X", "-", 1)),
    **{
        name: (lambda c, name=name: tx.is_class(c, name), getattr(str, name))
        for name in ("isalnum", "isalpha", "isdigit", "isspace", "islower", "isupper", "istitle", "isnumeric", "isdecimal")
    },
}


@pytest.mark.parametrize("name", CASES)
def test_text_as_python(spark, name):
    build, python = CASES[name]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(TEXTS)], "i int, s string").coalesce(1)
    got = [r.x for r in df.orderBy("i").select(build(F.col("s")).alias("x")).collect()]
    assert got == [python(s) for s in TEXTS]


def test_index_stops_on_a_missing_part(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    assert df.select(tx.index_of(F.col("s"), "c")).first()[0] == 2
    with pytest.raises(Exception, match="substring not found"):
        df.select(tx.index_of(F.col("s"), "z")).collect()


def test_wrap_and_normal_form(spark):
    df = spark.createDataFrame([("the quick brown fox", "é"), (None, None)], "s string, u string")
    rows = df.select(tx.wrap(F.col("s"), 10).alias("w"), tx.normalize(F.col("u")).alias("n")).collect()
    assert rows[0] == ("the quick\nbrown fox", "é") and rows[1] == (None, None)


@pytest.mark.parametrize(("a", "b"), [(7, 2), (-7, 2), (7, -2), (-7, -2), (6, 3), (1, 0)])
def test_division_as_python(spark, a, b):
    q, r = num.divmod_(F.lit(a), F.lit(b))
    got = spark.range(1).select(q.alias("q"), r.alias("r")).first()
    assert (got.q, got.r) == (divmod(a, b) if b else (None, None))


def test_clip_and_codes(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "z"), (9.0, None)], "v double, k string")
    got = df.select(num.clip(F.col("v"), 2, 5).alias("v"), num.codes(F.col("k"), ["a", "b"]).alias("c")).collect()
    assert [(r.v, r.c) for r in got] == [(2.0, 0), (None, -1), (5.0, -1)]


def test_calendar_as_pandas(spark):
    times = pd.to_datetime([
        "2024-02-29 23:59:59.5", "2023-12-31 00:07:30", "2024-01-01 00:22:30", "1969-12-31 23:50:00", "2024-03-31 12:00:00", "2000-02-28 01:02:03.000004",
    ], format="ISO8601")
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(times)), "t": times}))
    columns = {
        "floor": cal.floor_to(F.col("t"), 900), "ceil": cal.ceil_to(F.col("t"), 900), "round": cal.round_to(F.col("t"), 900),
        "me": cal.is_month_end(F.col("t")), "qs": cal.is_quarter_start(F.col("t")), "qe": cal.is_quarter_end(F.col("t")), "ys": cal.is_year_start(F.col("t")),
        "ye": cal.is_year_end(F.col("t")), "leap": cal.is_leap_year(F.col("t")), "dim": cal.days_in_month(F.col("t")), "us": cal.microsecond(F.col("t")),
        "wd": cal.weekday(F.col("t")), "name": cal.day_name(F.col("t")), "midnight": cal.normalize(F.col("t")),
    }
    got = df.orderBy("i").select(*[c.alias(n) for n, c in columns.items()]).toPandas()
    s = pd.Series(times)
    want = {
        "floor": s.dt.floor("15min"), "ceil": s.dt.ceil("15min"), "round": s.dt.round("15min"), "me": s.dt.is_month_end, "qs": s.dt.is_quarter_start,
        "qe": s.dt.is_quarter_end, "ys": s.dt.is_year_start, "ye": s.dt.is_year_end, "leap": s.dt.is_leap_year, "dim": s.dt.days_in_month,
        "us": s.dt.microsecond, "wd": s.dt.weekday, "name": s.dt.day_name(), "midnight": s.dt.normalize(),
    }
    for name, values in want.items():
        assert list(got[name]) == list(values), name
