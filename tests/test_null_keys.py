import pytest
from pyspark.sql import functions as F

from millrace.functions import numbers
from millrace.operators import frames, joins, ordered
from millrace.sources import tables


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
def test_asof_null_time_and_odd_names(spark, direction):
    left = spark.createDataFrame([(1, 4), (2, None)], "`my id-x` int, t int")
    right = spark.createDataFrame([(4, "a"), (9, "b")], "t int, `Regiao - Sigla` string")
    rows = {r[0]: r["Regiao - Sigla"] for r in joins.asof_join(left, right, "t", direction=direction).collect()}
    assert rows == {1: "a", 2: None}


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("k", 5.0)], "k string, v double")
    assert frames.transform_groups(df, ["k"], {"m": F.avg("v")}).orderBy("v").collect() == [(None, 1.0, 2.0), (None, 3.0, 2.0), ("k", 5.0, 5.0)]
    assert {r[0]: r[1] for r in frames.mean_abs_deviation(df, ["k"], "v").collect()} == {None: 1.0, "k": 0.0}
    assert frames.mode(df, ["k"], "v").count() == 3


def test_null_is_no_monotonic_step(spark):
    rows = lambda *v: spark.createDataFrame(list(enumerate(v)), "i int, v int")
    result = lambda df: frames.is_monotonic(df, "v", ["i"]).first()[0]
    assert not result(rows(None, 1, 2)) and result(rows(1, 2, 2)) and not result(rows(2, 1))


def test_rank_keeps_rows_of_null_keys(spark):
    df = spark.createDataFrame([(1, "a", 3.0), (2, None, 2.0), (3, None, None), (4, "a", None)], "i int, k string, v double")
    got = {r["i"]: r["rank_min"] for r in ordered.ranked(df, ["k"], "v", ["i"]).collect()}
    assert got == {1: 1, 2: None, 3: None, 4: None}


def test_whole_division_past_double_range(spark):
    pairs = [(9007199254740993, 1), (-7, 2), (7, -2), (-8, 2), (5, 0), (None, 3), (9223372036854775807, -10)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = df.select("a", "b", numbers.floordiv(F.col("a"), F.col("b")).alias("q"), numbers.mod(F.col("a"), F.col("b")).alias("r"))
    for r in got.collect():
        want = (r["a"] // r["b"], r["a"] % r["b"]) if r["a"] is not None and r["b"] else (None, None)
        assert (r["q"], r["r"]) == want
    parts = spark.createDataFrame([(7.5, 2.0), (-7.5, 2.0)], "a double, b double")
    assert [tuple(r) for r in parts.select(numbers.floordiv(F.col("a"), F.col("b")), numbers.mod(F.col("a"), F.col("b"))).collect()] == [(3, 1.5), (-4, 0.5)]


def test_overwrite_where_with_null_and_quoted_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, None), (4, "it's"), (5, "\\")], "v int, p string")
    tables.create(rows, "null_parts", str(tmp_path / "t"), ["p"])
    held = lambda: {(r["v"], r["p"]) for r in spark.table("null_parts").collect()}
    try:
        tables.overwrite_where(spark.createDataFrame([(9, None)], "v int, p string"), "null_parts", F.col("v") == 2)
        assert held() == {(1, "a"), (9, None), (3, None), (4, "it's"), (5, "\\")}
        tables.overwrite_where(spark.createDataFrame([(7, "a")], "v int, p string"), "null_parts", F.col("p").isNull())
        assert held() == {(1, "a"), (7, "a"), (4, "it's"), (5, "\\")}
        tables.overwrite_where(spark.createDataFrame([(8, "a")], "v int, p string"), "null_parts", F.col("v").isin(4, 5))
        assert held() == {(1, "a"), (7, "a"), (8, "a")}
    finally:
        spark.sql("DROP TABLE null_parts")


def test_compare_keeps_null_keys_and_refuses_lone_ones(spark):
    a = spark.createDataFrame([(1, "x"), (None, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (None, "z")], "k int, v string")
    assert [tuple(r) for r in frames.compare(a, b, ["k"]).collect()] == [(None, "v", "y", "z")]
    with pytest.raises(Exception, match="differ in their keys"):
        frames.compare(a, b.where("k = 1"), ["k"]).collect()
