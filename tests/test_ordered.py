"""Chunked ordered operators against plain windows, with a hot key, null keys and null values."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.operators import ordered as o


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(7)
    data = []
    for i in range(300):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        value = None if rng.random() < 0.3 else float(rng.randint(-3, 9))
        data.append((i, key, rng.randint(0, 40), value))
    return spark.createDataFrame(data, "id int, k string, t int, v double").repartition(5)


def same(a, b):
    key = lambda r: tuple((x is not None, x) for x in r)
    left = sorted(map(tuple, a.select(*b.columns).collect()), key=key)
    right = sorted(map(tuple, b.collect()), key=key)
    assert len(left) == len(right)
    for x, y in zip(left, right):
        assert x == pytest.approx(y, nan_ok=True), (x, y)


@pytest.mark.parametrize("pieces", [1, 6])
def test_running_equals_plain_window(rows, pieces):
    order = ["t", "id"]
    w = Window.partitionBy("k").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    got = o.running(rows, ["k"], order, {
        "s": o.running_sum("v"), "n": o.running_count("v"), "lo": o.running_min("v"), "hi": o.running_max("v"),
        "rn": o.row_number(), "last": o.last_value("v", order),
    }, totals={"size": F.count("*")}, pieces=pieces)
    want = rows.select(
        "*", F.sum("v").over(upto).alias("s"), F.count("v").over(upto).alias("n"), F.min("v").over(upto).alias("lo"),
        F.max("v").over(upto).alias("hi"), F.row_number().over(w).alias("rn"),
        F.last("v", True).over(upto).alias("last"), F.count("*").over(Window.partitionBy("k")).alias("size"),
    )
    same(got, want)


def test_ranks_equal_plain_window(rows):
    w = Window.partitionBy("k").orderBy("t")
    got = o.running(rows, ["k"], ["t"], {"r": o.rank(), "d": o.dense_rank(["t"])}, pieces=5)
    same(got, rows.select("*", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d")))


def test_product(rows):
    some = rows.where("v between 1 and 2")
    upto = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = o.running(some, ["k"], ["t", "id"], {"p": o.running_product("v")}, pieces=4)
    same(got, some.select("*", F.product("v").over(upto).alias("p")))


@pytest.mark.parametrize("block", [3, 1000])
def test_shift_and_rolling(rows, block):
    w = Window.partitionBy("k").orderBy("t", "id")
    got = o.shifted(rows, ["k"], ["t", "id"], {"b": ("v", 2), "f": ("v", -1)}, block_rows=block, pieces=4)
    same(got, rows.select("*", F.lag("v", 2).over(w).alias("b"), F.lead("v", 1).over(w).alias("f")))
    frame = w.rowsBetween(-2, 0)
    got = o.rolling(rows, ["k"], ["t", "id"], 3, {"m": F.sum("v")}, min_periods=2, counted="v", block_rows=block)
    same(got, rows.select("*", F.when(F.count("v").over(frame) >= 2, F.sum("v").over(frame)).alias("m")))


@pytest.mark.parametrize("backward", [False, True])
def test_fill(rows, backward):
    w = Window.partitionBy("k").orderBy("t", "id")
    frame = w.rowsBetween(0, Window.unboundedFollowing) if backward else w.rowsBetween(Window.unboundedPreceding, 0)
    pick = F.first if backward else F.last
    got = o.fill(rows, ["k"], ["t", "id"], ["v"], backward=backward, pieces=5)
    same(got, rows.select("*", pick("v", True).over(frame).alias("v_filled")))
    near = w.rowsBetween(0, 1) if backward else w.rowsBetween(-1, 0)
    got = o.fill(rows, ["k"], ["t", "id"], ["v"], backward=backward, limit=1, block_rows=4)
    same(got, rows.select("*", pick("v", True).over(near).alias("v_filled")))


def test_ranked_equals_pandas(rows):
    pdf = rows.where("k is not null").toPandas()
    got = o.ranked(rows.where("k is not null"), ["k"], "v", ["id"], pieces=4).toPandas().set_index("id").sort_index()
    pdf = pdf.set_index("id").sort_index()
    for method in ("first", "min", "max", "average", "dense"):
        want = pdf.groupby("k")["v"].rank(method=method)
        assert got[f"rank_{method}"].astype(float).equals(want.astype(float)) or (
            (got[f"rank_{method}"].astype(float) - want).abs().max() < 1e-9
        )


def test_global_position(rows):
    got = o.global_position(rows, ["t", "id"], pieces=7).orderBy("position").collect()
    assert [r.position for r in got] == list(range(300))
    assert [(r.t, r.id) for r in got] == sorted((r.t, r.id) for r in got)


def test_hot_key_is_spread(rows):
    """No (key, chunk) piece of the hot key holds more than its share of the rows."""
    cut = o.with_chunks(rows, ["id"], 10)
    assert cut.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0] <= 30


def test_hot_order_value_is_spread(spark):
    """Two thirds of the rows share one time: they are cut along the second order column."""
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(20).alias("t"))
    cut = o.with_chunks(df, ["t", "id"], 12)
    assert cut.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 80
    w = Window.partitionBy(F.lit(1)).orderBy("t", "id")
    got = o.running(df, [], ["t", "id"], {"rn": o.row_number(), "s": o.running_sum("id")}, pieces=12)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    same(got, df.select("*", F.row_number().over(w).alias("rn"), F.sum("id").over(upto).alias("s")))


def test_many_null_order_values_are_spread(spark):
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, (F.col("id") % 50).cast("double")).alias("t"))
    cut = o.with_chunks(df, ["t", "id"], 12)
    assert cut.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 80
    for descending in (False, True):
        sort = [F.desc("t"), F.desc("id")] if descending else ["t", "id"]
        w = Window.partitionBy(F.lit(1)).orderBy(*sort)
        got = o.running(df, [], ["t", "id"], {"rn": o.row_number()}, pieces=12, descending=descending)
        same(got, df.select("*", F.row_number().over(w).alias("rn")))


@pytest.mark.parametrize("head", ["https://www.example.com/page/", "Customer#000000"])
def test_texts_with_long_common_heads_are_spread(spark, head):
    df = spark.range(2000).select(F.concat(F.lit(head), F.lpad(F.col("id").cast("string"), 4, "0")).alias("t"), "id")
    cut = o.with_chunks(df, ["t"], 10)
    assert cut.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 400
    assert cut.groupBy("_chunk").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).orderBy("_chunk").count() >= 9
    got = o.global_position(df, ["t"], "n", pieces=10)
    assert got.where("n <> id").count() == 0


def test_rows_hot_on_two_levels_are_cut_along_the_third(spark):
    third = F.when(F.col("id") % 7 == 0, None).otherwise(F.lit("k")).alias("b")
    df = spark.range(3000).select((F.col("id") % 2).alias("a"), third, "id")
    cut = o.with_chunks(df, ["a", "b", "id"], 10)
    assert cut.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 700
    got = o.global_position(df, ["a", "b", "id"], "n", pieces=10).orderBy("n").collect()
    want = sorted(got, key=lambda r: (r.a, r.b is not None, r.b or "", r.id))
    assert [r.id for r in got] == [r.id for r in want]


def test_text_order(spark):
    words = ["a", "ab", "abcdef", "abcdefg", "abcdefz", "é", "zz", None]
    data = [(i, words[i % 8] and words[i % 8] + "x" * (i % 3)) for i in range(160)]
    df = spark.createDataFrame(data, "id int, w string")
    got = o.running(df, [], ["w", "id"], {"rn": o.row_number()}, pieces=9)
    w = Window.partitionBy(F.lit(1)).orderBy("w", "id")
    same(got, df.select("*", F.row_number().over(w).alias("rn")))


def naive_asof(left, right, direction, exact, tolerance):
    """All pairs of a small fixture, then the nearest: brute force for comparison."""
    out = []
    for a in left:
        best = None
        for b in right:
            if a.k is None or a.k != b.k:
                continue
            gap = a.t - b.t
            if gap == 0 and not exact:
                continue
            if direction == "backward" and gap < 0 or direction == "forward" and gap > 0:
                continue
            if tolerance is not None and abs(gap) > tolerance:
                continue
            rank = (abs(gap), 0 if gap >= 0 else 1)
            if best is None or rank < best[0]:
                best = (rank, b)
        out.append((a.id, best[1].t if best else None))
    return sorted(out)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, 2])
def test_asof_equals_brute_force(rows, direction, exact, tolerance):
    left = rows.where("id % 2 = 0").select("id", "k", "t")
    right = rows.where("id % 7 = 1").select("k", F.col("t"), F.col("v").alias("rv")).dropDuplicates(["k", "t"])
    got = joins.asof_join(
        left.where("k is not null"), right, "t", ["k"], direction=direction, exact=exact,
        tolerance=None if tolerance is None else F.lit(tolerance), pieces=4,
    )
    got = sorted((r.id, r.t_right) for r in got.select("id", "t_right").collect())
    want = naive_asof(left.where("k is not null").collect(), right.collect(), direction, exact, tolerance)
    assert got == want


def test_asof_with_a_crowded_time(spark):
    """Half of all rows share one time: each left row still finds it, and no chunk holds them all."""
    left = spark.range(400).select(F.col("id"), F.when(F.col("id") % 2 == 0, 50).otherwise(F.col("id")).cast("int").alias("t"))
    right = spark.range(300).select(F.when(F.col("id") % 2 == 0, 50).otherwise(F.col("id")).cast("int").alias("t"), F.lit(1).alias("v"))
    times = sorted({r.t for r in right.collect()})
    got = {r.id: r.t_right for r in joins.asof_join(left, right, "t", pieces=8).collect()}
    assert len(got) == 400
    assert got == {r.id: max((x for x in times if x <= r.t), default=None) for r in left.collect()}


@pytest.mark.parametrize("exact", [True, False])
def test_nearest_with_a_crowded_time(spark, exact):
    """A time that fills several chunks on both sides: rows of one time are cut apart, matches are not lost."""
    def hot(i, every):
        return F.when(i % every == 0, 50).otherwise(i % 90).cast("int").alias("t")

    left = spark.range(400).select("id", F.lit("a").alias("k"), hot(F.col("id"), 2))
    right = spark.range(300).where("id % 90 not in (49, 52)").select(F.lit("a").alias("k"), hot(F.col("id"), 3), F.col("id").alias("v"))
    got = joins.asof_join(left, right, "t", ["k"], direction="nearest", exact=exact, pieces=8)
    got = sorted((r.id, r.t_right) for r in got.select("id", "t_right").collect())
    assert got == naive_asof(left.collect(), right.collect(), "nearest", exact, None)


def test_ranks_without_ties(rows):
    """Without `ties` no `first` rank is made; the others stay as they are."""
    full = o.ranked(rows, ["k"], "v", ["id"], pieces=4)
    some = o.ranked(rows, ["k"], "v", pieces=4)
    assert "rank_first" not in some.columns
    same(some, full.select(*some.columns))


def test_values_of_both_directions_share_a_cut(rows):
    """`onward` beside running values is what a second, descending pass gives."""
    order = ["t", "id"]
    once = o.running(rows, ["k"], order, {"up": o.running_sum("v")}, onward={"down": o.running_sum("v")}, pieces=5)
    twice = o.running(rows, ["k"], order, {"up": o.running_sum("v")}, pieces=5)
    twice = o.running(twice, ["k"], order, {"down": o.running_sum("v")}, descending=True, pieces=3)
    same(once, twice)


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(3)
    points = [(i, rng.choice("ab"), rng.randint(-50, 50)) for i in range(120)]
    spans = []
    for i in range(60):
        start = rng.randint(-60, 50)
        spans.append((i, rng.choice("ab"), start, start + rng.choice([0, 1, 2, 5, 33, 100])))
    p = spark.createDataFrame(points, "pid int, k string, x int")
    s = spark.createDataFrame(spans, "sid int, k string, lo int, hi int")
    got = {(r.pid, r.sid) for r in joins.interval_join(p, s, "x", "lo", "hi", ["k"]).collect()}
    want = {(a[0], b[0]) for a in points for b in spans if a[1] == b[1] and b[2] <= a[2] < b[3]}
    assert got == want


def test_update_and_combine_first(spark):
    a = spark.createDataFrame([(1, 10, None), (2, None, 5)], "k int, x int, y int")
    b = spark.createDataFrame([(1, 99, 7), (3, 1, 1)], "k int, x int, y int")
    assert sorted(map(tuple, joins.update(a, b, ["k"]).collect())) == [(1, 99, 7), (2, None, 5)]
    assert sorted(map(tuple, joins.combine_first(a, b, ["k"]).collect())) == [(1, 10, 7), (2, None, 5), (3, 1, 1)]


def test_sessions_equal_plain_window(rows):
    from millrace.operators.sessions import sessionize

    got = sessionize(rows, ["k"], "t", ["id"], F.lit(3), block_rows=7)
    w = Window.partitionBy("k").orderBy("t", "id")
    fresh = F.when(F.col("t") - F.lag("t").over(w) < 3, 0).otherwise(1)
    flagged = rows.withColumn("fresh", fresh)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    same(got, flagged.select("id", "k", "t", "v", F.sum("fresh").over(upto).alias("session")))
    cut = sessionize(rows, ["k"], "t", ["id"], F.lit(3), pieces=6)
    same(cut, got)
