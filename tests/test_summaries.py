"""Operators that work on small sums of the rows: panes, sketches, counts of values."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.ranks import rank_correlation
from millrace.operators.sketches import day_sketches, merged, rolled_up
from millrace.streaming.operators import windows_of_panes


@pytest.mark.parametrize("width,slide", [(600, 60), (60, 60), (3600, 60)])
def test_windows_of_panes(spark, width, slide):
    pick = random.Random(width)
    base = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    rows = [(base + dt.timedelta(seconds=pick.randrange(20_000)), pick.choice(["a", "b", None]), pick.randint(-5, 5)) for _ in range(200)]
    want = {}
    for t, key, v in rows:
        first = int(t.timestamp()) // slide * slide
        for start in range(first - width + slide, first + slide, slide):
            n, total = want.get((start, key), (0, 0))
            want[start, key] = (n + 1, total + v)
    df = spark.createDataFrame(rows, "t timestamp, key string, v bigint")
    panes = df.groupBy(F.window("t", f"{slide} seconds").alias("w"), "key").agg(F.count("*").alias("n"), F.sum("v").alias("v")).select("w.start", "key", "n", "v")
    got = windows_of_panes(panes, "start", ["key"], ["n", "v"], width, slide)
    assert {(int(r.start.timestamp()), r.key): (r.n, r.v) for r in got.collect()} == want and got.count() == len(want)
    assert windows_of_panes(panes.limit(0), "start", ["key"], ["n", "v"], width, slide).collect() == []


def test_panes_are_shuffled_not_windows(spark):
    """The rows that meet in a shuffle are two for a pane, at any ratio."""
    panes = spark.range(100).select(F.timestamp_seconds(F.col("id") * 60).alias("start"), F.lit(1).cast("bigint").alias("n"))
    for width in (120, 60 * 1440):
        plan = windows_of_panes(panes, "start", [], ["n"], width, 60)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Generate explode") == 2 and plan.index("sequence") < plan.index("Exchange")  # windows are spread above all shuffles
    with pytest.raises(ValueError, match="multiple"):
        windows_of_panes(panes, "start", [], ["n"], 90, 60)


def test_sketches_roll_up(spark):
    rows = spark.range(200_000).selectExpr("date_add(DATE'2024-01-01', cast(id % 50 as int)) AS d", "cast(id % 3 as string) AS k", "if(id % 97 = 0, null, id % 70001) AS v")
    days = day_sketches(rows, F.col("d"), ["k"], "v", 14)
    by_kind = {r.k: r.users for r in rolled_up(days, ["k"], "users").collect()}
    one_pass = {r.k: r.users for r in rows.groupBy("k").agg(F.hll_sketch_estimate(F.hll_sketch_agg("v", F.lit(14))).alias("users")).collect()}
    exact = {r.k: r.n for r in rows.groupBy("k").agg(F.count_distinct("v").alias("n")).collect()}
    bound = 4 * 1.04 / 2**7
    assert all(abs(x[k] - exact[k]) <= bound * exact[k] for x in (by_kind, one_pass) for k in exact)
    every = rows.agg(F.count_distinct("v")).first()[0]
    for sketches in (days, merged(days, ["day"])):
        assert abs(rolled_up(sketches, [], "users").first().users - every) <= bound * every
    assert rolled_up(days.limit(0), ["k"], "users").collect() == []


def test_rank_correlation(spark):
    pick = random.Random(5)
    rows = [(pick.choice([1.0, 1.0, 1.0, pick.random()]), pick.randint(0, 9)) for _ in range(3000)]
    frame = pd.DataFrame(rows, columns=["a", "b"])
    rows += [(None, 3), (2.0, None)]
    got = rank_correlation(spark.createDataFrame(rows, "a double, b int"), "a", "b").first()
    assert got.n == 3000 and abs(got.rho - frame["a"].rank().corr(frame["b"].rank())) < 1e-9
    same = spark.createDataFrame([(1.0, 2), (1.0, 3)], "a double, b int")
    assert rank_correlation(same, "a", "b").first().rho is None
    assert tuple(rank_correlation(same.limit(0), "a", "b").first()) == (None, 0)
