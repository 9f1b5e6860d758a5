"""Query cases: window functions and frames, sort, top-k, partition layout.

Plain windows are used where a group has a natural bound (lines of an order, turns of
a talk); groups that may hold a large share of the rows go through `operators.ordered`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators import ordered as o
from millrace.plans.registry import Tables, case

# the order of lines inside one order: total, since all columns take part
_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
_LINE_SQL = ", ".join(_LINE_ORDER)


@case("q_window_rank_family", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
       CAST(row_number() OVER w AS INTEGER) AS rn, CAST(rank() OVER q AS INTEGER) AS rk,
       CAST(dense_rank() OVER q AS INTEGER) AS drk, round(percent_rank() OVER q, 6) AS prk,
       round(cume_dist() OVER q, 6) AS cd, CAST(ntile(3) OVER w AS INTEGER) AS tile
FROM lineitem
WINDOW w AS (PARTITION BY l_orderkey ORDER BY {_LINE_SQL}), q AS (PARTITION BY l_orderkey ORDER BY l_linenumber)""")
def window_rank_family(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
    q = Window.partitionBy("l_orderkey").orderBy("l_linenumber")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        F.row_number().over(w).alias("rn"), F.rank().over(q).alias("rk"), F.dense_rank().over(q).alias("drk"),
        F.round(F.percent_rank().over(q), 6).alias("prk"), F.round(F.cume_dist().over(q), 6).alias("cd"),
        F.ntile(3).over(w).alias("tile"),
    )


@case("q_window_lag_lead", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, lag(l_quantity) OVER w AS prev,
       lead(l_quantity, 2, 0.0) OVER w AS next2,
       nth_value(l_quantity, 2) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS second
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY {_LINE_SQL})""")
def window_lag_lead(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        F.lag("l_quantity").over(w).alias("prev"), F.lead("l_quantity", 2, 0.0).over(w).alias("next2"),
        F.nth_value("l_quantity", 2).over(upto).alias("second"),
    )


@case("q_window_rows_frame", f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
       sum(l_quantity) OVER (w ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near,
       max(l_quantity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS top_so_far
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY {_LINE_SQL})""")
def window_rows_frame(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        F.sum("l_quantity").over(w.rowsBetween(-1, 1)).alias("near"),
        F.max("l_quantity").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("top_so_far"),
    )


@case("q_window_range_frame", """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey,
       count(*) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near
FROM lineitem""")
def window_range_frame(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber").rangeBetween(-1, 1)
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", F.count("*").over(w).alias("near"))


@case("q_window_share_of_order", """
SELECT l_orderkey, l_partkey, l_linenumber, l_extendedprice,
       round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey), 6) AS share FROM lineitem""")
def window_share_of_order(t: Tables) -> DataFrame:
    total = F.sum("l_extendedprice").over(Window.partitionBy("l_orderkey"))
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", F.round(F.col("l_extendedprice") / total, 6).alias("share")
    )


# -- windows over groups of any size ------------------------------------------------

_EVENTS_W = "WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"


@case("q_running_by_type", f"""
SELECT event_id, event_type, round(sum(value) OVER (w ROWS UNBOUNDED PRECEDING), 4) AS total,
       count(*) OVER (w ROWS UNBOUNDED PRECEDING) AS n, min(value) OVER (w ROWS UNBOUNDED PRECEDING) AS lo,
       max(value) OVER (w ROWS UNBOUNDED PRECEDING) AS hi, row_number() OVER w AS rn
FROM events {_EVENTS_W}""")
def running_by_type(t: Tables) -> DataFrame:
    out = o.running(t.events, ["event_type"], ["ts", "event_id"], {
        "total": o.running_sum("value"), "n": o.running_count(), "lo": o.running_min("value"),
        "hi": o.running_max("value"), "rn": o.row_number(),
    })
    return out.select("event_id", "event_type", F.round("total", 4).alias("total"), "n", "lo", "hi", "rn")


@case("q_rank_whole_table", """
SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice) AS rk, dense_rank() OVER (ORDER BY o_totalprice) AS drk FROM orders""")
def rank_whole_table(t: Tables) -> DataFrame:
    out = o.ranked(t.orders.select("o_orderkey", "o_totalprice"), [], "o_totalprice")
    return out.select("o_orderkey", F.col("rank_min").alias("rk"), F.col("rank_dense").alias("drk"))


@case("q_relative_rank_by_status", """
SELECT o_orderkey, round(percent_rank() OVER w, 6) AS prk, ntile(10) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) AS tile
FROM orders WINDOW w AS (PARTITION BY o_orderstatus ORDER BY o_totalprice)""")
def relative_rank_by_status(t: Tables) -> DataFrame:
    """Ranks over the whole group from the group's row count."""
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    pos = o.ranked(df, ["o_orderstatus"], "o_totalprice", ["o_orderkey"])
    n, at = F.col("rank_size"), F.col("rank_first")
    small, extra = F.floor(n / 10), n % 10
    edge = extra * (small + 1)
    tile = F.when(at <= edge, F.ceil(at / (small + 1))).otherwise(extra + F.ceil((at - edge) / F.greatest(small, F.lit(1))))
    return pos.select(
        "o_orderkey", F.round((F.col("rank_min") - 1) / F.greatest(n - 1, F.lit(1)), 6).alias("prk"), tile.cast("bigint").alias("tile")
    )


@case("q_shift_by_type", f"""
SELECT event_id, lag(value, 2) OVER w AS back2, lead(value) OVER w AS next1, round(value - lag(value) OVER w, 4) AS diff1
FROM events {_EVENTS_W}""")
def shift_by_type(t: Tables) -> DataFrame:
    out = o.shifted(t.events, ["event_type"], ["ts", "event_id"], {"back2": ("value", 2), "next1": ("value", -1), "b1": ("value", 1)})
    return out.select("event_id", "back2", "next1", F.round(F.col("value") - F.col("b1"), 4).alias("diff1"))


@case("q_price_change_by_customer", """
SELECT o_orderkey, round(o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 2) AS change
FROM orders""")
def price_change_by_customer(t: Tables) -> DataFrame:
    out = o.shifted(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], {"before": ("o_totalprice", 1)})
    return out.select("o_orderkey", F.round(F.col("o_totalprice") - F.col("before"), 2).alias("change"))


@case("q_rolling_by_type", """
SELECT event_id, CASE WHEN count(*) OVER r >= 5 THEN round(avg(value) OVER r, 6) END AS mean5,
       CASE WHEN count(*) OVER r >= 5 THEN max(value) OVER r END AS max5
FROM events WINDOW r AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def rolling_by_type(t: Tables) -> DataFrame:
    out = o.rolling(t.events, ["event_type"], ["ts", "event_id"], 5, {"mean5": F.avg("value"), "max5": F.max("value")})
    return out.select("event_id", F.round("mean5", 6).alias("mean5"), "max5")


@case("q_fill_by_type", f"""
SELECT event_id, last_value(v IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS v_filled,
       last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS v_near
FROM (SELECT *, CASE WHEN value > 60 THEN value END AS v FROM events) {_EVENTS_W}""")
def fill_by_type(t: Tables) -> DataFrame:
    df = t.events.select("event_id", "event_type", "ts", F.when(F.col("value") > 60, F.col("value")).alias("v"))
    keys, order = ["event_type"], ["ts", "event_id"]
    near = o.fill(df, keys, order, ["v"], limit=1, suffix="_near")
    return o.fill(near, keys, order, ["v"]).select("event_id", "v_filled", "v_near")


# -- sort, limit, top-k --------------------------------------------------------------

@case("q_top_orders", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def top_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


def _nulls(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_nationkey")).alias("nat"))


_NULLS = "(SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN c_nationkey END AS nat FROM customer)"


def _add_sort(name: str, key, sql: str) -> None:
    @case(name, f"SELECT c_custkey, nat FROM {_NULLS} ORDER BY {sql}, c_custkey LIMIT 40")
    def build(t: Tables) -> DataFrame:
        return _nulls(t).sort(key(), "c_custkey").limit(40)


_add_sort("q_sort_asc", lambda: F.asc("nat"), "nat ASC NULLS FIRST")
_add_sort("q_sort_desc", lambda: F.col("nat").desc(), "nat DESC NULLS LAST")
_add_sort("q_sort_asc_nulls_first", lambda: F.asc_nulls_first("nat"), "nat ASC NULLS FIRST")
_add_sort("q_sort_asc_nulls_last", lambda: F.col("nat").asc_nulls_last(), "nat ASC NULLS LAST")
_add_sort("q_sort_desc_nulls_first", lambda: F.desc_nulls_first("nat"), "nat DESC NULLS FIRST")
_add_sort("q_sort_desc_nulls_last", lambda: F.col("nat").desc_nulls_last(), "nat DESC NULLS LAST")


@case("q_sort_head_first", "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 1")
def sort_head_first(t: Tables) -> DataFrame:
    """`first`, `head` and `take` are this plan plus a collect of its few rows."""
    return t.orders.select("o_orderkey").orderBy("o_orderkey").limit(1)


@case("q_layout_repartition", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def layout_repartition(t: Tables) -> DataFrame:
    """One explicit hash layout serves the aggregate after it: no second shuffle."""
    spread = t.orders.select("o_orderstatus", "o_custkey", "o_totalprice").repartition(8, "o_custkey")
    parts = spread.groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    return parts.groupBy("o_orderstatus").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))


@case("q_layout_range_partitions", "SELECT count(*) AS n, TRUE AS disjoint, TRUE AS sorted_inside FROM orders")
def layout_range_partitions(t: Tables) -> DataFrame:
    """Range parts do not overlap, and each is sorted inside."""
    ranged = t.orders.select("o_orderkey").repartitionByRange(6, "o_orderkey").sortWithinPartitions("o_orderkey")
    tagged = ranged.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    spans = tagged.groupBy("part").agg(
        F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"), F.count("*").alias("n"),
        (F.min_by("o_orderkey", "at") == F.min("o_orderkey")).alias("starts_low"),
        (F.max_by("o_orderkey", "at") == F.max("o_orderkey")).alias("ends_high"),
    )
    # one row per range part
    before = F.lag("hi").over(Window.orderBy("lo"))
    return spans.withColumn("apart", F.coalesce(before < F.col("lo"), F.lit(True))).agg(
        F.sum("n").alias("n"), F.bool_and("apart").alias("disjoint"),
        F.bool_and(F.col("starts_low") & F.col("ends_high")).alias("sorted_inside"),
    )


@case("q_layout_coalesce", "SELECT count(*) AS n, TRUE AS few FROM lineitem")
def layout_coalesce(t: Tables) -> DataFrame:
    parts = t.lineitem.coalesce(2).select(F.spark_partition_id().alias("p"))
    return parts.agg(F.count("*").alias("n"), (F.count_distinct("p") <= 2).alias("few"))
