"""Query cases: null handling, joins, as-of and interval matching, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import asof_join, combine_first, interval_join, update
from millrace.plans.registry import Tables, case

# -- null handling ------------------------------------------------------------------

_GAPPY = """
WITH gappy AS (
  SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS bal,
         CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS seg,
         CASE WHEN c_custkey % 5 = 0 THEN c_nationkey END AS nat FROM customer)
"""


def gappy(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(
        "c_custkey", F.when(k % 2 == 0, F.col("c_acctbal")).alias("bal"),
        F.when(k % 3 == 0, F.col("c_mktsegment")).alias("seg"), F.when(k % 5 == 0, F.col("c_nationkey")).alias("nat"),
    )


@case("q_dropna_any", _GAPPY + "SELECT * FROM gappy WHERE bal IS NOT NULL AND seg IS NOT NULL AND nat IS NOT NULL")
def dropna_any(t: Tables) -> DataFrame:
    return gappy(t).dropna()


@case("q_dropna_all", _GAPPY + "SELECT * FROM gappy WHERE bal IS NOT NULL OR seg IS NOT NULL")
def dropna_all(t: Tables) -> DataFrame:
    return gappy(t).na.drop(how="all", subset=["bal", "seg"])


@case("q_dropna_thresh", _GAPPY + """
SELECT * FROM gappy WHERE (bal IS NOT NULL)::INT + (seg IS NOT NULL)::INT + (nat IS NOT NULL)::INT >= 2""")
def dropna_thresh(t: Tables) -> DataFrame:
    return gappy(t).dropna(thresh=2, subset=["bal", "seg", "nat"])


@case("q_fillna", _GAPPY + "SELECT c_custkey, coalesce(bal, 0.0) AS bal, coalesce(seg, '?') AS seg, coalesce(nat, -1) AS nat FROM gappy")
def fillna(t: Tables) -> DataFrame:
    return gappy(t).fillna({"bal": 0.0, "seg": "?"}).na.fill(-1, ["nat"])


@case("q_replace_values", """
SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'M' WHEN 'FURNITURE' THEN 'F' ELSE c_mktsegment END AS seg,
       CASE c_nationkey WHEN 1 THEN 100 WHEN 2 THEN 200 ELSE c_nationkey END AS nat FROM customer""")
def replace_values(t: Tables) -> DataFrame:
    df = t.customer.select("c_custkey", F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nat"))
    return df.replace({"MACHINERY": "M", "FURNITURE": "F"}, subset=["seg"]).na.replace([1, 2], [100, 200], "nat")


# -- joins --------------------------------------------------------------------------

_LATE = "SELECT o_orderkey AS k, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01'"


def late(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderdate") >= "2001-01-01").select(F.col("o_orderkey").alias("k"), "o_custkey")


def flagged(t: Tables) -> DataFrame:
    return t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("k"), "l_quantity")


_FLAGGED = "SELECT l_orderkey AS k, l_quantity FROM lineitem WHERE l_returnflag = 'R'"


def _add_how(name: str, how: str, sql: str) -> None:
    @case(name, f"WITH a AS ({_LATE}), b AS ({_FLAGGED}) {sql}")
    def build(t: Tables) -> DataFrame:
        return late(t).join(flagged(t), "k", how)


_add_how("q_join_inner", "inner", "SELECT k, o_custkey, l_quantity FROM a JOIN b USING (k)")
_add_how("q_join_left", "left", "SELECT k, o_custkey, l_quantity FROM a LEFT JOIN b USING (k)")
_add_how("q_join_right", "right", "SELECT k, o_custkey, l_quantity FROM a RIGHT JOIN b USING (k)")
_add_how("q_join_full", "full", "SELECT k, o_custkey, l_quantity FROM a FULL JOIN b USING (k)")
_add_how("q_join_semi", "left_semi", "SELECT k, o_custkey FROM a WHERE k IN (SELECT k FROM b)")
_add_how("q_join_anti", "left_anti", "SELECT k, o_custkey FROM a WHERE k NOT IN (SELECT k FROM b)")


@case("q_join_star_revenue", """
SELECT r_name, strftime(o_orderdate, '%Y') AS yr, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND l_returnflag <> 'R' GROUP BY 1, 2""")
def join_star_revenue(t: Tables) -> DataFrame:
    orders = t.orders.where(F.col("o_orderdate") >= "1996-01-01")
    return (
        t.lineitem.where("l_returnflag <> 'R'").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("r_name", F.date_format("o_orderdate", "yyyy").alias("yr"))
        .agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))
    )


@case("q_join_null_safe", """
WITH a AS (SELECT c_custkey, CASE WHEN c_nationkey > 5 THEN c_nationkey END AS nat FROM customer),
     b AS (SELECT CASE WHEN n_nationkey > 5 THEN n_nationkey END AS nat, min(n_name) AS n_name FROM nation GROUP BY 1)
SELECT c_custkey, n_name FROM a JOIN b ON a.nat IS NOT DISTINCT FROM b.nat""")
def join_null_safe(t: Tables) -> DataFrame:
    a = t.customer.select("c_custkey", F.when(F.col("c_nationkey") > 5, F.col("c_nationkey")).alias("nat"))
    b = t.nation.groupBy(F.when(F.col("n_nationkey") > 5, F.col("n_nationkey")).alias("other")).agg(F.min("n_name").alias("n_name"))
    return a.join(b, F.col("nat").eqNullSafe(F.col("other"))).select("c_custkey", "n_name")


@case("q_join_theta", """
SELECT s_suppkey, n_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey AND s_acctbal > n_nationkey * 200""")
def join_theta(t: Tables) -> DataFrame:
    on = (F.col("s_nationkey") == F.col("n_nationkey")) & (F.col("s_acctbal") > F.col("n_nationkey") * 200)
    return t.supplier.join(t.nation, on).select("s_suppkey", "n_nationkey")


@case("q_cross_join_total", """
SELECT o_orderstatus, count(*) AS n, round(count(*) * 1.0 / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY 1""")
def cross_join_total(t: Tables) -> DataFrame:
    """The product with a one-row frame: each group beside the grand total."""
    total = t.orders.agg(F.count("*").alias("all_rows"))
    parts = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return parts.crossJoin(total).select("o_orderstatus", "n", F.round(F.col("n") / F.col("all_rows"), 6).alias("share"))


@case("q_join_hints", """
SELECT o_orderpriority, count(*) AS n, sum(l_linenumber)::BIGINT AS lines FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def join_hints(t: Tables) -> DataFrame:
    lines = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("c"), F.sum("l_linenumber").alias("s")).hint("merge")
    return t.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderpriority").agg(
        F.sum("c").alias("n"), F.sum("s").alias("lines")
    )


# -- as-of and interval -----------------------------------------------------------

_SIDES = """
WITH buys AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
     views AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view')
"""


def buys(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")


def views(t: Tables) -> DataFrame:
    return t.events.where("event_type = 'view'").select("user_id", "ts", "value")


def _asof_rows(df: DataFrame) -> DataFrame:
    return df.select("event_id", "user_id", F.col("ts_right").alias("seen_at"), "value")


@case("q_asof_backward", _SIDES + """
SELECT event_id, b.user_id, v.ts AS seen_at, value FROM buys b ASOF LEFT JOIN views v ON b.user_id = v.user_id AND b.ts >= v.ts""")
def asof_backward(t: Tables) -> DataFrame:
    return _asof_rows(asof_join(buys(t), views(t), "ts", ["user_id"]))


@case("q_asof_forward", _SIDES + """
SELECT event_id, b.user_id, v.ts AS seen_at, value FROM buys b ASOF LEFT JOIN views v ON b.user_id = v.user_id AND b.ts <= v.ts""")
def asof_forward(t: Tables) -> DataFrame:
    return _asof_rows(asof_join(buys(t), views(t), "ts", ["user_id"], direction="forward"))


@case("q_asof_nearest", _SIDES + """, x AS (
  SELECT event_id, b.user_id, b.ts AS at_, v.ts AS t1, v.value AS v1 FROM buys b ASOF LEFT JOIN views v ON b.user_id = v.user_id AND b.ts >= v.ts),
y AS (SELECT x.*, v.ts AS t2, v.value AS v2 FROM x ASOF LEFT JOIN views v ON x.user_id = v.user_id AND x.at_ <= v.ts)
SELECT event_id, user_id, CASE WHEN t1 IS NULL OR t2 - at_ < at_ - t1 THEN t2 ELSE t1 END AS seen_at,
       CASE WHEN t1 IS NULL OR t2 - at_ < at_ - t1 THEN v2 ELSE v1 END AS value FROM y""")
def asof_nearest(t: Tables) -> DataFrame:
    return _asof_rows(asof_join(buys(t), views(t), "ts", ["user_id"], direction="nearest"))


@case("q_asof_tolerance", _SIDES + """, x AS (
  SELECT event_id, b.user_id, b.ts AS at_, v.ts AS seen_at, value FROM buys b ASOF LEFT JOIN views v ON b.user_id = v.user_id AND b.ts >= v.ts)
SELECT event_id, user_id, seen_at, value FROM x WHERE at_ - seen_at <= INTERVAL 6 HOUR""")
def asof_tolerance(t: Tables) -> DataFrame:
    within = F.expr("INTERVAL '6' HOUR")
    return _asof_rows(asof_join(buys(t), views(t), "ts", ["user_id"], tolerance=within, how="inner"))


@case("q_interval_join", """
WITH spans AS (SELECT event_id AS span_id, user_id, ts AS lo, ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS hi
               FROM events WHERE event_type = 'signup')
SELECT span_id, event_id FROM spans JOIN events USING (user_id)
WHERE event_type = 'click' AND ts >= lo AND ts < hi""")
def interval_join_events(t: Tables) -> DataFrame:
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    clicks = t.events.where("event_type = 'click'").select("event_id", "user_id", micros.alias("at"))
    spans = t.events.where("event_type = 'signup'").select(
        F.col("event_id").alias("span_id"), "user_id", micros.alias("lo"),
        (micros + F.round(F.col("value") * 60000000).cast("bigint")).alias("hi"),
    )
    return interval_join(clicks, spans, "at", "lo", "hi", ["user_id"]).select("span_id", "event_id")


@case("q_update_from", """
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 5 ELSE c_acctbal END AS c_acctbal FROM customer""")
def update_from(t: Tables) -> DataFrame:
    new = t.customer.where("c_custkey % 4 = 0").select("c_custkey", (F.col("c_acctbal") + 5).alias("c_acctbal"))
    return update(t.customer.select("c_custkey", "c_acctbal"), new, ["c_custkey"])


@case("q_combine_first", """
SELECT k, coalesce(a.v, b.v) AS v, b.w FROM (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS v FROM customer) a
FULL JOIN (SELECT s_suppkey * 3 AS k, s_acctbal AS v, s_name AS w FROM supplier) b USING (k)""")
def combine_first_tables(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    left = t.customer.select(k.alias("k"), F.when(k % 2 == 0, F.col("c_acctbal")).alias("v"))
    right = t.supplier.select((F.col("s_suppkey") * 3).alias("k"), F.col("s_acctbal").alias("v"), F.col("s_name").alias("w"))
    return combine_first(left, right, ["k"])


# -- set operations -----------------------------------------------------------------

_SETS = """
WITH a AS (SELECT l_partkey % 50 AS p, l_returnflag AS f FROM lineitem WHERE l_quantity < 10),
     b AS (SELECT l_partkey % 40 AS p, l_returnflag AS f FROM lineitem WHERE l_quantity > 45)
"""


def set_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    def side(cond, n):
        return t.lineitem.where(cond).select((F.col("l_partkey") % n).alias("p"), F.col("l_returnflag").alias("f"))

    return side("l_quantity < 10", 50), side("l_quantity > 45", 40)


def _add_set(name: str, method: str, sql: str) -> None:
    @case(name, f"{_SETS} SELECT p, f FROM a {sql} SELECT p, f FROM b")
    def build(t: Tables) -> DataFrame:
        a, b = set_sides(t)
        return getattr(a, method)(b)


_add_set("q_set_union", "union", "UNION ALL")
_add_set("q_set_union_all", "unionAll", "UNION ALL")
_add_set("q_set_intersect", "intersect", "INTERSECT")
_add_set("q_set_intersect_all", "intersectAll", "INTERSECT ALL")
_add_set("q_set_subtract", "subtract", "EXCEPT")
_add_set("q_set_except_all", "exceptAll", "EXCEPT ALL")


@case("q_set_union_distinct", f"{_SETS} SELECT p, f FROM a UNION SELECT p, f FROM b")
def set_union_distinct(t: Tables) -> DataFrame:
    a, b = set_sides(t)
    return a.union(b).distinct()


@case("q_set_union_by_name", """
SELECT c_custkey AS k, c_acctbal AS bal, c_mktsegment AS seg FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier""")
def set_union_by_name(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    b = t.supplier.select(F.col("s_acctbal").alias("bal"), F.col("s_suppkey").alias("k"))
    return a.unionByName(b, allowMissingColumns=True)
