"""Query cases: the frame, series and group operators of the pandas manner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import numbers as num
from millrace.operators import frames, keys, reshape
from millrace.operators import ordered as o
from millrace.operators.categories import encode
from millrace.operators.joins import asof_join, update
from millrace.operators.sessions import sessionize
from millrace.plans.registry import Tables, case

_ROW = "l_orderkey, l_partkey, l_linenumber, l_suppkey"
_ROW_COLS = ["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]


# -- arithmetic and comparison -------------------------------------------------------

@case("q_frame_arithmetic", """
SELECT c_custkey, CAST(floor(c_acctbal / 7) AS BIGINT) AS fdiv, round(c_acctbal - floor(c_acctbal / 7) * 7, 6) AS pmod, c_acctbal + 1 AS add_, 1 - c_acctbal AS rsub,
       round(1000 / (abs(c_acctbal) + 1), 6) AS rdiv, CAST(floor(100 / (c_custkey + 1)) AS BIGINT) AS rfdiv, CAST(floor(c_custkey / 9) AS BIGINT) AS q, (c_custkey % 9)::DOUBLE AS r
FROM customer""")
def frame_arithmetic(t: Tables) -> DataFrame:
    b, k = F.col("c_acctbal"), F.col("c_custkey")
    q, r = num.divmod_(k, F.lit(9))
    return t.customer.select(
        "c_custkey", num.floordiv(b, F.lit(7)).alias("fdiv"), F.round(num.mod(b, F.lit(7)), 6).alias("pmod"), (b + 1).alias("add_"),
        (1 - b).alias("rsub"), F.round(1000 / (F.abs(b) + 1), 6).alias("rdiv"), num.floordiv(F.lit(100), k + 1).alias("rfdiv"),
        q.alias("q"), r.cast("double").alias("r"),
    )


@case("q_frame_dot", """
SELECT l_returnflag, round(sum(l_quantity * l_discount), 4) AS dot FROM lineitem GROUP BY 1""")
def frame_dot(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.round(F.sum(F.col("l_quantity") * F.col("l_discount")), 4).alias("dot"))


@case("q_frame_equals", "SELECT TRUE AS equal_, FALSE AS differs FROM orders LIMIT 1")
def frame_equals(t: Tables) -> DataFrame:
    a = t.orders.select("o_orderkey", "o_custkey")
    same = frames.equals(a, a.orderBy(F.desc("o_orderkey"))).withColumnRenamed("equal", "equal_")
    other = frames.equals(a, a.where("o_orderkey > 3")).withColumnRenamed("equal", "differs")
    return same.crossJoin(other)  # one row beside one row


@case("q_frame_compare", """
SELECT c_custkey, 'bal' AS "column", CAST(c_acctbal AS VARCHAR) AS self, CAST(CASE WHEN c_custkey % 5 <> 0 THEN -1.0::DOUBLE END AS VARCHAR) AS other
FROM customer WHERE c_custkey % 10 < 6 AND c_custkey % 10 <> 1 AND c_custkey % 10 <> 3 AND c_custkey % 10 <> 7 AND c_custkey % 10 <> 9""")
def frame_compare(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    a = t.customer.select("c_custkey", F.col("c_acctbal").alias("bal"), F.col("c_mktsegment").alias("seg"))
    changed = F.when((k % 10).isin(2, 4), F.lit(-1.0)).when((k % 10).isin(0, 5), F.lit(None)).otherwise(F.col("bal"))
    return frames.compare(a, a.withColumn("bal", changed), ["c_custkey"])


# -- aggregates ------------------------------------------------------------------------

@case("q_frame_moments", """
SELECT round(sum(l_quantity), 2) AS sum_, round(avg(l_quantity), 6) AS mean_, quantile_disc(l_quantity, 0.5) AS median_, min(l_quantity) AS min_, max(l_quantity) AS max_,
       round(stddev(l_quantity), 6) AS std_, round(var_samp(l_quantity), 6) AS var_, round(stddev(l_quantity) / sqrt(count(*)), 6) AS sem_, count(l_quantity) AS count_,
       count(*) AS size_, count(DISTINCT l_quantity) AS nunique_ FROM lineitem""")
def frame_moments(t: Tables) -> DataFrame:
    q = "l_quantity"
    return t.lineitem.agg(
        F.round(F.sum(q), 2).alias("sum_"), F.round(F.mean(q), 6).alias("mean_"), F.percentile_approx(q, 0.5, 10000).alias("median_"),
        F.min(q).alias("min_"), F.max(q).alias("max_"), F.round(F.stddev(q), 6).alias("std_"), F.round(F.variance(q), 6).alias("var_"),
        F.round(F.stddev(q) / F.sqrt(F.count(q)), 6).alias("sem_"), F.count(q).alias("count_"), F.count("*").alias("size_"),
        F.count_distinct(q).alias("nunique_"),
    )


@case("q_frame_mad", """
SELECT l_returnflag, round(avg(abs(l_quantity - m)), 6) AS mad FROM (SELECT *, avg(l_quantity) OVER (PARTITION BY l_returnflag) AS m FROM lineitem) GROUP BY 1""")
def frame_mad(t: Tables) -> DataFrame:
    return frames.mean_abs_deviation(t.lineitem, ["l_returnflag"], "l_quantity").select("l_returnflag", F.round("mad", 6).alias("mad"))


@case("q_frame_extremes", """
SELECT o_orderstatus, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS at_max, arg_min(o_orderkey, (o_totalprice, o_orderkey)) AS at_min, bool_or(o_totalprice > 499000) AS any_,
       bool_and(o_totalprice > 1000) AS all_ FROM orders GROUP BY 1""")
def frame_extremes(t: Tables) -> DataFrame:
    at = F.struct("o_totalprice", "o_orderkey")
    return t.orders.groupBy("o_orderstatus").agg(
        F.max_by("o_orderkey", at).alias("at_max"), F.min_by("o_orderkey", at).alias("at_min"),
        F.bool_or(F.col("o_totalprice") > 499000).alias("any_"), F.bool_and(F.col("o_totalprice") > 1000).alias("all_"),
    )


@case("q_frame_nlargest", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 7")
def frame_nlargest(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(7)


@case("q_frame_tail", "SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 6")
def frame_tail(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey").orderBy(F.desc("o_orderkey")).limit(6)


@case("q_frame_mode", """
WITH c AS (SELECT l_returnflag, l_quantity, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, l_quantity FROM c WHERE n = (SELECT max(n) FROM c d WHERE d.l_returnflag = c.l_returnflag)""")
def frame_mode(t: Tables) -> DataFrame:
    return frames.mode(t.lineitem, ["l_returnflag"], "l_quantity")


@case("q_frame_value_counts", """
SELECT o_orderpriority, round(count(*) * 1.0 / (SELECT count(*) FROM orders), 6) AS share FROM orders GROUP BY 1""")
def frame_value_counts(t: Tables) -> DataFrame:
    return frames.value_counts(t.orders, ["o_orderpriority"], normalize=True).select("o_orderpriority", F.round("share", 6).alias("share"))


@case("q_frame_describe_groups", """
SELECT l_returnflag, count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(stddev(l_quantity), 6) AS std, min(l_quantity) AS lo,
       quantile_disc(l_quantity, 0.25) AS q1, quantile_disc(l_quantity, 0.75) AS q3, max(l_quantity) AS hi FROM lineitem GROUP BY 1""")
def frame_describe_groups(t: Tables) -> DataFrame:
    q = "l_quantity"
    parts = F.percentile_approx(q, [0.25, 0.75], 10000)
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(q).alias("n"), F.round(F.avg(q), 6).alias("mean"), F.round(F.stddev(q), 6).alias("std"), F.min(q).alias("lo"),
        parts[0].alias("q1"), parts[1].alias("q3"), F.max(q).alias("hi"),
    )


# -- ordered -------------------------------------------------------------------------------

_W = "WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)"


@case("q_frame_cumulative", """
SELECT event_id, CASE WHEN v IS NOT NULL THEN round(sum(v) OVER u, 4) END AS cumsum, CASE WHEN v IS NOT NULL THEN max(v) OVER u END AS cummax,
       CASE WHEN v IS NOT NULL THEN min(v) OVER u END AS cummin, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS cumcount
FROM (SELECT *, CASE WHEN event_id % 4 <> 0 THEN value END AS v FROM events)
WINDOW u AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def frame_cumulative(t: Tables) -> DataFrame:
    v = F.when(F.col("event_id") % 4 != 0, F.col("value"))
    df = t.events.select("event_id", "event_type", "ts", v.alias("v"))
    out = o.running(df, ["event_type"], ["ts", "event_id"], {
        "s": o.running_sum("v"), "hi": o.running_max("v"), "lo": o.running_min("v"), "n": o.row_number(),
    })

    def kept(c: Column) -> Column:
        return F.when(F.col("v").isNotNull(), c)

    return out.select(
        "event_id", kept(F.round("s", 4)).alias("cumsum"), kept(F.col("hi")).alias("cummax"), kept(F.col("lo")).alias("cummin"),
        (F.col("n") - 1).alias("cumcount"),
    )


@case("q_frame_cumprod", """
SELECT event_id, round(product(1 + value / 100000) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), 5) AS cumprod FROM events""")
def frame_cumprod(t: Tables) -> DataFrame:
    df = t.events.select("event_id", "event_type", "ts", (1 + F.col("value") / 100000).alias("g"))
    out = o.running(df, ["event_type"], ["ts", "event_id"], {"p": o.running_product("g")})
    return out.select("event_id", F.round("p", 5).alias("cumprod"))


def _ieee_divide(a: Column, b: Column) -> Column:
    """a / b as IEEE 754 doubles give it: a zero divisor yields inf, -inf or NaN, not an error."""
    negative_zero = F.atan2(F.lit(0.0), b) > 0  # -0.0 flips the sign of the infinity
    sign = F.signum(a) * F.when(negative_zero, F.lit(-1.0)).otherwise(F.lit(1.0))
    by_zero = F.when(a.isNaN() | (a == 0), F.lit(float("nan"))).otherwise(sign * F.lit(float("inf")))
    return F.when(b == 0, by_zero).otherwise(a / b)


@case("q_frame_pct_change", f"""
SELECT event_id, round(value / lag(value) OVER w - 1, 6) AS pct, round(value - lag(value, 3) OVER w, 4) AS diff3, lag(value, 1, 0.0) OVER w AS shifted FROM events {_W}""")
def frame_pct_change(t: Tables) -> DataFrame:
    order = ["ts", "event_id"]
    out = o.shifted(t.events, ["event_type"], order, {"b1": ("value", 1), "b3": ("value", 3)})
    v = F.col("value")
    # a value is never null here, so only the first row of a type has nothing before it
    return out.select(
        "event_id", F.round(_ieee_divide(v, F.col("b1")) - 1, 6).alias("pct"), F.round(v - F.col("b3"), 4).alias("diff3"),
        F.coalesce("b1", F.lit(0.0)).alias("shifted"),
    )


@case("q_frame_rank_methods", """
SELECT o_orderkey, count(*) OVER (PARTITION BY o_orderstatus ORDER BY m) AS rank_max, rank() OVER (PARTITION BY o_orderstatus ORDER BY m) AS rank_min,
       row_number() OVER (PARTITION BY o_orderstatus ORDER BY m, o_orderkey) AS rank_first, dense_rank() OVER (PARTITION BY o_orderstatus ORDER BY m) AS rank_dense,
       rank() OVER (PARTITION BY o_orderstatus ORDER BY m) + (count(*) OVER (PARTITION BY o_orderstatus, m) - 1) / 2 AS rank_average
FROM (SELECT *, CAST(floor(o_totalprice / 1000) AS BIGINT) AS m FROM orders)""")
def frame_rank_methods(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_orderstatus", F.floor(F.col("o_totalprice") / 1000).alias("m"))
    return o.ranked(df, ["o_orderstatus"], "m", ["o_orderkey"]).select(
        "o_orderkey", "rank_max", "rank_min", "rank_first", "rank_dense", "rank_average"
    )


@case("q_frame_fill", f"""
SELECT event_id, last_value(v IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING) AS f, first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS b
FROM (SELECT *, CASE WHEN event_id % 4 = 0 THEN value END AS v FROM events) {_W}""")
def frame_fill(t: Tables) -> DataFrame:
    df = t.events.select("event_id", "event_type", "ts", F.when(F.col("event_id") % 4 == 0, F.col("value")).alias("v"))
    keys_, order = ["event_type"], ["ts", "event_id"]
    both = o.fill(o.fill(df, keys_, order, ["v"], suffix="_f"), keys_, order, ["v"], backward=True, suffix="_b")
    return both.select("event_id", F.col("v_f").alias("f"), F.col("v_b").alias("b"))


@case("q_frame_fill_limit", f"""
SELECT event_id, last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS f FROM (SELECT *, CASE WHEN event_id % 6 = 0 THEN value END AS v FROM events) {_W}""")
def frame_fill_limit(t: Tables) -> DataFrame:
    df = t.events.select("event_id", "event_type", "ts", F.when(F.col("event_id") % 6 == 0, F.col("value")).alias("v"))
    return o.fill(df, ["event_type"], ["ts", "event_id"], ["v"], limit=2, suffix="_f").select("event_id", F.col("v_f").alias("f"))


@case("q_frame_rolling", """
SELECT event_id, CASE WHEN count(*) OVER r >= 2 THEN round(sum(value) OVER r, 4) END AS s, CASE WHEN count(*) OVER r >= 2 THEN min(value) OVER r END AS lo,
       CASE WHEN count(*) OVER r >= 2 THEN max(value) OVER r END AS hi, CASE WHEN count(*) OVER r >= 2 THEN round(avg(value) OVER r, 6) END AS mean,
       CASE WHEN count(*) OVER r >= 2 THEN round(stddev(value) OVER r, 7) END AS std, CASE WHEN count(*) OVER r >= 2 THEN round(var_samp(value) OVER r, 7) END AS var,
       CASE WHEN count(*) OVER r >= 2 THEN count(value) OVER r END AS n
FROM events WINDOW r AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def frame_rolling(t: Tables) -> DataFrame:
    v = "value"
    out = o.rolling(t.events, ["event_type"], ["ts", "event_id"], 4, {
        "s": F.sum(v), "lo": F.min(v), "hi": F.max(v), "mean": F.avg(v), "std": F.stddev(v), "var": F.variance(v), "n": F.count(v),
    }, min_periods=2)
    scale = {"s": 4, "mean": 6, "std": 7, "var": 7}
    return out.select("event_id", *[F.round(c, scale[c]).alias(c) if c in scale else F.col(c) for c in ("s", "lo", "hi", "mean", "std", "var", "n")])


@case("q_frame_expanding", """
SELECT event_id, s / n AS mean, CASE WHEN n > 1 THEN round((ss - s * s / n) / (n - 1), 4) END AS var
FROM (SELECT event_id, CAST(sum(d) OVER u AS DOUBLE) AS s, CAST(sum(d * d) OVER u AS DOUBLE) AS ss, count(*) OVER u AS n
      FROM (SELECT *, CAST(value AS DECIMAL(18, 2)) AS d FROM events) WINDOW u AS (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))""")
def frame_expanding(t: Tables) -> DataFrame:
    """Mean and variance from exact running sums, which fold over chunks as the moments do not."""
    d = F.col("value").cast("decimal(18,2)")
    df = t.events.select("event_id", "event_type", "ts", d.alias("d"), (d * d).alias("sq"))
    out = o.running(df, ["event_type"], ["ts", "event_id"], {"n": o.running_count("d"), "s": o.running_sum("d"), "ss": o.running_sum("sq")})
    n, s, ss = F.col("n"), F.col("s").cast("double"), F.col("ss").cast("double")
    return out.select("event_id", (s / n).alias("mean"), F.when(n > 1, F.round((ss - s * s / n) / (n - 1), 4)).alias("var"))


@case("q_frame_valid_index", """
SELECT event_type, min(event_id) FILTER (value > 100) AS first_valid, max(event_id) FILTER (value > 100) AS last_valid FROM events GROUP BY 1""")
def frame_valid_index(t: Tables) -> DataFrame:
    valid = F.when(F.col("value") > 100, F.col("event_id"))
    return t.events.groupBy("event_type").agg(F.min_by("event_id", valid).alias("first_valid"), F.max_by("event_id", valid).alias("last_valid"))


@case("q_frame_monotonic", "SELECT TRUE AS by_key, FALSE AS by_price FROM orders LIMIT 1")
def frame_monotonic(t: Tables) -> DataFrame:
    a = frames.is_monotonic(t.orders, "o_orderkey", ["o_orderkey"]).withColumnRenamed("monotonic", "by_key")
    b = frames.is_monotonic(t.orders, "o_totalprice", ["o_orderkey"]).withColumnRenamed("monotonic", "by_price")
    return a.crossJoin(b)  # one row beside one row


@case("q_frame_asof_label", """
SELECT o_orderkey, e.event_id FROM (SELECT o_orderkey, TIMESTAMP '2024-01-01' + to_seconds(CAST(o_orderkey % 2592000 AS BIGINT) * 170) AS at_ FROM orders) o
ASOF LEFT JOIN (SELECT ts, event_id FROM events WHERE value > 50) e ON o.at_ >= e.ts""")
def frame_asof_label(t: Tables) -> DataFrame:
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), ((F.col("o_orderkey") % 2592000) * 170).cast("decimal(18,6)")
    )
    labels = t.orders.select("o_orderkey", at.alias("at_"))
    seen = t.events.where("value > 50").select(F.col("ts").alias("at_"), "event_id")
    return asof_join(labels, seen, "at_").select("o_orderkey", "event_id")


# -- reshape -------------------------------------------------------------------------------

@case("q_reshape_melt", """
SELECT s_suppkey, 'nation' AS variable, CAST(s_nationkey AS DOUBLE) AS value FROM supplier UNION ALL SELECT s_suppkey, 'balance', CASE WHEN s_acctbal > 0 THEN s_acctbal END FROM supplier""")
def reshape_melt(t: Tables) -> DataFrame:
    df = t.supplier.select("s_suppkey", F.col("s_nationkey").cast("double").alias("nation"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("balance"))
    return reshape.melt(df, ["s_suppkey"], ["nation", "balance"])


@case("q_reshape_stack", """
SELECT s_suppkey, 'nation' AS level, CAST(s_nationkey AS DOUBLE) AS value FROM supplier UNION ALL SELECT s_suppkey, 'balance', s_acctbal FROM supplier WHERE s_acctbal > 0""")
def reshape_stack(t: Tables) -> DataFrame:
    df = t.supplier.select("s_suppkey", F.col("s_nationkey").cast("double").alias("nation"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("balance"))
    return reshape.stack(df, ["s_suppkey"], ["nation", "balance"])


@case("q_reshape_pivot_table", """
SELECT o_custkey, round(coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 0), 2) AS F, round(coalesce(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 0), 2) AS O FROM orders
GROUP BY 1""")
def reshape_pivot_table(t: Tables) -> DataFrame:
    return reshape.pivot_table(t.orders, ["o_custkey"], "o_orderstatus", ["F", "O"], F.round(F.sum("o_totalprice"), 2), fill=0.0)


@case("q_reshape_unstack", """
SELECT conv_id, max(text) FILTER (turn = 0) AS t0, max(text) FILTER (turn = 1) AS t1 FROM conversations GROUP BY 1""")
def reshape_unstack(t: Tables) -> DataFrame:
    return reshape.pivot_table(t.conversations, ["conv_id"], "turn", [0, 1], F.max("text")).toDF("conv_id", "t0", "t1")


@case("q_reshape_dummies", """
SELECT o_orderkey, (o_orderstatus = 'F')::INTEGER AS st_F, (o_orderstatus = 'O')::INTEGER AS st_O, (o_orderstatus = 'P')::INTEGER AS st_P FROM orders""")
def reshape_dummies(t: Tables) -> DataFrame:
    return reshape.dummies(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["F", "O", "P"], prefix="st")


@case("q_reshape_transpose", """
SELECT 'n' AS key, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders
UNION ALL SELECT 'c', count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F'), count(DISTINCT o_custkey) FILTER (o_orderstatus = 'O'), count(DISTINCT o_custkey) FILTER (o_orderstatus = 'P') FROM orders""")
def reshape_transpose(t: Tables) -> DataFrame:
    small = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("c"))
    return reshape.transpose(small, "o_orderstatus")


# -- select and edit --------------------------------------------------------------------------

@case("q_frame_where_mask", """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0.0 END AS kept, CASE WHEN c_acctbal > 0 THEN NULL ELSE c_acctbal END AS masked,
       least(greatest(c_acctbal, 100.0), 5000.0) AS clipped FROM customer""")
def frame_where_mask(t: Tables) -> DataFrame:
    b = F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.when(b > 0, b).otherwise(0.0).alias("kept"), F.when(~(b > 0), b).alias("masked"), num.clip(b, 100.0, 5000.0).alias("clipped")
    )


@case("q_frame_query_filter", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_custkey > 40 AND o_orderstatus <> 'F'")
def frame_query_filter(t: Tables) -> DataFrame:
    df = t.orders.where("o_custkey > 40 AND o_orderstatus <> 'F'")
    return df.select(*[c for c in df.columns if c.startswith("o_order") and c not in ("o_orderdate", "o_orderstatus")])


@case("q_frame_select_dtypes", "SELECT s_acctbal FROM supplier")
def frame_select_dtypes(t: Tables) -> DataFrame:
    return t.supplier.select(*[c for c, kind in t.supplier.dtypes if kind == "double"])


@case("q_frame_duplicated", """
SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) > 1 AS dup_first,
       row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey DESC) > 1 AS dup_last, count(*) OVER (PARTITION BY o_custkey, o_orderpriority) > 1 AS dup_any FROM orders""")
def frame_duplicated(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    subset = ["o_custkey", "o_orderpriority"]
    for keep, name in (("first", "dup_first"), ("last", "dup_last"), (False, "dup_any")):
        df = frames.duplicated(df, subset, ["o_orderkey"], keep, name)
    return df.drop(*subset)


@case("q_frame_reindex", """
SELECT day, coalesce(n, 0) AS n FROM (SELECT strftime(unnest(generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-05', INTERVAL 1 DAY)), '%Y-%m-%d') AS day) d
LEFT JOIN (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) e USING (day)""")
def frame_reindex(t: Tables) -> DataFrame:
    daily = t.events.where("event_type = 'error'").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("n"))
    span = F.sequence(F.lit("2023-12-30").cast("date"), F.lit("2024-02-05").cast("date"))
    labels = t.spark.range(1).select(F.explode(span.cast("array<string>")).alias("day"))
    return frames.reindex(daily, labels, ["day"], fill_value=0)


@case("q_frame_date_range", """
SELECT event_type, strftime(unnest(generate_series(date_trunc('week', min(ts)), max(ts), INTERVAL 7 DAY)), '%Y-%m-%d') AS week FROM events GROUP BY 1""")
def frame_date_range(t: Tables) -> DataFrame:
    spans = t.events.groupBy("event_type").agg(F.to_date(F.date_trunc("week", F.min("ts"))).alias("lo"), F.to_date(F.max("ts")).alias("hi"))
    weeks = F.sequence("lo", "hi", F.expr("INTERVAL 7 DAYS"))
    return spans.select("event_type", F.explode(weeks.cast("array<string>")).alias("week"))


@case("q_frame_truncate_loc", """
SELECT o_orderkey, o_totalprice, position FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders)
WHERE (position >= 5 AND position < 15) OR o_orderkey IN (77, 78)""")
def frame_truncate_loc(t: Tables) -> DataFrame:
    placed = o.global_position(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    p = F.col("position")
    return placed.where(((p >= 5) & (p < 15)) | F.col("o_orderkey").isin(77, 78))


@case("q_frame_to_datetime", """
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS parsed, CASE WHEN event_id % 2 = 0 THEN value END AS number, event_id * 3600 AS seconds FROM events""")
def frame_to_datetime(t: Tables) -> DataFrame:
    text = F.when(F.col("event_id") % 3 == 0, F.lit("none")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    maybe = F.when(F.col("event_id") % 2 == 0, F.col("value").cast("string")).otherwise(F.lit("x1"))
    # days and hours apart, so that ids past the int range still fit; sums in bigint, as the days alone pass it
    hours = F.col("event_id")
    span = num.to_timedelta((hours.cast("decimal(20,0)") / 24).cast("int"), "DAY") + num.to_timedelta((hours % 24).cast("int"), "HOUR")
    whole = F.extract(F.lit("DAY"), span).cast("bigint") * 86400 + F.extract(F.lit("HOUR"), span).cast("bigint") * 3600
    return t.events.select(
        "event_id", F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd HH:mm:ss").alias("parsed"), num.to_numeric(maybe).alias("number"),
        whole.cast("bigint").alias("seconds"),
    )


@case("q_frame_map_values", "SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 1 WHEN 'LARGE' THEN 3 END AS size_class FROM part")
def frame_map_values(t: Tables) -> DataFrame:
    lookup = F.create_map(F.lit("SMALL"), F.lit(1), F.lit("LARGE"), F.lit(3))
    return t.part.select("p_partkey", F.try_element_at(lookup, "p_type").alias("size_class"))


@case("q_frame_repeat", "SELECT s_suppkey, count(*) AS n FROM supplier, range(3) GROUP BY 1")
def frame_repeat(t: Tables) -> DataFrame:
    return keys.repeat(t.supplier.select("s_suppkey"), 3).groupBy("s_suppkey").agg(F.count("*").alias("n"))


@case("q_frame_align_append", """
SELECT k, a.v AS v_left, b.v AS v_right FROM (SELECT c_custkey AS k, c_acctbal AS v FROM customer WHERE c_custkey % 2 = 0) a
FULL JOIN (SELECT c_custkey AS k, c_acctbal * 2 AS v FROM customer WHERE c_custkey % 3 = 0) b USING (k)""")
def frame_align_append(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    a = t.customer.where(k % 2 == 0).select(k.alias("k"), F.col("c_acctbal").alias("v"))
    b = t.customer.where(k % 3 == 0).select(k.alias("k"), (F.col("c_acctbal") * 2).alias("v"))
    return frames.align(a, b, ["k"])


@case("q_frame_merge_suffixes", """
SELECT o_orderkey AS key, o_totalprice AS price_x, l.price AS price_y FROM orders JOIN (SELECT l_orderkey, max(l_extendedprice) AS price FROM lineitem GROUP BY 1) l ON o_orderkey = l_orderkey""")
def frame_merge_suffixes(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("key")).agg(F.max("l_extendedprice").alias("price"))
    return frames.align(a, b, ["key"], "inner").toDF("key", "price_x", "price_y")


@case("q_frame_update_overwrite_off", """
SELECT c_custkey, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END, CASE WHEN c_custkey % 3 = 0 THEN 1.0 END) AS v FROM customer""")
def frame_update_overwrite_off(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    a = t.customer.select("c_custkey", F.when(k % 2 == 0, F.col("c_acctbal")).alias("v"))
    b = t.customer.where(k % 3 == 0).select("c_custkey", F.lit(1.0).alias("v"))
    return update(a, b, ["c_custkey"], keep_left=True)


@case("q_frame_first_last_period", """
SELECT event_id, ts < (SELECT min(ts) FROM events) + INTERVAL 3 DAY AS early FROM events
WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 3 DAY OR ts > (SELECT max(ts) FROM events) - INTERVAL 2 DAY""")
def frame_first_last_period(t: Tables) -> DataFrame:
    early = frames.first_period(t.events, "ts", "3 DAYS").select("event_id", F.lit(True).alias("early"))
    return early.unionByName(frames.first_period(t.events, "ts", "2 DAYS", last=True).select("event_id", F.lit(False).alias("early")))


@case("q_frame_argsort", "SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal, s_suppkey) - 1 AS place FROM supplier")
def frame_argsort(t: Tables) -> DataFrame:
    return o.global_position(t.supplier.select("s_suppkey", "s_acctbal"), ["s_acctbal", "s_suppkey"], "place").drop("s_acctbal")


@case("q_frame_rename_prefix", "SELECT doc_id AS x_doc_id, quality AS x_quality, toxic AS x_toxic FROM labels")
def frame_rename_prefix(t: Tables) -> DataFrame:
    return t.labels.withColumnsRenamed({c: f"x_{c}" for c in t.labels.columns})


@case("q_frame_sessions", """
WITH gaps AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM gaps)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS n, min(ts) AS start_, max(ts) AS end_ FROM numbered GROUP BY 1, 2""")
def frame_sessions(t: Tables) -> DataFrame:
    rows = sessionize(t.events.select("user_id", "ts", "event_id"), ["user_id"], "ts", ["event_id"], F.expr("INTERVAL '4' HOUR"))
    return rows.groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("ts").alias("start_"), F.max("ts").alias("end_"))


# -- groups ----------------------------------------------------------------------------------

@case("q_grouped_head_tail", """
SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn <= 2""")
def grouped_head_tail(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return frames.top_rows(rows, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 2).drop("o_orderdate")


@case("q_grouped_nlargest", """
SELECT l_returnflag, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS rn FROM lineitem) WHERE rn <= 10""")
def grouped_nlargest(t: Tables) -> DataFrame:
    return frames.top_rows(t.lineitem.select("l_returnflag", "l_extendedprice"), ["l_returnflag"], [F.desc("l_extendedprice")], 10)


@case("q_grouped_filter", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 12 AND avg(o_totalprice) > 250000)""")
def grouped_filter(t: Tables) -> DataFrame:
    big = (F.count("*") > 12) & (F.avg("o_totalprice") > 250000)
    return frames.filter_groups(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), ["o_custkey"], big).drop("o_totalprice")


@case("q_grouped_transform", """
SELECT o_orderkey, round(o_totalprice - avg(o_totalprice) OVER (PARTITION BY o_orderstatus), 4) AS centred FROM orders""")
def grouped_transform(t: Tables) -> DataFrame:
    df = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    out = frames.transform_groups(df, ["o_orderstatus"], {"mean": F.avg("o_totalprice")})
    return out.select("o_orderkey", F.round(F.col("o_totalprice") - F.col("mean"), 4).alias("centred"))


@case("q_grouped_value_lists", "SELECT DISTINCT user_id, event_type FROM events")
def grouped_value_lists(t: Tables) -> DataFrame:
    """The unique values per group as rows: a group's list may be long, a row is not."""
    return t.events.select("user_id", "event_type").distinct()


@case("q_grouped_value_counts", "SELECT user_id, event_type, count(*) AS count FROM events GROUP BY 1, 2")
def grouped_value_counts(t: Tables) -> DataFrame:
    return frames.value_counts(t.events, ["user_id", "event_type"])


# -- keys ------------------------------------------------------------------------------------

_KEYS = "WITH a AS (SELECT c_custkey * 2 AS k FROM customer), b AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey < 2000) "


def _key_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    return t.customer.select((F.col("c_custkey") * 2).alias("k")), t.orders.where("o_orderkey < 2000").select(F.col("o_orderkey").alias("k"))


def _add_keys(name: str, operator, sql: str) -> None:
    @case(name, _KEYS + sql)
    def build(t: Tables) -> DataFrame:
        return operator(*_key_sides(t))


_add_keys("q_keys_union", keys.union, "SELECT k FROM a UNION SELECT k FROM b")
_add_keys("q_keys_intersection", keys.intersection, "SELECT k FROM a INTERSECT SELECT k FROM b")
_add_keys("q_keys_difference", keys.difference, "SELECT k FROM a EXCEPT SELECT k FROM b")
_add_keys("q_keys_symmetric_difference", keys.symmetric_difference,
          "(SELECT k FROM a EXCEPT SELECT k FROM b) UNION (SELECT k FROM b EXCEPT SELECT k FROM a)")


@case("q_keys_unique", "SELECT TRUE AS by_order, FALSE AS by_customer FROM orders LIMIT 1")
def keys_unique(t: Tables) -> DataFrame:
    a = keys.is_unique(t.orders, ["o_orderkey"]).withColumnRenamed("unique", "by_order")
    b = keys.is_unique(t.orders, ["o_custkey"]).withColumnRenamed("unique", "by_customer")
    return a.crossJoin(b)  # one row beside one row


@case("q_keys_product", "SELECT DISTINCT o_custkey, unnest(['F', 'O', 'P']) AS status FROM orders")
def keys_product(t: Tables) -> DataFrame:
    return keys.from_product(t.orders, "o_custkey", ["F", "O", "P"], "status")


@case("q_keys_swap_levels", "SELECT o_orderkey AS o_custkey, o_custkey AS o_orderkey FROM orders")
def keys_swap_levels(t: Tables) -> DataFrame:
    return keys.swap_levels(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey", "o_custkey").toDF("o_orderkey", "o_custkey")


@case("q_keys_levels", "SELECT count(DISTINCT o_custkey) AS customers, count(DISTINCT o_orderpriority) AS priorities FROM orders")
def keys_levels(t: Tables) -> DataFrame:
    """Sizes of the levels of a composite key."""
    return t.orders.agg(F.count_distinct("o_custkey").alias("customers"), F.count_distinct("o_orderpriority").alias("priorities"))


@case("q_keys_edit", """
SELECT o_orderkey AS k, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, 'X' FROM orders WHERE o_totalprice > 490000""")
def keys_edit(t: Tables) -> DataFrame:
    """Keys dropped by label and others inserted."""
    base = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
    added = t.orders.where("o_totalprice > 490000").select(F.col("o_orderkey").alias("k"), F.lit("X").alias("status"))
    return base.where(F.col("status") != "P").unionByName(added)


@case("q_keys_factorize", """
SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS code FROM part""")
def keys_factorize(t: Tables) -> DataFrame:
    return frames.factorize(t.part.select("p_partkey", "p_name"), "p_name").select("p_partkey", "code")


@case("q_keys_row_ids", "SELECT count(*) AS n, count(*) AS ids, count(*) - 1 AS top FROM lineitem")
def keys_row_ids(t: Tables) -> DataFrame:
    order = ["l_extendedprice", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_quantity"]
    placed = frames.attach_id(t.lineitem.select(*order), order)
    return placed.agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.max("id").alias("top"))


@case("q_category_codes", """
SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LARGE' THEN 2 ELSE -1 END AS code,
       CASE p_type WHEN 'SMALL' THEN 'S' WHEN 'MEDIUM' THEN 'M' WHEN 'LARGE' THEN 'L' END AS renamed, CASE WHEN p_type IN ('SMALL', 'LARGE') THEN p_type END AS reset
FROM part""")
def category_codes(t: Tables) -> DataFrame:
    names = ["SMALL", "MEDIUM", "LARGE"]
    code = num.codes(F.col("p_type"), names)
    return t.part.select(
        "p_partkey", code.alias("code"), F.when(code >= 0, num.of_code(code, ["S", "M", "L"])).alias("renamed"),
        num.set_categories(F.col("p_type"), ["SMALL", "LARGE"]).alias("reset"),
    )


@case("q_category_unused", "SELECT 'GIANT' AS category, 0::BIGINT AS n FROM part LIMIT 1")
def category_unused(t: Tables) -> DataFrame:
    """Given categories that no row uses: the counts decide, in one aggregate."""
    listed = ["SMALL", "MEDIUM", "LARGE", "GIANT"]
    counts = t.part.agg(*[F.count_if(F.col("p_type") == v).alias(v) for v in listed])
    return reshape.melt(counts, [], listed, "category", "n").where("n = 0")


@case("q_category_edits", """
WITH e AS (SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 'TINY' WHEN 'LARGE' THEN 'LARGE' END AS p_type FROM part)
SELECT p_partkey, p_type, CASE p_type WHEN 'LARGE' THEN 0 WHEN 'TINY' THEN 1 END AS place, p_type = 'TINY' AS at_least_tiny FROM e""")
def category_edits(t: Tables) -> DataFrame:
    """Levels added, removed, renamed, reordered and compared; the rows keep their codes."""
    sizes = encode(t.part.select("p_partkey", "p_type"), "p_type", ["SMALL", "MEDIUM", "LARGE"], ordered=True)
    sizes = sizes.add(["GIANT"]).remove(["MEDIUM"]).rename({"SMALL": "TINY"}).reorder(["LARGE", "TINY", "GIANT"])
    return sizes.decoded("place").withColumn("at_least_tiny", F.col("place") >= sizes.place_of("TINY"))
