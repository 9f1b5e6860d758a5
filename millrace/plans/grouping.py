"""Query cases: grouping, aggregates, frame statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.sketches import day_sketches, rolled_up
from millrace.plans.registry import Tables, case
from millrace.sources.scratch import scratch


@case("q_group_pricing_summary", """
SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc,
       round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 4) AS sum_charge,
       round(avg(l_quantity), 6) AS avg_qty, round(avg(l_discount), 6) AS avg_disc, count(*) AS n
FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY 1, 2""")
def group_pricing_summary(t: Tables) -> DataFrame:
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return t.lineitem.where(F.col("l_shipdate") <= "2001-09-02").groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base"),
        F.round(F.sum(net), 4).alias("sum_disc"), F.round(F.sum(net * (1 + F.col("l_tax"))), 4).alias("sum_charge"),
        F.round(F.avg("l_quantity"), 6).alias("avg_qty"), F.round(F.avg("l_discount"), 6).alias("avg_disc"),
        F.count("*").alias("n"),
    )


@case("q_group_shortcuts", """
SELECT o_orderstatus, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price, round(avg(o_totalprice), 4) AS avg_price, max(o_totalprice) AS max_price,
       min(o_totalprice) AS min_price, round(sum(o_totalprice), 2) AS sum_price FROM orders GROUP BY 1""")
def group_shortcuts(t: Tables) -> DataFrame:
    def part(method: str, name: str) -> DataFrame:
        return getattr(t.orders.groupby("o_orderstatus"), method)("o_totalprice").toDF("o_orderstatus", name)

    out = t.orders.groupBy("o_orderstatus").count().withColumnRenamed("count", "n")
    for method in ("mean", "avg", "max", "min", "sum"):
        out = out.join(part(method, f"{method}_price"), "o_orderstatus")
    rounded = {"mean_price": 4, "avg_price": 4, "sum_price": 2}
    return out.select(*[F.round(c, rounded[c]).alias(c) if c in rounded else F.col(c) for c in out.columns])


@case("q_agg_frame_dict", "SELECT count(*) AS n, max(o_totalprice) AS top, min(o_custkey) AS first_cust FROM orders")
def agg_frame_dict(t: Tables) -> DataFrame:
    return t.orders.agg({"*": "count", "o_totalprice": "max", "o_custkey": "min"}).select(
        F.col("count(1)").alias("n"), F.col("max(o_totalprice)").alias("top"), F.col("min(o_custkey)").alias("first_cust")
    )


@case("q_rollup", """
SELECT l_returnflag, l_linestatus, count(*) AS n, grouping(l_returnflag)::TINYINT AS g1, grouping(l_linestatus)::TINYINT AS g2,
       grouping_id(l_returnflag, l_linestatus)::BIGINT AS gid
FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup(t: Tables) -> DataFrame:
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.grouping("l_returnflag").alias("g1"), F.grouping("l_linestatus").alias("g2"),
        F.grouping_id().alias("gid"),
    )


@case("q_cube", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def cube(t: Tables) -> DataFrame:
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@case("q_frame_count", "SELECT count(*) AS n FROM lineitem WHERE l_quantity > 25")
def frame_count(t: Tables) -> DataFrame:
    return t.lineitem.where("l_quantity > 25").groupBy().count().withColumnRenamed("count", "n")


@case("q_distinct_rows", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def distinct_rows(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@case("q_drop_duplicates_subset", "SELECT o_custkey, o_orderpriority FROM orders GROUP BY ALL")
def drop_duplicates_subset(t: Tables) -> DataFrame:
    return t.orders.drop_duplicates(["o_custkey", "o_orderpriority"]).select("o_custkey", "o_orderpriority")


@case("q_pivot", """
SELECT o_orderpriority, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS F,
       round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS O, round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS P
FROM orders GROUP BY 1""")
def pivot(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.round(F.sum("o_totalprice"), 2))


@case("q_agg_basic", """
SELECT l_returnflag, count(m) AS n, sum(m) AS total, round(avg(m), 6) AS mean, max(m) AS hi, min(m) AS lo,
       max_by(l_linestatus, l_extendedprice) AS at_max, min_by(l_linestatus, l_extendedprice) AS at_min
FROM (SELECT *, CASE WHEN l_quantity > 10 THEN l_quantity END AS m FROM lineitem) GROUP BY 1""")
def agg_basic(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("m", F.when(F.col("l_quantity") > 10, F.col("l_quantity")))
    return df.groupBy("l_returnflag").agg(
        F.count("m").alias("n"), F.sum("m").alias("total"), F.round(F.mean("m"), 6).alias("mean"), F.max("m").alias("hi"),
        F.min("m").alias("lo"), F.max_by("l_linestatus", "l_extendedprice").alias("at_max"),
        F.min_by("l_linestatus", "l_extendedprice").alias("at_min"),
    )


@case("q_agg_product", """
SELECT l_orderkey, product(l_linenumber) AS prod FROM lineitem GROUP BY 1""")
def agg_product(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.product("l_linenumber").alias("prod"))


@case("q_agg_distinct", """
SELECT o_orderstatus, sum(DISTINCT o_custkey)::BIGINT AS sum_d, count(DISTINCT o_custkey) AS n_d,
       count(DISTINCT (o_custkey, o_orderpriority)) AS n_pairs FROM orders GROUP BY 1""")
def agg_distinct(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_orderstatus").agg(
        F.sum_distinct("o_custkey").alias("sum_d"), F.count_distinct("o_custkey").alias("n_d"),
        F.countDistinct("o_custkey", "o_orderpriority").alias("n_pairs"),
    )


@case("q_agg_moments", """
SELECT l_linestatus, round(stddev(l_quantity), 6) AS sd, round(stddev_samp(l_quantity), 6) AS sd_s, round(stddev_pop(l_quantity), 6) AS sd_p,
       round(variance(l_quantity), 6) AS var, round(var_samp(l_quantity), 6) AS var_s, round(var_pop(l_quantity), 6) AS var_p
FROM lineitem GROUP BY 1""")
def agg_moments(t: Tables) -> DataFrame:
    names = {"sd": F.stddev, "sd_s": F.stddev_samp, "sd_p": F.stddev_pop, "var": F.variance, "var_s": F.var_samp, "var_p": F.var_pop}
    return t.lineitem.groupBy("l_linestatus").agg(*[F.round(f("l_quantity"), 6).alias(n) for n, f in names.items()])


@case("q_agg_shape", """
SELECT l_returnflag, round(avg(pow(x - m, 3)) / pow(avg(pow(x - m, 2)), 1.5), 6) AS skew,
       round(avg(pow(x - m, 4)) / pow(avg(pow(x - m, 2)), 2) - 3, 6) AS kurt
FROM (SELECT l_returnflag, l_extendedprice AS x, avg(l_extendedprice) OVER (PARTITION BY l_returnflag) AS m FROM lineitem) GROUP BY 1""")
def agg_shape(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.skewness("l_extendedprice"), 6).alias("skew"), F.round(F.kurtosis("l_extendedprice"), 6).alias("kurt")
    )


@case("q_agg_pairs", """
SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r, round(covar_pop(l_quantity, l_extendedprice), 3) AS cov_p,
       round(covar_samp(l_quantity, l_extendedprice), 3) AS cov_s FROM lineitem GROUP BY 1""")
def agg_pairs(t: Tables) -> DataFrame:
    pair = ("l_quantity", "l_extendedprice")
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.corr(*pair), 6).alias("r"), F.round(F.covar_pop(*pair), 3).alias("cov_p"),
        F.round(F.covar_samp(*pair), 3).alias("cov_s"),
    )


@case("q_agg_first_last", """
SELECT conv_id, first(text ORDER BY turn) AS opening, last(text ORDER BY turn) AS closing FROM conversations GROUP BY 1""")
def agg_first_last(t: Tables) -> DataFrame:
    """`first` and `last` have no order of their own; the key makes them certain."""
    return t.conversations.groupBy("conv_id").agg(
        F.min_by("text", "turn").alias("opening"), F.max_by("text", "turn").alias("closing")
    )


@case("q_agg_first_last_unordered", "SELECT l_returnflag, 1::BIGINT AS kinds_first, 1::BIGINT AS kinds_last FROM lineitem GROUP BY 1")
def agg_first_last_unordered(t: Tables) -> DataFrame:
    df = t.lineitem.withColumn("same", F.when(F.col("l_linenumber") > 2, F.col("l_returnflag")))
    out = df.groupBy("l_returnflag").agg(
        F.first("same", ignorenulls=True).alias("a"), F.last("same", ignorenulls=True).alias("b")
    )
    return out.groupBy("l_returnflag").agg(
        F.count_if(F.col("a") == F.col("l_returnflag")).alias("kinds_first"),
        F.count_if(F.col("b") == F.col("l_returnflag")).alias("kinds_last"),
    )


@case("q_agg_collect", """
SELECT l_orderkey, array_to_string(list_sort(list(l_linenumber)), ',') AS lines,
       array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS flags FROM lineitem GROUP BY 1""")
def agg_collect(t: Tables) -> DataFrame:
    """Lists per order: a group is the lines of one order, so it stays small."""
    return t.lineitem.groupBy("l_orderkey").agg(
        F.array_join(F.sort_array(F.collect_list("l_linenumber")), ",").alias("lines"),
        F.array_join(F.sort_array(F.collect_set("l_returnflag")), ",").alias("flags"),
    )


@case("q_agg_approx_distinct", "SELECT l_returnflag, TRUE AS near, TRUE AS near_tight FROM lineitem GROUP BY 1")
def agg_approx_distinct(t: Tables) -> DataFrame:
    exact = F.count_distinct("l_partkey")

    def near(rsd):
        return (F.abs(F.approx_count_distinct("l_partkey", rsd) - exact) <= 4 * rsd * exact)

    return t.lineitem.groupBy("l_returnflag").agg(near(0.05).alias("near"), near(0.02).alias("near_tight"))


@case("q_agg_sketch_rollup", "SELECT CAST(month(ts) AS INTEGER) AS month, event_type, count(DISTINCT user_id) AS users FROM events GROUP BY ALL UNION ALL SELECT CAST(month(ts) AS INTEGER), NULL, count(DISTINCT user_id) FROM events GROUP BY ALL")
def agg_sketch_rollup(t: Tables) -> DataFrame:
    """Sketches of each day, kept as a table, rolled up by month and over all kinds: no user is counted again.

    A sketch of 2^16 cells is exact up to some thousand users, so the estimates are the counts here.
    """
    path = scratch(t.spark, "sketches")
    day_sketches(t.events, F.to_date("ts"), ["event_type"], "user_id").write.parquet(path)
    days = t.spark.read.parquet(path).withColumn("month", F.month("day"))
    return rolled_up(days, ["month", "event_type"], "users").unionByName(rolled_up(days, ["month"], "users").withColumn("event_type", F.lit(None).cast("string")))


@case("q_agg_percentile_approx", """
SELECT l_returnflag, quantile_disc(l_quantity, 0.5) AS p50, quantile_disc(l_quantity, 0.9) AS p90 FROM lineitem GROUP BY 1""")
def agg_percentile_approx(t: Tables) -> DataFrame:
    """Fifty values and an accuracy far above that: the estimate is exact here."""
    both = F.percentile_approx("l_quantity", [0.5, 0.9], 10000)
    return t.lineitem.groupBy("l_returnflag").agg(both[0].alias("p50"), both[1].alias("p90"))


# -- frame statistics -----------------------------------------------------------------

_DESCRIBE = """
SELECT 'count' AS stat, CAST(count(l_quantity) AS DOUBLE) AS q, CAST(count(l_tax) AS DOUBLE) AS x FROM lineitem
UNION ALL SELECT 'mean', round(avg(l_quantity), 6), round(avg(l_tax), 6) FROM lineitem
UNION ALL SELECT 'stddev', round(stddev(l_quantity), 6), round(stddev(l_tax), 6) FROM lineitem
UNION ALL SELECT 'min', min(l_quantity), min(l_tax) FROM lineitem
UNION ALL SELECT 'max', max(l_quantity), max(l_tax) FROM lineitem
"""


def _stat_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("summary").alias("stat"), F.round(F.col("l_quantity").cast("double"), 6).alias("q"),
        F.round(F.col("l_tax").cast("double"), 6).alias("x"),
    )


@case("q_describe", _DESCRIBE)
def describe(t: Tables) -> DataFrame:
    return _stat_rows(t.lineitem.describe("l_quantity", "l_tax"))


@case("q_summary", _DESCRIBE + """
UNION ALL SELECT '50%', quantile_disc(l_quantity, 0.5), quantile_disc(l_tax, 0.5) FROM lineitem""")
def summary(t: Tables) -> DataFrame:
    return _stat_rows(t.lineitem.select("l_quantity", "l_tax").summary("count", "mean", "stddev", "min", "max", "50%"))


@case("q_stat_corr_cov", """
SELECT round(corr(l_quantity, l_discount), 6) AS r, round(covar_samp(l_quantity, l_discount), 6) AS c FROM lineitem""")
def stat_corr_cov(t: Tables) -> DataFrame:
    """`df.corr` and `df.cov` give driver numbers; the same sums as a frame stay lazy."""
    return t.lineitem.agg(
        F.round(F.corr("l_quantity", "l_discount"), 6).alias("r"), F.round(F.covar_samp("l_quantity", "l_discount"), 6).alias("c")
    )


@case("q_stat_crosstab", """
SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS F, count(*) FILTER (o_orderstatus = 'O') AS O,
       count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""")
def stat_crosstab(t: Tables) -> DataFrame:
    return t.orders.stat.crosstab("o_orderpriority", "o_orderstatus").withColumnRenamed("o_orderpriority_o_orderstatus", "priority")


@case("q_stat_freq_items", "SELECT TRUE AS all_found FROM orders LIMIT 1")
def stat_freq_items(t: Tables) -> DataFrame:
    """Every status with a share over the support is among the items."""
    items = t.orders.freqItems(["o_orderstatus"], 0.2)
    shares = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    total = shares.agg(F.sum("n").alias("all_rows"))
    often = shares.crossJoin(total).where(F.col("n") > 0.2 * F.col("all_rows"))
    return often.crossJoin(items).agg(
        F.bool_and(F.array_contains("o_orderstatus_freqItems", F.col("o_orderstatus"))).alias("all_found")
    )


@case("q_stat_approx_quantile", "SELECT l_linestatus, TRUE AS lo_ok, TRUE AS hi_ok FROM lineitem GROUP BY 1")
def stat_approx_quantile(t: Tables) -> DataFrame:
    """The share of rows at or below the estimated quartiles is near the asked one."""
    lo, hi = t.lineitem.approxQuantile("l_extendedprice", [0.25, 0.75], 0.01)
    return t.lineitem.groupBy("l_linestatus").agg(
        (F.abs(F.avg((F.col("l_extendedprice") <= lo).cast("double")) - 0.25) < 0.05).alias("lo_ok"),
        (F.abs(F.avg((F.col("l_extendedprice") <= hi).cast("double")) - 0.75) < 0.05).alias("hi_ok"),
    )


@case("q_sample_fractions", "SELECT o_orderstatus, TRUE AS sample_ok, TRUE AS by_ok FROM orders GROUP BY 1")
def sample_fractions(t: Tables) -> DataFrame:
    """Sampled shares lie within a wide bound of the asked fractions."""
    keys = ["o_orderstatus"]
    whole = t.orders.groupBy(keys).agg(F.count("*").alias("n"))
    some = t.orders.sample(fraction=0.3, seed=11).groupBy(keys).agg(F.count("*").alias("s"))
    strata = t.orders.sampleBy("o_orderstatus", {"F": 0.5, "O": 0.5, "P": 0.5}, seed=11).groupBy(keys).agg(F.count("*").alias("b"))

    def near(col, share):
        return F.abs(F.col(col) - share * F.col("n")) < 5 * F.sqrt(share * (1 - share) * F.col("n"))

    return whole.join(some, keys).join(strata, keys).select(
        *keys, near("s", 0.3).alias("sample_ok"), near("b", 0.5).alias("by_ok")
    )


@case("q_random_split", "SELECT count(*) AS n, count(*) AS n_keys, TRUE AS share_ok FROM orders")
def random_split(t: Tables) -> DataFrame:
    a, b = t.orders.select("o_orderkey").randomSplit([0.7, 0.3], seed=5)
    both = a.withColumn("side", F.lit("a")).union(b.withColumn("side", F.lit("b")))
    return both.agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("n_keys"),
        (F.abs(F.avg((F.col("side") == "a").cast("double")) - 0.7) < 0.05).alias("share_ok"),
    )
