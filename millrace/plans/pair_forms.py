"""Query cases: what the row-object and key-value operators do, as frame plans."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import frames
from millrace.operators import ordered as o
from millrace.plans.registry import Tables, case


@case("q_pairs_map_filter", """
SELECT o_orderkey % 100 AS k, o_totalprice / 2 AS v FROM orders WHERE o_orderstatus = 'F'""")
def pairs_map_filter(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus = 'F'").select((F.col("o_orderkey") % 100).alias("k"), (F.col("o_totalprice") / 2).alias("v"))


@case("q_pairs_flat_map", "SELECT c_custkey, unnest([c_nationkey, c_nationkey + 100]) AS v FROM customer")
def pairs_flat_map(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.explode(F.array("c_nationkey", F.col("c_nationkey") + 100)).alias("v"))


@case("q_pairs_map_partitions", "SELECT count(*) AS n, max(l_extendedprice) AS top FROM lineitem")
def pairs_map_partitions(t: Tables) -> DataFrame:
    """One row per part of the data, from an iterator over its batches; then the parts are merged."""

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, top = 0, None
        for b in batches:
            if len(b):
                n += len(b)
                high = b["l_extendedprice"].max()
                top = high if top is None else max(top, high)
        yield pd.DataFrame({"n": [n], "top": [top]})

    parts = t.lineitem.select("l_extendedprice").mapInPandas(best, "n bigint, top double")
    return parts.agg(F.sum("n").alias("n"), F.max("top").alias("top"))


@case("q_pairs_partition_sizes", "SELECT count(*) AS n FROM lineitem")
def pairs_partition_sizes(t: Tables) -> DataFrame:
    """Sizes of the parts (what `glom` is used for) without holding a part as one value."""
    return t.lineitem.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("c")).agg(F.sum("c").alias("n"))


@case("q_pairs_reduce_by_key", """
SELECT l_partkey % 100 AS k, sum(l_quantity) AS total, count(*) AS n, max(l_quantity) AS hi, round(avg(l_quantity), 6) AS mean FROM lineitem GROUP BY 1""")
def pairs_reduce_by_key(t: Tables) -> DataFrame:
    return t.lineitem.groupBy((F.col("l_partkey") % 100).alias("k")).agg(
        F.sum("l_quantity").alias("total"), F.count("*").alias("n"), F.max("l_quantity").alias("hi"), F.round(F.avg("l_quantity"), 6).alias("mean")
    )


@case("q_pairs_cogroup", """
SELECT k, coalesce(o, 0) AS orders, coalesce(l, 0) AS lines FROM (SELECT o_custkey AS k, count(*) AS o FROM orders GROUP BY 1) a
FULL JOIN (SELECT l_suppkey AS k, count(*) AS l FROM lineitem GROUP BY 1) b USING (k)""")
def pairs_cogroup(t: Tables) -> DataFrame:
    """Both sides are summed before they meet, so no key brings its rows together."""
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders"))
    b = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("lines"))
    return a.join(b, "k", "full").fillna(0)


@case("q_pairs_subtract_by_key", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.02)")
def pairs_subtract_by_key(t: Tables) -> DataFrame:
    gone = t.lineitem.where("l_discount > 0.02").select(F.col("l_orderkey").alias("o_orderkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(gone, "o_orderkey", "left_anti")


@case("q_pairs_global_stats", """
SELECT count(*) AS n, round(sum(l_quantity), 2) AS total, min(l_quantity) AS lo, max(l_quantity) AS hi, round(avg(l_quantity), 6) AS mean, round(stddev_pop(l_quantity), 6) AS sd,
       round(var_samp(l_quantity), 6) AS var FROM lineitem""")
def pairs_global_stats(t: Tables) -> DataFrame:
    q = "l_quantity"
    return t.lineitem.agg(
        F.count("*").alias("n"), F.round(F.sum(q), 2).alias("total"), F.min(q).alias("lo"), F.max(q).alias("hi"), F.round(F.avg(q), 6).alias("mean"),
        F.round(F.stddev_pop(q), 6).alias("sd"), F.round(F.variance(q), 6).alias("var"),
    )


@case("q_pairs_count_by_value", "SELECT l_discount, count(*) AS count FROM lineitem GROUP BY 1")
def pairs_count_by_value(t: Tables) -> DataFrame:
    return frames.value_counts(t.lineitem, ["l_discount"])


@case("q_pairs_histogram_even", "SELECT CAST(least(floor((l_quantity - 1) / 7), 6) AS INTEGER) AS bucket, count(*) AS n FROM lineitem GROUP BY 1")
def pairs_histogram_even(t: Tables) -> DataFrame:
    return frames.histogram(t.lineitem, "l_quantity", [1, 8, 15, 22, 29, 36, 43, 50])


@case("q_pairs_histogram_edges", """
SELECT CASE WHEN l_quantity < 5 THEN 0 WHEN l_quantity < 20 THEN 1 ELSE 2 END AS bucket, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 2 AND 40 GROUP BY 1""")
def pairs_histogram_edges(t: Tables) -> DataFrame:
    return frames.histogram(t.lineitem, "l_quantity", [2, 5, 20, 40])


@case("q_pairs_top", "SELECT l_extendedprice FROM lineitem ORDER BY 1 DESC LIMIT 12")
def pairs_top(t: Tables) -> DataFrame:
    return t.lineitem.select("l_extendedprice").orderBy(F.desc("l_extendedprice")).limit(12)


@case("q_pairs_zip_with_index", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS i FROM orders")
def pairs_zip_with_index(t: Tables) -> DataFrame:
    return o.global_position(t.orders.select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], "i").drop("o_totalprice")


@case("q_pairs_zip", """
SELECT a.o_orderkey AS x, b.o_orderkey AS y FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders) a
JOIN (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS i FROM orders) b USING (i)""")
def pairs_zip(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("x"))
    b = t.orders.select(F.col("o_orderkey").alias("y"), "o_totalprice")
    return frames.zip_frames(a, b, ["x"], ["o_totalprice", "y"]).drop("o_totalprice")


@case("q_pairs_lookup", "SELECT l_partkey, l_quantity FROM lineitem WHERE l_orderkey = 7")
def pairs_lookup(t: Tables) -> DataFrame:
    return t.lineitem.where("l_orderkey = 7").select("l_partkey", "l_quantity")


@case("q_pairs_sorted_partitions", "SELECT l_suppkey, count(*) AS n, TRUE AS one_part FROM lineitem GROUP BY 1")
def pairs_sorted_partitions(t: Tables) -> DataFrame:
    """Hash parts, each sorted inside: all rows of a key are in one part."""
    laid = t.lineitem.select("l_suppkey").repartition(8, "l_suppkey").sortWithinPartitions("l_suppkey")
    tagged = laid.withColumn("p", F.spark_partition_id())
    return tagged.groupBy("l_suppkey").agg(F.count("*").alias("n"), (F.min("p") == F.max("p")).alias("one_part"))
