"""Shapes of plans that must hold at any size."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace.operators import frames
from millrace.plans import jobs
from millrace.plans.registry import CASES, Tables

FOLDER = "/root/testdata/sf0.001"
entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, FOLDER)


@pytest.mark.parametrize("name", [
    "q_flagship_region_month", "q_bronze_job", "q_station_job", "q_sales_job", "q_group_pricing_summary", "q_join_star_revenue", "q_asof_backward",
    "q_running_by_type", "q_links_extract", "q_string_regex", "q_array_higher_order", "q_frame_rank_methods",
])
def test_hot_queries_stay_in_the_jvm(spark, name):
    text = plan(CASES[name].run(spark, FOLDER))
    assert "Python" not in text and "Pandas" not in text and "InArrow" not in text


def test_no_pair_products(spark):
    """The only products are with a frame of one row or a short code list."""
    allowed = {
        "q_cross_join_total", "q_stat_freq_items", "q_frame_equals", "q_frame_monotonic", "q_keys_unique", "q_frame_value_counts", "q_sql_lateral", "q_frame_first_last_period", "q_frame_mad",
    }
    names = [n for n in CASES if not n.startswith(("q_model", "q_cluster", "q_tune", "q_stream", "q_file", "q_layer", "q_feature", "q_evaluate", "q_pattern"))]
    found = set()
    for name in names:
        text = plan(CASES[name].run(spark, FOLDER))
        if "CartesianProduct" in text or "BroadcastNestedLoopJoin" in text:
            found.add(name)
    assert found <= allowed


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(tables.orders.where("o_totalprice > 1000").select("o_orderkey"))
    assert "GreaterThan(o_totalprice,1000.0)" in text and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


@pytest.mark.parametrize("build", [jobs.station_rows, jobs.sale_rows])
def test_silver_jobs_shuffle_once(spark, build):
    landed = spark.createDataFrame([tuple("x" * 16)], jobs.read_delimited.__defaults__[0])
    assert plan(build(jobs.bronze_rows(landed))).count("Exchange") == 1


def test_bucketed_sides_are_not_shuffled(spark):
    text = plan(CASES["q_table_bucketed_join"].run(spark, FOLDER))
    assert "SortMergeJoin" in text and "hashpartitioning(o_orderkey" not in text and "hashpartitioning(l_orderkey" not in text
    assert text.count("Exchange ") == 1  # of the sums


def test_recovered_partitions_are_pruned(spark):
    text = plan(CASES["q_table_recovered"].run(spark, FOLDER))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text


@pytest.mark.parametrize(("name", "most"), [("q_asof_backward", 4), ("q_asof_nearest", 4), ("q_frame_sessions", 12)])
def test_ordered_operators_cut_once(spark, name, most):
    """Both directions of an as-of join, and both passes of sessions, work on one cut of the rows."""
    text = plan(CASES[name].run(spark, FOLDER))
    assert text.count("Exchange ") <= most and text.count("FileScan") <= 4


def test_top_rows_are_limited_before_the_shuffle(tables):
    text = plan(frames.top_rows(tables.orders, ["o_custkey"], [F.desc("o_totalprice")], 2))
    assert text.count("WindowGroupLimit") == 2


def test_large_sides_are_not_broadcast_by_hint(tables):
    from millrace.operators.joins import broadcast_if_small

    assert "broadcast" in broadcast_if_small(tables.region, 10)._jdf.queryExecution().logical().toString().lower()
    assert "ResolvedHint" not in broadcast_if_small(tables.lineitem, 10)._jdf.queryExecution().analyzed().toString()
    # few rows of long texts are too much as well
    long = tables.region.select("r_regionkey", F.repeat(F.lit("x"), 10_000).alias("text"))
    assert "ResolvedHint" in broadcast_if_small(long, 10, 60_000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(long, 10, 40_000)._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize(("hint", "node"), [
    ("broadcast", "BroadcastHashJoin"), ("merge", "SortMergeJoin"), ("shuffle_hash", "ShuffledHashJoin"),
])
def test_join_hints(tables, hint, node):
    lines = tables.lineitem.select("l_orderkey", "l_quantity").hint(hint)
    assert node in plan(tables.orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")))


def test_layout_hints(spark, tables):
    assert tables.orders.hint("repartition", 5).rdd.getNumPartitions() == 5
    assert "REBALANCE" in plan(tables.orders.hint("rebalance", "o_custkey"))
    assert tables.orders.repartition(6).hint("coalesce", 2).rdd.getNumPartitions() == 2
