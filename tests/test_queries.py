"""Every query case against its SQL twin, on the small tables."""

import re

import pytest

import __spark_entry__ as entry
from millrace.plans.registry import CASES
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_names():
    assert set(SQL) <= set(QUERIES)
    assert all(n.startswith("q_") for n in CASES) and all(re.match(r"q_|op\d+_|pipeline$", n) for n in QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_compare_sees_differences(spark, con):
    assert compare(spark.range(3), con, "SELECT range AS id FROM range(3)") == []
    assert compare(spark.range(3), con, "SELECT range AS id FROM range(4)")
    assert compare(spark.range(3), con, "SELECT range + 1 AS id FROM range(3)")
    assert compare(spark.range(3), con, "SELECT CAST(range AS INTEGER) AS id FROM range(3)")
    assert compare(spark.range(3), con, "SELECT range AS other FROM range(3)")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in SQL:
        problems = [p for p in compare(df, con, SQL[name]) if p != "no rows"]
        assert problems == []
    else:
        rows = df.collect()
        keys = [c for c in ("doc_id", "vec_id", "page_id") if c in df.columns]
        assert rows and keys and all(r[keys[0]] is not None for r in rows)
