"""Versioned layer tables: publish, schema guard, compaction and expiry."""

import os
import time

import pytest
from pyspark.sql import functions as F

from millrace.sources.layers import LayerTable


@pytest.fixture()
def table(spark, tmp_path):
    return LayerTable(spark, f"{tmp_path}/t")


def test_overwrite_replaces_and_keeps_versions(spark, table):
    table.overwrite(spark.range(5))
    table.overwrite(spark.range(3))
    assert table.read().count() == 3 and table.read(1).count() == 5
    assert [v.number for v in table.versions()] == [1, 2]


def test_a_table_can_be_rewritten_from_itself(spark, table):
    table.overwrite(spark.range(5))
    table.overwrite(table.read().where("id > 1"))
    assert table.read().count() == 3


def test_unfinished_version_is_not_read(spark, table):
    table.overwrite(spark.range(5))
    spark.range(9).write.parquet(f"{table.root}/v=2")
    os.unlink(f"{table.root}/v=2/_SUCCESS")
    assert table.read().count() == 5
    assert table.overwrite(spark.range(2)).number == 3


def test_failed_write_leaves_the_old_rows(spark, table):
    table.overwrite(spark.range(5))
    bad = spark.range(3).select(F.when(F.col("id") == 1, F.raise_error(F.lit("stop")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        table.overwrite(bad)
    assert table.read().count() == 5


def test_schema_guard(spark, table):
    table.overwrite(spark.range(5))
    with pytest.raises(ValueError, match="schema"):
        table.overwrite(spark.range(5).withColumn("x", F.lit(1)))
    table.overwrite(spark.range(5).withColumn("x", F.lit(1)), allow_new_schema=True)
    assert table.read().columns == ["id", "x"]


def test_compaction_keeps_the_rows(spark, table):
    table.overwrite(spark.range(1000).repartition(16), balance=False)
    assert table.file_sizes().count() == 16
    before = table.read().agg(F.count("*"), F.sum("id"), F.sum(F.xxhash64("id").cast("decimal(38,0)"))).first()
    assert table.compact() is not None
    assert table.file_sizes().count() == 1
    assert table.read().agg(F.count("*"), F.sum("id"), F.sum(F.xxhash64("id").cast("decimal(38,0)"))).first() == before
    assert table.compact() is None


def test_balance_writes_few_files(spark, table):
    table.overwrite(spark.range(1000).repartition(16))
    assert table.file_sizes().count() < 16


def test_expiry_never_removes_the_current_version(spark, table):
    for n in (1, 2, 3):
        table.overwrite(spark.range(n))
    assert table.expire(168) == []
    later = time.time() + 169 * 3600
    assert table.expire(168, now=later) == [1, 2]
    assert table.read().count() == 3 and table.expire(0, now=later * 2) == []


def test_partitioned_table(spark, table):
    table.overwrite(spark.range(20).withColumn("p", F.col("id") % 2), partition_by=("p",))
    assert table.read().where("p = 1").count() == 10
