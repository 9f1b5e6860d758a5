from pyspark.sql import functions as F

from millrace.plans import models


def test_fit_partitions_hold_bounded_rows(spark):
    one = spark.range(5000).select(F.col("id").alias("l_orderkey"), (F.col("id") % 7).alias("l_quantity")).coalesce(1)
    sizes = models.bounded(one, rows=1000).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 5000
    assert max(r["count"] for r in sizes) <= 1000 * 1.2
