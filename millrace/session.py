"""The session settings the jobs are written for."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "millrace", master: str | None = None, cores: int | None = None) -> SparkSession:
    """A session with adaptive execution on; shuffle width follows the cores in local runs.

    On a cluster leave `master` unset: the submit command gives it, and the
    width of shuffles is then taken from the cluster's own settings.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a skewed join side even when that costs one more shuffle later
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        width = cores or os.cpu_count() or 4
        builder = (
            builder.master(master)
            .config("spark.sql.shuffle.partitions", str(width))
            .config("spark.ui.enabled", "false")
            .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "8g"))
        )
    return builder.getOrCreate()


def set_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the shared folder named by the cluster; `fallback` only where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fits(df: DataFrame, max_rows: int) -> bool:
    """Whether `df` has at most `max_rows` rows; reads no more than one row past the bound."""
    return df.limit(max_rows + 1).count() <= max_rows
