"""A folder for a job's own files, seen by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared folder; a local one only in local runs."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    return tempfile.mkdtemp(prefix=f"millrace-{name}-")
