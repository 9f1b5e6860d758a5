"""Groups for Python functions: many small keys per call, never one unbounded key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CALL_ROWS = 50_000


def bucket_count(df: DataFrame, call_rows: int = CALL_ROWS) -> int:
    """Buckets that give about `call_rows` rows per call; the count comes from file footers
    when `df` is a plain scan."""
    return max(1, df.count() // call_rows)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by its keys: all rows of a key are in one bucket.

    Use the key of small groups (an order) to keep them whole, or a row's own id to cut
    a large group in even parts whose results are merged afterwards.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
