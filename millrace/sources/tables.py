"""Writes into partitioned catalogue tables over Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import set_checkpoint_dir
from millrace.sources.scratch import scratch


def create(df: DataFrame, table: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """A new table at `path`; fails when the name is taken."""
    _save(df, table, path, partition_by, "errorifexists")


def create_or_replace(df: DataFrame, table: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """The table with these rows and this schema, whatever it held before."""
    _save(df, table, path, partition_by, "overwrite")


def replace(df: DataFrame, table: str, path: str, partition_by: Sequence[str] = ()) -> None:
    """As `create_or_replace`, for a table that must be there."""
    if not df.sparkSession.catalog.tableExists(table):
        raise ValueError(f"no table {table} to replace")
    create_or_replace(df, table, path, partition_by)


def bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int | None = None) -> None:
    """A new table whose rows lie in buckets of the keys, sorted in them; as many as a shuffle has partitions, if not told.

    Tables with the same keys and number of buckets are joined and grouped by these keys
    without a shuffle. The rows are dealt by the keys first, so a bucket is one file.
    """
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(buckets, *keys)
    dealt.write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def append(df: DataFrame, table: str) -> None:
    """Add rows, columns matched by name."""
    _by_name(df, table).write.insertInto(table)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions `df` has rows for; the others stay."""
    conf, name = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
    before = conf.get(name)
    # an insert into a table takes the mode from the session, not from the writer
    conf.set(name, "dynamic")
    try:
        _by_name(df, table).write.insertInto(table, overwrite=True)
    finally:
        conf.set(name, before)


def overwrite_where(df: DataFrame, table: str, condition: Column) -> None:
    """Replace the rows of a partitioned table that meet `condition` by `df`.

    Only partitions with such rows, or with new rows, are written again. The rows kept in
    them are cut from their files by a checkpoint in the shared folder first, since a
    table cannot be overwritten while it is read; a partition left empty is dropped.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        set_checkpoint_dir(spark, scratch(spark, "checkpoint"))
    parts = _partition_columns(spark, table)
    if not parts:
        raise ValueError(f"{table} has no partitions")
    current = spark.table(table)
    hit = current.where(condition).select(*parts).distinct()
    touched = hit.unionByName(df.select(*parts).distinct()).distinct()
    kept = _matching(current.where(~F.coalesce(condition, F.lit(False))), touched, parts, "left_semi")
    rows = kept.unionByName(df.select(*current.columns)).checkpoint()
    emptied = _matching(hit, rows.select(*parts).distinct(), parts, "left_anti").collect()  # partition names only
    overwrite_partitions(rows, table)
    for part in emptied:
        spec = ", ".join(f"`{c}` = {_literal(part[c])}" for c in parts)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")


def _matching(left: DataFrame, right: DataFrame, parts: Sequence[str], how: str) -> DataFrame:
    """`left` rows whose partition is (semi) or is not (anti) in `right`; null is a partition like others."""
    names = right.select(*[F.col(c).alias(f"_part{i}") for i, c in enumerate(parts)])
    return left.join(names, [left[c].eqNullSafe(names[f"_part{i}"]) for i, c in enumerate(parts)], how)


def _literal(value) -> str:
    if value is None:
        return "null"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{text}'"


def _save(df: DataFrame, table: str, path: str, partition_by: Sequence[str], mode: str) -> None:
    writer = df.write.format("parquet").mode(mode).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def _by_name(df: DataFrame, table: str) -> DataFrame:
    names = df.sparkSession.table(table).columns
    if set(names) != set(df.columns):
        raise ValueError(f"columns {df.columns} do not match {table}: {names}")
    return df.select(*names)


def _partition_columns(spark, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
