"""Stream sinks that survive a retried batch: a batch's rows go to the folder of its number."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.landing import _store as open_store
from millrace.sources.landing import qualified


def append_files(stream: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append to Parquet files through the file sink, until what is there now is read."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)


def append_table(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Append to a catalogue table."""
    return (
        stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).toTable(table)
    )


def batch_folders(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    each: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write every batch to `path/batch=<number>`: writing a batch twice leaves it there once."""

    def write(rows: DataFrame, number: int) -> None:
        rows = each(rows) if each else rows
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.outputMode(mode).foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


class RowFile:
    """Writer of one task's rows as JSON lines, for `foreach`: opened, fed row by row and closed in the task.

    The file is named by batch and partition and put in place when it is whole, so a batch that
    is run again replaces its files and a task that fails leaves none.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def open(self, partition: int, batch: int) -> bool:
        self.store, base = open_store(self.folder)
        self.store.create_dir(base, recursive=True)
        self.part, self.path = f"{base}/_{uuid.uuid4().hex}", f"{base}/{batch:010d}-{partition:05d}.json"
        self.out = self.store.open_output_stream(self.part)
        return True

    def process(self, row: Row) -> None:
        self.out.write(json.dumps(row.asDict(recursive=True), default=str).encode() + b"\n")

    def close(self, error: Exception | None) -> None:
        self.out.close()
        if error is None:
            self.store.move(self.part, self.path)
        else:
            self.store.delete_file(self.part)


def row_files(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rows to JSON lines through a writer that sees row by row; for sinks that have no batch form."""
    return (
        stream.writeStream.foreach(RowFile(qualified(stream.sparkSession, path)))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def latest_updates(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of every key over all batches: an aggregate with partial maxima."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    rest = [c for c in rows.columns if c not in keys and c != "batch"]
    newest = F.max_by(F.struct(*rest), "batch").alias("_row")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_row.*")


def finish(query: StreamingQuery) -> None:
    """Wait until the available input is done; a failed query raises here."""
    query.awaitTermination()
