"""Layer tables: a folder of Parquet versions, of which the newest finished one is read.

Every write goes to a new version folder `v=<number>` through Spark's own file commit.
The `_SUCCESS` mark, which the commit writes last, publishes the version: a reader
takes the highest number that has it, so a failed write is never seen and a version
being read is never touched. Only listing and deleting use the file system directly.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RETENTION_HOURS = 168


@dataclass(frozen=True)
class Version:
    number: int
    path: str
    written: float | None  # seconds since the epoch; None while unfinished
    touched: float


class LayerTable:
    """One layer table at `root`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[Version]:
        """All version folders, oldest first; a table has as many as its kept runs."""
        if not self._fs.exists(self._path(self.root)):
            return []
        out = []
        for status in self._fs.listStatus(self._path(self.root)):
            name = status.getPath().getName()
            if not name.startswith("v="):
                continue
            path = f"{self.root}/{name}"
            mark = self._path(f"{path}/_SUCCESS")
            done = self._fs.getFileStatus(mark).getModificationTime() / 1000 if self._fs.exists(mark) else None
            out.append(Version(int(name[2:]), path, done, status.getModificationTime() / 1000))
        return sorted(out, key=lambda v: v.number)

    def current(self) -> Version | None:
        done = [v for v in self.versions() if v.written is not None]
        return done[-1] if done else None

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the newest version, or of a given kept one."""
        if version is None:
            found = self.current()
            if found is None:
                raise FileNotFoundError(f"no finished version in {self.root}")
            return self.spark.read.parquet(found.path)
        return self.spark.read.parquet(f"{self.root}/v={version}")

    def overwrite(
        self,
        df: DataFrame,
        allow_new_schema: bool = False,
        partition_by: tuple[str, ...] = (),
        balance: bool = True,
    ) -> Version:
        """Replace the contents by `df` as a new version; refuses a changed schema unless told.

        With `balance`, a rebalance step lets adaptive execution even out the files to
        its advisory size: small parts are joined and a hot partition value is split.
        """
        old = self.current()
        if old and not allow_new_schema:
            before = [(f.name, f.dataType) for f in self.spark.read.parquet(old.path).schema]
            after = [(f.name, f.dataType) for f in df.schema]
            if before != after:
                raise ValueError(f"schema of {self.root} would change from {before} to {after}")
        if balance:
            df = df.hint("rebalance", *partition_by)
        taken = self.versions()
        number = taken[-1].number + 1 if taken else 1
        path = f"{self.root}/v={number}"
        # fails when another writer has taken the number
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return next(v for v in self.versions() if v.number == number)

    def file_sizes(self) -> DataFrame:
        """Path and bytes of the data files of the newest version."""
        return (
            self.spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
            .load(self.current().path).select("path", F.col("length").alias("bytes"))
        )

    def compact(self, target_bytes: int = 128 << 20, small_share: float = 0.5) -> Version | None:
        """Rewrite the newest version to files near `target_bytes`; the rows stay the same.

        Does nothing when fewer than two files are below half the target, or when they
        are less than `small_share` of all files: a well-sized table is not rewritten.
        """
        current = self.current()
        if current is None:
            return None
        small = F.count_if(F.col("bytes") < target_bytes / 2)
        row = self.file_sizes().agg(F.count("*"), small, F.sum("bytes")).first()
        files, small_files, total = row[0], row[1], row[2] or 0
        wanted = max(1, math.ceil(total / target_bytes))
        if small_files < 2 or small_files < files * small_share or files <= wanted:
            return None
        df = self.spark.read.parquet(current.path)
        return self.overwrite(df.repartition(wanted), allow_new_schema=True, balance=False)

    def expire(self, retention_hours: float = RETENTION_HOURS, now: float | None = None) -> list[int]:
        """Delete versions older than the retention; the newest finished one always stays.

        A version's age counts from when a newer one replaced it, as it was read until
        then; an unfinished one counts from its last change.
        """
        now = time.time() if now is None else now
        limit = now - retention_hours * 3600
        kept = self.versions()
        current = self.current()
        gone = []
        for i, version in enumerate(kept):
            if current and version.number == current.number:
                continue
            if version.written is None:
                retired = version.touched
            else:
                later = [v.written for v in kept[i + 1:] if v.written is not None]
                retired = later[0] if later else now
            if retired < limit:
                self._fs.delete(self._path(version.path), True)
                gone.append(version.number)
        return gone
