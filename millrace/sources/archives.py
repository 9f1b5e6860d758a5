"""Lines of zip archives as a data source, in batches and as a stream.

A partition is a stretch of one archive's member. A stored member is cut in ranges of bytes,
each of which begins at the first line after its start; a deflated one can only be read from
its beginning, so it is one partition. Either way a task holds `READ` bytes of a member at a
time and the lines in them, however large the member. Archives are opened by seeking in the
store (local folders, hdfs, s3); planning reads their directories and no data.

As a stream, archives come in the order of (time, path): an offset is the last one read. An
archive that appears with an older time than the offset is not seen; land files by moving
them in place. Cells that hold line breaks are not for this reader: a line is a row.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from millrace.sources.landing import _archive, _store, qualified

READ = 4 << 20
RANGE = 128 << 20
_SCHEMA = "archive string, member string, start bigint, line binary"


@dataclass
class Stretch(InputPartition):
    """Bytes [first, last) of a member; `whole` where it is read from the beginning to its end."""

    archive: str
    member: str
    first: int
    last: int
    whole: bool


class ZipLines(DataSource):
    """Options: folder (with its scheme), suffix of members, range (bytes of a stored member per partition)."""

    @classmethod
    def name(cls) -> str:
        return "zip_lines"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> ZipReader:
        return ZipReader(self.options)

    def streamReader(self, schema) -> ZipStream:
        return ZipStream(self.options)


class _Plans:
    def __init__(self, options):
        self.folder, self.suffix = options["folder"], options.get("suffix", ".csv").lower()
        self.range = int(options.get("range", RANGE))

    def archives(self) -> list[tuple[int, str]]:
        """(time, path) of the folder's archives."""
        from pyarrow import fs

        store, base = _store(self.folder)
        found = store.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
        scheme = self.folder[:len(self.folder) - len(base)] if self.folder.endswith(base) else "file://"
        return sorted((f.mtime_ns or 0, scheme + f.path) for f in found if f.is_file and f.path.lower().endswith(".zip"))

    def stretches(self, archives: list[tuple[int, str]]) -> list[Stretch]:
        out = []
        for _, path in archives:
            with _archive(path) as archive:
                for info in archive.infolist():
                    if info.is_dir() or not info.filename.lower().endswith(self.suffix):
                        continue
                    stored = info.compress_type == zipfile.ZIP_STORED
                    step = self.range if stored else max(info.file_size, 1)
                    out += [Stretch(path, info.filename, at, min(at + step, info.file_size), not stored) for at in range(0, info.file_size, step)]
        return out

    def read(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        with _archive(part.archive) as archive, archive.open(part.member) as data:
            at = max(part.first - 1, 0)
            if not part.whole:
                data.seek(at)
            rest, start = b"", at
            skip = part.first > 0  # up to the line break at or behind the byte before this stretch
            while True:
                more = data.read(READ)
                ends = not more
                lines = (rest + more).split(b"\n")
                rest = lines.pop()
                if ends and rest:
                    lines, rest = [*lines, rest], b""
                starts, kept = [], []
                for line in lines:
                    own, start = start, start + len(line) + 1
                    if skip:
                        skip = False
                    elif own < part.last:
                        starts.append(own)
                        kept.append(line.removesuffix(b"\r"))
                if kept:
                    n = len(kept)
                    yield pa.RecordBatch.from_arrays([pa.array([part.archive] * n), pa.array([part.member] * n), pa.array(starts, pa.int64()), pa.array(kept, pa.binary())],
                                                     ["archive", "member", "start", "line"])
                if ends or start >= part.last and not skip:
                    return


class ZipReader(_Plans, DataSourceReader):
    def partitions(self) -> list[Stretch]:
        return self.stretches(self.archives()) or [Stretch("", "", 0, 0, True)]

    def read(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        return super().read(part) if part.archive else iter(())


class ZipStream(_Plans, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        found = self.archives()
        return {"time": found[-1][0], "path": found[-1][1]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        after, upto = (start["time"], start["path"]), (end["time"], end["path"])
        return self.stretches([a for a in self.archives() if after < a <= upto])

    def read(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        return super().read(part)

    def commit(self, end: dict) -> None:
        pass


def _options(spark: SparkSession, folder: str, suffix: str, range_bytes: int) -> dict[str, str]:
    spark.dataSource.register(ZipLines)
    return {"folder": qualified(spark, folder), "suffix": suffix, "range": str(range_bytes)}


def archive_lines(spark: SparkSession, folder: str, suffix: str = ".csv", range_bytes: int = RANGE) -> DataFrame:
    """archive, member, start (byte in the member) and line (bytes) of all archives in `folder`; no archive gives no rows."""
    return spark.read.format("zip_lines").options(**_options(spark, folder, suffix, range_bytes)).load()


def archive_line_stream(spark: SparkSession, folder: str, suffix: str = ".csv", range_bytes: int = RANGE) -> DataFrame:
    """The same as a stream of the archives that appear in `folder`."""
    return spark.readStream.format("zip_lines").options(**_options(spark, folder, suffix, range_bytes)).load()


def write_archives(rows: DataFrame, folder: str, header: str, stored: bool = False, member: str = "rows.csv") -> DataFrame:
    """Write the one text column of `rows` as one archive of one member for each partition, from the executors.

    An archive is named by its partition and put in place in one step, so a retried task
    replaces its own; `{part}` in the member's name is the partition's number. Gives the paths once the frame is run.
    """
    target = qualified(rows.sparkSession, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        from pyspark import TaskContext

        store, base = _store(target)
        store.create_dir(base, recursive=True)
        context = TaskContext.get()
        part, path = f"{base}/_{uuid.uuid4().hex}", f"{base}/part-{context.partitionId():05d}.zip"
        kind = zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED
        with store.open_output_stream(part) as out, zipfile.ZipFile(out, "w", kind) as archive, archive.open(
                member.format(part=f"{context.partitionId():05d}"), "w", force_zip64=True) as inside:
            text = io.TextIOWrapper(inside, "utf-8", newline="")
            text.write(header + "\n")
            for batch in batches:
                text.writelines(f"{line}\n" for line in batch.column(0).to_pylist())
            text.flush()
        store.move(part, path)
        yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    return rows.mapInArrow(write, "path string")
