"""Landed files: listing, archive members, and delimited text with a fixed schema."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The sixteen text columns of a landed file, in file order.
LANDING_COLUMNS = [
    "Regiao - Sigla", "Estado - Sigla", "Municipio", "Revenda",
    "CNPJ da Revenda", "Nome da Rua", "Numero Rua", "Complemento",
    "Bairro", "Cep", "Produto", "Data da Coleta",
    "Valor de Venda", "Valor de Compra", "Unidade de Medida", "Bandeira",
]
LANDING_SCHEMA = StructType([StructField(name, StringType()) for name in LANDING_COLUMNS])

def is_missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def landed_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Names, sizes and times of landed files; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(
            F.substring_index("path", "/", -1).alias("file_name"),
            "path", F.col("length").alias("bytes"), "modificationTime",
        )
    )


def expand_archives(archives: DataFrame, suffix: str = ".csv", max_member_bytes: int = 1 << 30) -> DataFrame:
    """Members of zip archives whose name ends with `suffix`: one row each, with the bytes.

    `archives` has `path` and `content`, as the `binaryFile` source gives them; each
    archive is opened in the task that read it. A member past `max_member_bytes` stops
    the job with its name, since one cell cannot hold it.
    """

    def members(batches: Iterator) -> Iterator:
        import io
        import zipfile

        import pandas as pd

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for info in archive.infolist():
                        if info.is_dir() or not info.filename.lower().endswith(suffix):
                            continue
                        if info.file_size > max_member_bytes:
                            raise ValueError(f"{path}: member {info.filename} has {info.file_size} bytes")
                        yield pd.DataFrame({
                            "archive": [path],
                            "file_name": [info.filename.rsplit("/", 1)[-1]],
                            "content": [archive.read(info)],
                        })

    return archives.select("path", "content").mapInPandas(
        members, "archive string, file_name string, content binary"
    )


def qualified(spark: SparkSession, path: str) -> str:
    """`path` with the scheme of the store that Spark takes it to be in."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(found).toString()


def _store(uri: str):
    """(file system, path) of a qualified path, inside a task."""
    import re

    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), uri.removeprefix("file://").removeprefix("file:")
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri))


def _archive(uri: str):
    """The zip archive at a path, read by seeking; a small one is read at once, since the
    reader looks for marks before the end that may lie before its start."""
    import io
    import zipfile

    store, path = _store(uri)
    file = store.open_input_file(path)
    return zipfile.ZipFile(io.BytesIO(file.read()) if file.size() < 1 << 20 else file)


def archive_members(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """archive, member, file_name, bytes, crc of every fitting member of the zip archives in `folder`.

    Only the archives' own directories are read, by seeking in the file: no archive is held whole.
    """
    paths = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
        .option("recursiveFileLookup", "true").load(folder).select("path")
    )

    def members(batches: Iterator) -> Iterator:
        import pandas as pd

        for batch in batches:
            for path in batch["path"]:
                with _archive(path) as archive:
                    rows = [
                        (path, i.filename, i.filename.rsplit("/", 1)[-1], i.file_size, i.CRC)
                        for i in archive.infolist() if not i.is_dir() and i.filename.lower().endswith(suffix)
                    ]
                yield pd.DataFrame(rows, columns=["archive", "member", "file_name", "bytes", "crc"])

    return paths.mapInPandas(members, "archive string, member string, file_name string, bytes bigint, crc bigint")


def _changed(batches: Iterator) -> Iterator:
    """Names of landed files whose checksum isn't `crc`; a file is read 1 MB at a time."""
    import zlib

    for batch in batches:
        keep = []
        for path, crc in zip(batch["path"], batch["crc"]):
            store, own = _store(path)
            found = 0
            with store.open_input_stream(own) as data:
                while piece := data.read(1 << 20):
                    found = zlib.crc32(piece, found)
            keep.append(found != crc)
        yield batch.loc[keep, ["file_name"]]


def land_archives(spark: SparkSession, folder: str, landing: str, suffix: str = ".csv") -> DataFrame:
    """Write every fitting member of the archives in `folder` to `landing`, from the executors.

    Members of one name must be equal (size and checksum): they are landed once, from the
    first archive by path. Where they differ nothing is landed and the names are told. A name
    that was in `landing` before is skipped if its bytes are the same, and stops the job with its
    name if not. Each member is copied as a stream of 1 MB at a
    time by the task that its name is dealt to, so neither an archive nor a member is held whole. A
    file is written under a hidden name and then moved, so a retried task leaves no half
    file and replaces its own. Gives the landed names once the frame is run.
    """
    found = archive_members(spark, folder, suffix)
    differ = F.count_distinct("bytes", "crc") > 1
    clashes = found.groupBy("file_name").agg(differ.alias("differ")).where("differ").select("file_name").take(5)
    if clashes:
        raise ValueError(f"different members of one name: {', '.join(sorted(r.file_name for r in clashes))}")
    first = F.min(F.struct("archive", "member", "bytes", "crc")).alias("first")
    chosen = found.groupBy("file_name").agg(first).select("file_name", "first.*")
    try:
        # the listing is made here, so it does not hold what this run lands
        landed = landed_files(spark, landing).select("file_name", "path", F.col("bytes").alias("landed_bytes"))
        known = chosen.join(landed, "file_name")
        other = known.where("bytes <> landed_bytes").select("file_name")
        same_size = known.where("bytes = landed_bytes").select("file_name", "path", "crc").mapInPandas(_changed, "file_name string")
        changed = other.unionByName(same_size).take(5)
        if changed:
            raise ValueError(f"landed before with other bytes: {', '.join(sorted(r.file_name for r in changed))}")
        chosen = chosen.join(landed.select("file_name"), "file_name", "left_anti")
    except AnalysisException as error:
        if not is_missing_path(error):
            raise
    target = qualified(spark, landing)

    def land(batches: Iterator) -> Iterator:
        import shutil
        import uuid

        store, base = _store(target)
        store.create_dir(base, recursive=True)
        for batch in batches:
            for path, rows in batch.groupby("archive"):
                with _archive(path) as archive:
                    for name, member in zip(rows["file_name"], rows["member"]):
                        part = f"{base}/_{name}.{uuid.uuid4().hex}"
                        with archive.open(member) as data, store.open_output_stream(part) as out:
                            shutil.copyfileobj(data, out, 1 << 20)
                        store.move(part, f"{base}/{name}")
            yield batch[["file_name"]]

    return chosen.mapInPandas(land, "file_name string")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType = LANDING_SCHEMA,
    sep: str = ";",
    check_header: bool = True,
) -> DataFrame | None:
    """Delimited files with a header and a fixed schema; None when no file is there.

    Short rows give nulls and extra cells are dropped. With `check_header`, the scan of a
    file whose header differs from the schema fails with the file's name, as its cells
    would move columns; the check rides on the same scan and reads no file twice.
    """
    try:
        return spark.read.csv(
            path, schema=schema, sep=sep, header=True, mode="PERMISSIVE", enforceSchema=not check_header
        )
    except AnalysisException as error:
        if is_missing_path(error):
            return None
        raise
