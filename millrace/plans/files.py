"""Query cases: each file format written by Spark and read back, and tables over files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import partitions as pt
from millrace.plans.registry import Tables, case
from millrace.sources.archives import archive_line_stream, archive_lines, write_archives
from millrace.sources.landing import read_delimited
from millrace.sources.layers import LayerTable
from millrace.sources.partitioned import Filed, in_range, with_folders
from millrace.sources.scratch import scratch
from millrace.sources.snapshots import SnapshotTable
from millrace.streaming.sinks import append_files, finish

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"
_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"


def orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@case("q_file_csv", _ORDERS)
def file_csv(t: Tables) -> DataFrame:
    path = scratch(t.spark, "csv")
    orders(t).write.mode("overwrite").csv(path, header=True, sep=";")
    return t.spark.read.csv(path, schema=_SCHEMA, header=True, sep=";")


@case("q_file_landed_text", "SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_mktsegment FROM customer")
def file_landed_text(t: Tables) -> DataFrame:
    from pyspark.sql.types import StringType, StructField, StructType

    path = scratch(t.spark, "landed")
    df = t.customer.select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment")
    df.write.mode("overwrite").csv(path, header=True, sep=";")
    schema = StructType([StructField(c, StringType()) for c in df.columns])
    return read_delimited(t.spark, f"{path}/*.csv", schema)


@case("q_file_zip", _ORDERS)
def file_zip(t: Tables) -> DataFrame:
    """Exported as zip archives by the executors, read back line by line."""
    path = scratch(t.spark, "zip")
    rows = orders(t).select(F.to_csv(F.struct("*"), {"sep": ";"}).alias("line"))
    write_archives(rows, path, "o_orderkey;o_custkey;o_orderstatus;o_totalprice").count()
    lines = archive_lines(t.spark, path).where("start > 0")  # the first line of a member is its header
    return lines.select(F.from_csv(F.col("line").cast("string"), _SCHEMA, {"sep": ";"}).alias("row")).select("row.*")


@case("q_file_zip_members", "SELECT 'rows.csv' AS member, count(*) AS n, CAST(sum(length(CAST(c_custkey AS VARCHAR) || ';' || c_name)) AS BIGINT) AS bytes FROM customer")
def file_zip_members(t: Tables) -> DataFrame:
    """A stored member is read in ranges of bytes, and the archives as a stream: every line comes once."""
    path = scratch(t.spark, "zip-stream")
    write_archives(t.customer.select(F.concat_ws(";", "c_custkey", "c_name").alias("line")), f"{path}/in", "custkey;name", stored=True).count()
    stream = archive_line_stream(t.spark, f"{path}/in", range_bytes=10_000).where("start > 0").select("member", "line")
    finish(append_files(stream, f"{path}/out", f"{path}/state"))
    rows = t.spark.read.schema(stream.schema).parquet(f"{path}/out")
    return rows.groupBy("member").agg(F.count("*").alias("n"), F.sum(F.octet_length("line")).alias("bytes"))


@case("q_file_json", _ORDERS)
def file_json(t: Tables) -> DataFrame:
    path = scratch(t.spark, "json")
    orders(t).write.mode("overwrite").json(path)
    return t.spark.read.schema(_SCHEMA).json(path)


@case("q_file_parquet_partitioned", _ORDERS + " WHERE o_orderstatus = 'P'")
def file_parquet_partitioned(t: Tables) -> DataFrame:
    """One folder per status: the filter prunes folders before any file is opened."""
    path = scratch(t.spark, "parquet")
    orders(t).write.mode("overwrite").partitionBy("o_orderstatus").parquet(path)
    back = t.spark.read.schema(_SCHEMA).parquet(path).where("o_orderstatus = 'P'")
    return back.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@case("q_file_orc", _ORDERS)
def file_orc(t: Tables) -> DataFrame:
    path = scratch(t.spark, "orc")
    orders(t).write.mode("overwrite").orc(path)
    return t.spark.read.format("orc").load(path)


@case("q_file_text", "SELECT coalesce(text, '') AS value FROM documents")
def file_text(t: Tables) -> DataFrame:
    """One line per document: line breaks are written as escapes and read back as themselves."""
    path = scratch(t.spark, "text")
    escapes = {"%": "%25", "\n": "%0A", "\r": "%0D"}
    line = F.coalesce("text", F.lit(""))
    for sign, written in escapes.items():
        line = F.replace(line, F.lit(sign), F.lit(written))
    t.documents.select(line.alias("value")).write.mode("overwrite").text(path)
    value = F.col("value")
    for sign, written in reversed(escapes.items()):
        value = F.replace(value, F.lit(written), F.lit(sign))
    return t.spark.read.text(path).select(value.alias("value"))


@case("q_file_range", "SELECT o_orderkey, o_orderkey % 4 AS part FROM orders")
def file_range(t: Tables) -> DataFrame:
    """A generated id range as wide as the keys, matched to the rows it covers."""
    top = t.orders.agg(F.max("o_orderkey")).first()[0]
    ids = t.spark.range(0, top + 1, 1, 8).select(F.col("id").alias("o_orderkey"), (F.col("id") % 4).alias("part"))
    return ids.join(t.orders.select("o_orderkey"), "o_orderkey")


@case("q_layer_overwrite_read", _ORDERS + " WHERE o_totalprice > 300000")
def layer_overwrite_read(t: Tables) -> DataFrame:
    """Two versions, the second one read; then the small files are joined and the rows stay."""
    table = LayerTable(t.spark, scratch(t.spark, "layer") + "/orders")
    table.overwrite(orders(t))
    table.overwrite(orders(t).where("o_totalprice > 300000").repartition(8), balance=False)
    table.compact()
    return table.read()


@case("q_file_partition_transforms", """
SELECT event_id, (year(ts) - 1970)::INTEGER AS y, ((year(ts) - 1970) * 12 + month(ts) - 1)::INTEGER AS m, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE))::INTEGER AS d,
       CAST(floor(epoch(ts) / 3600) AS BIGINT) AS h, TRUE AS in_bucket FROM events""")
def file_partition_transforms(t: Tables) -> DataFrame:
    ts = F.col("ts")
    return t.events.select(
        "event_id", pt.years(ts).alias("y"), pt.months(ts).alias("m"), pt.days(ts).alias("d"), pt.hours(ts).alias("h"),
        pt.bucket(8, F.col("user_id")).between(0, 7).alias("in_bucket"),
    )


@case("q_file_partitioned_by_day", "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1")
def file_partitioned_by_day(t: Tables) -> DataFrame:
    """Events filed by day number; the count reads folder names and footers only."""
    path = scratch(t.spark, "days")
    filed = t.events.withColumn("d", pt.days(F.col("ts")))
    filed.hint("rebalance", "d").write.mode("overwrite").partitionBy("d").parquet(path)
    days = t.spark.read.parquet(path).groupBy("d").agg(F.count("*").alias("n"))
    return days.select(F.date_from_unix_date("d").cast("string").alias("day"), "n")


@case("q_file_libsvm", "SELECT label, count(*) AS n FROM embeddings GROUP BY 1")
def file_libsvm(t: Tables) -> DataFrame:
    """Labelled vectors in the sparse text form, written and read back."""
    from pyspark.ml.functions import array_to_vector

    path = scratch(t.spark, "libsvm")
    x = array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    t.embeddings.select(F.col("label").cast("double").alias("label"), x).write.mode("overwrite").format("libsvm").save(path)
    back = t.spark.read.format("libsvm").option("numFeatures", "64").load(path)
    return back.groupBy(F.col("label").cast("int").alias("label")).agg(F.count("*").alias("n"))


@case("q_table_conditional_overwrite", f"""
WITH a AS ({_ORDERS}),
b AS (SELECT * FROM a WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 100000)
      UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice FROM a WHERE o_orderstatus = 'F' AND o_totalprice > 100000),
c AS (SELECT * FROM b WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey, -1, o_orderstatus, o_totalprice FROM a WHERE o_orderstatus = 'P' AND o_totalprice > 50000)
SELECT * FROM c WHERE NOT (o_orderstatus = 'O' AND o_totalprice < 60000)""")
def table_conditional_overwrite(t: Tables) -> DataFrame:
    """Edits of one table: rows by a condition, whole partitions, rows deleted; each is a version."""
    table = SnapshotTable(t.spark, scratch(t.spark, "snapshots"))
    table.create(orders(t), ["o_orderstatus"])
    dear = (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100_000)
    table.overwrite(table.read().where(dear).withColumn("o_orderstatus", F.lit("X")), dear)
    open_part = table.read(1).where("o_orderstatus = 'P' AND o_totalprice > 50000")
    table.overwrite_partitions(open_part.withColumn("o_custkey", F.lit(-1).cast("bigint")))
    table.delete((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 60_000))
    return table.read().select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@case("q_table_time_range", """
SELECT event_id, user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-05 06:30:00' AND ts < TIMESTAMP '2024-01-09 18:00:00'""")
def table_time_range(t: Tables) -> DataFrame:
    """Events filed by month and day; a range of times reads the days that it touches."""
    filed = [Filed("ts", "months"), Filed("ts", "days")]
    table = SnapshotTable(t.spark, scratch(t.spark, "filed"))
    table.create(with_folders(t.events, filed), [f.name for f in filed])
    return in_range(table.read(), filed, "ts", "2024-01-05 06:30:00", "2024-01-09 18:00:00").select("event_id", "user_id", "event_type")
