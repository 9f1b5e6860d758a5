"""Query cases: verbs of catalogue tables, save modes, landing of archives."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.files import _ORDERS, orders
from millrace.plans.registry import Tables, case
from millrace.sources import tables as tb
from millrace.sources.archives import write_archives
from millrace.sources.landing import land_archives, landed_files, read_delimited
from millrace.sources.scratch import scratch
from millrace.streaming.sinks import append_files, append_table, finish, row_files
from millrace.streaming.sources import file_stream, table_stream


def _name(kind: str) -> str:
    """A table name of its own for every run; the catalogue of a session may hold others' tables."""
    return f"{kind}_{uuid.uuid4().hex[:12]}"


def _third(t: Tables, rest: int) -> DataFrame:
    return orders(t).where(F.col("o_orderkey") % 3 == rest)


# -- catalogue tables -------------------------------------------------------------------


@case("q_table_verbs", f"""
WITH a AS ({_ORDERS} WHERE o_orderkey % 3 <> 2),
b AS (SELECT * FROM a WHERE o_orderstatus <> 'P' UNION ALL {_ORDERS} WHERE o_orderkey % 3 = 2 AND o_orderstatus = 'P')
SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN 0 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice FROM b""")
def table_verbs(t: Tables) -> DataFrame:
    """Created by partition, appended with the columns in another order, one partition replaced, rows replaced by a condition."""
    name = _name("verbs")
    tb.create(_third(t, 0), name, scratch(t.spark, "verbs"), ["o_orderstatus"])
    tb.append(_third(t, 1).select("o_totalprice", "o_orderstatus", "o_custkey", "o_orderkey"), name)
    tb.overwrite_partitions(_third(t, 2).where("o_orderstatus = 'P'"), name)
    dear = (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 200_000)
    changed = t.spark.table(name).where(dear).withColumn("o_custkey", F.lit(0).cast("bigint"))
    tb.overwrite_where(changed, name, dear)
    return t.spark.table(name).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@case("q_table_replaced", "SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS first_key FROM orders WHERE o_orderkey % 3 = 1 GROUP BY 1")
def table_replaced(t: Tables) -> DataFrame:
    """Another schema in place of the first, then other rows; the table is the last of them."""
    name, path = _name("replaced"), scratch(t.spark, "replaced")
    tb.create(t.customer, name, path)
    tb.create_or_replace(_third(t, 0), name, path)
    tb.replace(_third(t, 1).select("o_orderkey", "o_orderstatus"), name, path, ["o_orderstatus"])
    return t.spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"))


@case("q_table_insert_into", f"{_ORDERS} WHERE o_orderkey % 3 <> 0")
def table_insert_into(t: Tables) -> DataFrame:
    """`insertInto` goes by place and may replace all rows, `saveAsTable` in append mode goes by name."""
    name = _name("inserted")
    _third(t, 0).write.option("path", scratch(t.spark, "inserted")).saveAsTable(name)
    placed = _third(t, 1).toDF("a", "b", "c", "d")
    placed.write.insertInto(name, overwrite=True)
    _third(t, 2).select("o_totalprice", "o_custkey", "o_orderkey", "o_orderstatus").write.mode("append").saveAsTable(name)
    return t.spark.table(name)


@case("q_table_bucketed_join", """
SELECT o_orderpriority, count(*) AS n, round(sum(l_extendedprice), 2) AS price FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def table_bucketed_join(t: Tables) -> DataFrame:
    """Both sides in buckets of the join key, sorted in them: the join reads bucket by bucket and shuffles neither side."""
    a, b = _name("orders"), _name("lines")
    tb.bucketed(t.orders.select("o_orderkey", "o_orderpriority"), a, scratch(t.spark, "buckets"), ["o_orderkey"])
    tb.bucketed(t.lineitem.select("l_orderkey", "l_extendedprice"), b, scratch(t.spark, "buckets"), ["l_orderkey"])
    joined = t.spark.table(a).hint("merge").join(t.spark.table(b), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@case("q_table_recovered", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def table_recovered(t: Tables) -> DataFrame:
    """A table over folders that were there before: it has no partitions until they are recovered."""
    name, path = _name("recovered"), scratch(t.spark, "recovered")
    orders(t).write.partitionBy("o_orderstatus").parquet(path)
    t.spark.catalog.createTable(name, path=path, source="parquet")
    t.spark.catalog.recoverPartitions(name)
    return t.spark.table(name).where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice", "o_orderstatus")


@case("q_file_save_modes", f"{_ORDERS} WHERE o_orderkey % 3 <> 0")
def file_save_modes(t: Tables) -> DataFrame:
    """A write to a taken folder is refused, left out, put in place of what is there, or added to it."""
    path = scratch(t.spark, "modes") + "/orders"
    _third(t, 0).write.parquet(path)
    try:
        orders(t).write.mode("errorifexists").parquet(path)
        raise ValueError("a taken folder was written")
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    orders(t).write.mode("ignore").parquet(path)
    _third(t, 1).write.mode("overwrite").parquet(path)
    _third(t, 2).write.mode("append").parquet(path)
    return t.spark.read.parquet(path)


# -- landing ----------------------------------------------------------------------------


@case("q_land_archives", """
SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers, CAST(sum(o_orderkey) AS BIGINT) AS keys, TRUE AS skipped, TRUE AS listed FROM orders""")
def land_zip_archives(t: Tables) -> DataFrame:
    """Archives landed by the executors, what is landed already skipped, files listed without their bytes, read by a fixed schema.

    A folder without files gives no frame.
    """
    base = scratch(t.spark, "land")
    rows = orders(t).select(F.to_csv(F.struct("o_orderkey", "o_custkey"), {"sep": ";"}).alias("line"))
    write_archives(rows, f"{base}/zips", "o_orderkey;o_custkey", member="orders-{part}.csv").count()
    landed = land_archives(t.spark, f"{base}/zips", f"{base}/landed").count()
    again = land_archives(t.spark, f"{base}/zips", f"{base}/landed").count()
    if read_delimited(t.spark, f"{base}/none/*.csv") is not None:
        raise ValueError("a folder without files was read")
    listed = landed_files(t.spark, f"{base}/landed", "*.csv").count() == landed
    read = read_delimited(t.spark, f"{base}/landed/*.csv", "o_orderkey STRING, o_custkey STRING")
    return read.agg(
        F.count("*").alias("n"), F.count_distinct("o_custkey").alias("customers"),
        F.sum(F.col("o_orderkey").cast("bigint")).alias("keys"), F.lit(again == 0).alias("skipped"),
        F.lit(listed).alias("listed"),
    )


# -- streams by format, to tables and to a writer of rows -------------------------------------


def _add_stream(kind: str, schema: str) -> None:
    @case(f"q_stream_{kind}", "SELECT event_id, user_id, event_type, value FROM events WHERE value > 10")
    def build(t: Tables) -> DataFrame:
        base = scratch(t.spark, f"stream-{kind}")
        rows = t.events.select("event_id", "user_id", "event_type", "value")
        rows.repartition(3).write.format(kind).save(f"{base}/in")
        stream = file_stream(t.spark, f"{base}/in", schema, kind, files_per_batch=1).where("value > 10")
        finish(append_files(stream, f"{base}/out", f"{base}/state"))
        return t.spark.read.schema(schema).parquet(f"{base}/out")


for _kind in ("json", "orc", "csv"):
    _add_stream(_kind, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")


@case("q_stream_text", "SELECT c_custkey, c_name FROM customer")
def stream_text(t: Tables) -> DataFrame:
    """Lines as they land, taken apart by a pattern."""
    base = scratch(t.spark, "stream-text")
    t.customer.select(F.concat_ws("|", "c_custkey", "c_name").alias("value")).write.text(f"{base}/in")
    lines = file_stream(t.spark, f"{base}/in", "value STRING", "text")
    parts = F.split("value", r"\|", 2)
    stream = lines.select(parts[0].cast("bigint").alias("c_custkey"), parts[1].alias("c_name"))
    finish(append_files(stream, f"{base}/out", f"{base}/state"))
    return t.spark.read.schema(stream.schema).parquet(f"{base}/out")


@case("q_stream_tables", "SELECT event_type, count(*) AS n, max(event_id) AS newest FROM events WHERE user_id % 2 = 0 GROUP BY 1")
def stream_tables(t: Tables) -> DataFrame:
    """A catalogue table read as a stream and written to another one, in two goes: the second adds only what came since."""
    source, target, base = _name("source"), _name("target"), scratch(t.spark, "stream-table")
    rows = t.events.select("event_id", "user_id", "event_type")
    rows.where("event_id % 2 = 0").write.option("path", f"{base}/source").saveAsTable(source)
    tb.create(rows.limit(0), target, f"{base}/target")
    for more in (None, rows.where("event_id % 2 = 1")):
        if more is not None:
            more.write.mode("append").saveAsTable(source)
        stream = t.spark.readStream.table(source).where("user_id % 2 = 0")
        finish(append_table(stream, target, f"{base}/state"))
    return t.spark.table(target).groupBy("event_type").agg(F.count("*").alias("n"), F.max("event_id").alias("newest"))


@case("q_stream_partitioned_sink", "SELECT event_id, event_type FROM events WHERE event_type = 'click'")
def stream_partitioned_sink(t: Tables) -> DataFrame:
    """A sink filed by event type; the reader opens one folder."""
    base = scratch(t.spark, "stream-parts")
    stream = table_stream(t.spark, t.folder, "events").select("event_id", "event_type")
    finish(append_files(stream, f"{base}/out", f"{base}/state", ["event_type"]))
    return t.spark.read.schema(stream.schema).parquet(f"{base}/out").where("event_type = 'click'").select("event_id", "event_type")


@case("q_stream_row_writer", "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'view'")
def stream_row_writer(t: Tables) -> DataFrame:
    """Every task hands its rows to a writer of its own, which keeps one file by batch and partition."""
    base = scratch(t.spark, "stream-rows")
    stream = table_stream(t.spark, t.folder, "events").where("event_type <> 'view'").select("event_id", "user_id", "event_type")
    finish(row_files(stream, f"{base}/out", f"{base}/state"))
    return t.spark.read.schema("event_id BIGINT, user_id BIGINT, event_type STRING").json(f"{base}/out")
