"""Query cases: streams over the tables' files, run to the end of what is there.

The results are read back from the sink's files, so nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.jobs import _LANDED_SQL, bronze_rows, landed_from_orders
from millrace.plans.registry import Tables, case
from millrace.sources.landing import LANDING_SCHEMA
from millrace.sources.scratch import scratch
from millrace.streaming import operators as so
from millrace.streaming.sinks import append_files, batch_folders, finish, latest_updates
from millrace.streaming.sources import event_time, file_stream, table_stream
from millrace.streaming.state import quiet_totals, state_session

TIME_TEXT = "yyyy-MM-dd HH:mm:ss"


def _events(t: Tables, delay: str = "1 hour") -> DataFrame:
    return event_time(table_stream(t.spark, t.folder, "events"), "ts", delay)


def _updates(t: Tables, stream: DataFrame, keys: list[str], mode: str = "update") -> DataFrame:
    base = scratch(t.spark, "stream")
    finish(batch_folders(stream, f"{base}/out", f"{base}/state", mode))
    return latest_updates(t.spark, f"{base}/out", keys)


def _appended(t: Tables, stream: DataFrame) -> DataFrame:
    base = scratch(t.spark, "stream")
    finish(append_files(stream, f"{base}/out", f"{base}/state"))
    return t.spark.read.schema(stream.schema).parquet(f"{base}/out")


@case("q_stream_bronze", _LANDED_SQL + """
SELECT n_name AS estado_sigla, digits || '000190' AS cnpj_da_revenda, o_orderpriority AS produto, CAST(day AS VARCHAR) AS data_da_coleta,
       round(CAST(sale AS DOUBLE), 3) AS valor_de_venda FROM kept""")
def stream_bronze(t: Tables) -> DataFrame:
    """Landed files as a stream, through the same cleaning as the batch job."""
    landing = scratch(t.spark, "landing")
    landed_from_orders(t).write.mode("overwrite").csv(landing, header=True, sep=";")
    landed = file_stream(t.spark, landing, LANDING_SCHEMA, "csv", header=True, sep=";", enforceSchema=False)
    return _appended(t, bronze_rows(landed)).select(
        "estado_sigla", "cnpj_da_revenda", "produto", F.col("data_da_coleta").cast("string").alias("data_da_coleta"),
        F.round(F.col("valor_de_venda").cast("double"), 3).alias("valor_de_venda"),
    )


@case("q_stream_stateless", "SELECT event_id, user_id, value * 2 AS doubled FROM events WHERE event_type = 'click'")
def stream_stateless(t: Tables) -> DataFrame:
    stream = table_stream(t.spark, t.folder, "events").where("event_type = 'click'")
    return _appended(t, stream.select("event_id", "user_id", (F.col("value") * 2).alias("doubled")))


@case("q_stream_tumbling", """
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start_, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def stream_tumbling(t: Tables) -> DataFrame:
    sums = [F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")]
    out = _updates(t, so.windowed(_events(t), "ts", ["event_type"], sums, "6 hours"), ["start", "event_type"])
    return out.select(F.date_format("start", TIME_TEXT).alias("start_"), "event_type", "n", "total")


@case("q_stream_sliding", """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start_, count(*) AS n FROM (
  SELECT unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS s FROM events) GROUP BY 1""")
def stream_sliding(t: Tables) -> DataFrame:
    out = _updates(t, so.windowed(_events(t), "ts", [], [F.count("*").alias("n")], "12 hours", "6 hours"), ["start"])
    return out.select(F.date_format("start", TIME_TEXT).alias("start_"), "n")


@case("q_stream_panes", """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start_, event_type, count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents FROM (
  SELECT event_type, CAST(round(value * 100) AS BIGINT) AS cents, time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(5 * i) AS s FROM events, range(288) AS r(i)) GROUP BY ALL""")
def stream_panes(t: Tables) -> DataFrame:
    """Windows of a day every five minutes: the stream sums panes, each of which is two rows of the result, not 288."""
    sums = [F.count("*").alias("n"), F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("cents")]
    panes = _updates(t, so.windowed(_events(t), "ts", ["event_type"], sums, "5 minutes"), ["start", "event_type"])
    out = so.windows_of_panes(panes, "start", ["event_type"], ["n", "cents"], 86_400, 300)
    return out.select(F.date_format("start", TIME_TEXT).alias("start_"), "event_type", "n", "cents")


@case("q_stream_closed_windows", """
SELECT strftime(b, '%Y-%m-%d %H:%M:%S') AS start_, count(*) AS n FROM (SELECT time_bucket(INTERVAL 1 DAY, ts) AS b FROM events)
WHERE b + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR GROUP BY 1""")
def stream_closed_windows(t: Tables) -> DataFrame:
    """Append mode gives a window once, when the watermark has passed its end."""
    stream = so.windowed(_events(t), "ts", [], [F.count("*").alias("n")], "1 day")
    return _appended(t, stream).select(F.date_format("start", TIME_TEXT).alias("start_"), "n")


@case("q_stream_session", """
WITH gaps AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM gaps),
s AS (SELECT user_id, min(ts) AS a, max(ts) AS b, count(*) AS n FROM numbered GROUP BY user_id, sid)
SELECT user_id, strftime(a, '%Y-%m-%d %H:%M:%S') AS start_, n FROM s WHERE b + INTERVAL 4 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_session(t: Tables) -> DataFrame:
    stream = so.sessions(_events(t), "ts", ["user_id"], [F.count("*").alias("n")], "4 hours")
    return _appended(t, stream).select("user_id", F.date_format("start", TIME_TEXT).alias("start_"), "n")


@case("q_stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    """The watermark is longer than the data, so each pair comes once."""
    stream = so.first_seen(_events(t, "400 days"), ["user_id", "event_type"])
    return _appended(t, stream.select("user_id", "event_type"))


@case("q_stream_static_join", """
SELECT c_mktsegment, count(*) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY 1""")
def stream_static_join(t: Tables) -> DataFrame:
    joined = _events(t).join(t.customer, F.col("user_id") == F.col("c_custkey"))
    return _updates(t, joined.groupBy("c_mktsegment").agg(F.count("*").alias("n")), ["c_mktsegment"])


@case("q_stream_stream_join", """
SELECT a.event_id AS view_id, b.event_id AS buy_id FROM events a JOIN events b ON a.user_id = b.user_id AND a.event_type = 'view' AND b.event_type = 'purchase'
AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 2 HOUR""")
def stream_stream_join(t: Tables) -> DataFrame:
    views = _events(t).where("event_type = 'view'").select(F.col("event_id").alias("view_id"), "user_id", "ts")
    buys = _events(t).where("event_type = 'purchase'").select(
        F.col("event_id").alias("buy_id"), F.col("user_id").alias("user_id_right"), F.col("ts").alias("bought_at")
    )
    return _appended(t, so.within(views, buys, ["user_id"], "ts", "bought_at", "2 HOURS").select("view_id", "buy_id"))


@case("q_stream_keyed_state", "SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def stream_keyed_state(t: Tables) -> DataFrame:
    stream = so.running_totals(table_stream(t.spark, t.folder, "events"), "user_id", "value")
    return _updates(t, stream, ["user_id"]).select("user_id", "n", F.round("total", 2).alias("total"))


@case("q_stream_quiet_users", """
SELECT user_id, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) + coalesce(max(CAST(round(c_acctbal) AS BIGINT)), 0) AS BIGINT) AS total
FROM events LEFT JOIN customer ON user_id = c_custkey GROUP BY user_id
HAVING max(ts) + INTERVAL 24 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_quiet_users(t: Tables) -> DataFrame:
    """Users without an event for a day, by timers of the event time; totals begin with the customer's balance."""
    own = Tables(state_session(t.spark), t.folder)
    events = _events(own).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    base = scratch(t.spark, "quiet")
    finish(append_files(quiet_totals(events, "user_id", "cents", "ts", 86_400_000, starting_totals(own)), f"{base}/out", f"{base}/state"))
    return t.spark.read.schema("user_id bigint, n bigint, total bigint").parquet(f"{base}/out")


def starting_totals(t: Tables) -> DataFrame:
    """(user_id, total): the balances of the customers that have events, a null key like any other.

    A customer without events would only hold state with no timer and never be given, at a
    call into Python per key; most customers have none.
    """
    first = t.customer.select(F.col("c_custkey").alias("user_id"), F.round("c_acctbal").cast("bigint").alias("total"))
    users = t.events.select(F.col("user_id").alias("seen")).distinct()
    return first.join(users, first["user_id"].eqNullSafe(users["seen"]), "left_semi")


@case("q_stream_batch_upsert", "SELECT user_id, max(ts) AS last_seen FROM events GROUP BY 1")
def stream_batch_upsert(t: Tables) -> DataFrame:
    """Each batch is cut to its newest row per key before it is written."""
    base = scratch(t.spark, "upsert")
    stream = table_stream(t.spark, t.folder, "events").select("user_id", "ts")

    def newest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id").agg(F.max("ts").alias("last_seen"))

    finish(batch_folders(stream, f"{base}/out", f"{base}/state", "append", newest))
    return latest_updates(t.spark, f"{base}/out", ["user_id"])


@case("q_stream_union", """
SELECT kind, count(*) AS n FROM (SELECT 'event' AS kind FROM events UNION ALL SELECT 'turn' FROM conversations) GROUP BY 1""")
def stream_union(t: Tables) -> DataFrame:
    a = table_stream(t.spark, t.folder, "events").select(F.lit("event").alias("kind"))
    b = table_stream(t.spark, t.folder, "conversations").select(F.lit("turn").alias("kind"))
    return _updates(t, a.union(b).groupBy("kind").agg(F.count("*").alias("n")), ["kind"], "complete")
