"""Query cases: date, time and timestamp functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import Tables, case


def day_text(column: Column, name: str) -> Column:
    return column.cast("string").alias(name)


@case("q_date_parts", """
SELECT o_orderkey, year(o_orderdate)::INTEGER AS y, quarter(o_orderdate)::INTEGER AS q, month(o_orderdate)::INTEGER AS m, (dayofweek(o_orderdate) + 1)::INTEGER AS dow,
       day(o_orderdate)::INTEGER AS d, dayofyear(o_orderdate)::INTEGER AS doy, weekofyear(o_orderdate)::INTEGER AS w FROM orders""")
def date_parts(t: Tables) -> DataFrame:
    c = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.year(c).alias("y"), F.quarter(c).alias("q"), F.month(c).alias("m"), F.dayofweek(c).alias("dow"),
        F.dayofmonth(c).alias("d"), F.dayofyear(c).alias("doy"), F.weekofyear(c).alias("w"),
    )


@case("q_time_parts", """
SELECT event_id, hour(ts)::INTEGER AS h, minute(ts)::INTEGER AS mi, second(ts)::INTEGER AS s FROM events""")
def time_parts(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.hour("ts").alias("h"), F.minute("ts").alias("mi"), F.second("ts").alias("s"))


@case("q_date_format", """
SELECT event_id, strftime(ts, '%d/%m/%Y %H:%M:%S') AS f1, strftime(ts, '%Y%m%d') AS f2 FROM events""")
def date_format(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.date_format("ts", "dd/MM/yyyy HH:mm:ss").alias("f1"), F.date_format("ts", "yyyyMMdd").alias("f2"))


@case("q_date_arithmetic", """
SELECT o_orderkey, CAST(d + 10 AS VARCHAR) AS plus, CAST(d - 10 AS VARCHAR) AS minus, date_diff('day', DATE '1995-01-01', d)::INTEGER AS since,
       CAST(CAST(d + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_month, CAST(last_day(d) AS VARCHAR) AS month_end, CAST(make_date(year(d), month(d), 1) AS VARCHAR) AS made
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_arithmetic(t: Tables) -> DataFrame:
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", day_text(F.date_add(d, 10), "plus"), day_text(F.date_sub(d, 10), "minus"),
        F.datediff(d, F.lit("1995-01-01").cast("date")).alias("since"), day_text(F.add_months(d, 1), "next_month"), day_text(F.last_day(d), "month_end"),
        day_text(F.make_date(F.year(d), F.month(d), F.lit(1)), "made"),
    )


@case("q_date_truncate", """
SELECT event_id, CAST(CAST(date_trunc('month', ts) AS DATE) AS VARCHAR) AS mon, CAST(CAST(date_trunc('year', ts) AS DATE) AS VARCHAR) AS yr,
       CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS wk, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hr FROM events""")
def date_truncate(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", day_text(F.trunc("ts", "month"), "mon"), day_text(F.trunc("ts", "year"), "yr"), day_text(F.trunc("ts", "week"), "wk"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("hr"),
    )


@case("q_date_next_day", """
SELECT o_orderkey, CAST(d + CAST(7 - (isodow(d) - 1 + 7) % 7 AS INTEGER) AS VARCHAR) AS monday FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_next_day(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", day_text(F.next_day(F.to_date("o_orderdate"), "Mon"), "monday"))


@case("q_date_months_between", """
SELECT o_orderkey, CASE WHEN day(d) = 1 THEN CAST(date_diff('month', DATE '1995-01-01', d) AS DOUBLE)
       ELSE round(date_diff('month', DATE '1995-01-01', d) + (day(d) - 1) / 31.0, 8) END AS months
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def date_months_between(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.months_between(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")).alias("months"))


@case("q_date_parse", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 6 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d 07:30:00') END AS at
FROM orders""".replace("AS at", 'AS "at"'))
def date_parse(t: Tables) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy.MM.dd")
    timed = F.when(F.col("o_orderkey") % 6 == 0, F.lit("13:99")).otherwise(F.concat(text, F.lit(" 07:30:00")))
    return t.orders.select(
        "o_orderkey", day_text(F.to_date(text, "yyyy.MM.dd"), "day"),
        F.date_format(F.try_to_timestamp(timed, F.lit("yyyy.MM.dd HH:mm:ss")), "yyyy-MM-dd HH:mm:ss").alias("at"),
    )


@case("q_date_epoch", """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS secs, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text_, strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_secs,
       CAST(floor(epoch(ts)) AS BIGINT) AS parsed FROM events""")
def date_epoch(t: Tables) -> DataFrame:
    secs = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return t.events.select(
        "event_id", secs.alias("secs"), F.from_unixtime(secs).alias("text_"),
        F.date_format(F.timestamp_seconds(secs), "yyyy-MM-dd HH:mm:ss").alias("from_secs"),
        F.unix_timestamp(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("parsed"),
    )


@case("q_date_zones", """
SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS local_, strftime(ts + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS utc_ FROM events""")
def date_zones(t: Tables) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id", F.date_format(F.from_utc_timestamp(ts, "America/Sao_Paulo"), "yyyy-MM-dd HH:mm:ss").alias("local_"),
        F.date_format(F.to_utc_timestamp(ts, "America/Sao_Paulo"), "yyyy-MM-dd HH:mm:ss").alias("utc_"),
    )


@case("q_date_current", "SELECT count(*) AS n, TRUE AS later, TRUE AS same_day FROM orders")
def date_current(t: Tables) -> DataFrame:
    now = F.current_timestamp()
    return t.orders.agg(
        F.count("*").alias("n"), F.bool_and(F.col("o_orderdate") < now).alias("later"),
        F.bool_and(F.to_date(now) == F.current_date()).alias("same_day"),
    )


# -- time buckets -----------------------------------------------------------------------

@case("q_window_tumbling", """
SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start_, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2""")
def window_tumbling(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "6 hours").alias("w"), "event_type").agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
    ).select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start_"), "event_type", "n", "total")


@case("q_window_sliding", """
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start_, count(*) AS n FROM (
  SELECT unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS s FROM events) GROUP BY 1""")
def window_sliding(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "12 hours", "6 hours").alias("w")).agg(F.count("*").alias("n")).select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start_"), "n"
    )


@case("q_window_offset", """
SELECT strftime(time_bucket(INTERVAL 1 DAY, ts, INTERVAL 9 HOUR), '%Y-%m-%d %H:%M:%S') AS start_, count(*) AS n FROM events GROUP BY 1""")
def window_offset(t: Tables) -> DataFrame:
    return t.events.groupBy(F.window("ts", "1 day", startTime="9 hours").alias("w")).agg(F.count("*").alias("n")).select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start_"), "n"
    )


@case("q_window_session", """
WITH gaps AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 4 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM gaps)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start_, count(*) AS n, round(sum(value), 2) AS total FROM numbered GROUP BY user_id, sid""")
def window_session(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id", F.session_window("ts", "4 hours").alias("w")).agg(
        F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total")
    ).select("user_id", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("start_"), "n", "total")
