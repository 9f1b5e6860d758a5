"""Query cases: Python functions in Arrow batches, per row only where that is the feature.

A grouped Python function gets its whole group at once. So small groups (the lines of
an order) are handed over many to a call, and a large group is cut in parts whose
results are merged after by Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.batches import bucket_count, bucket_of
from millrace.plans.registry import Tables, case


@case("q_udf_row", "SELECT p_partkey, p_type || '-' || p_size AS tag FROM part")
def udf_row(t: Tables) -> DataFrame:
    @F.udf("string")
    def tag(kind, size):
        return None if kind is None else f"{kind}-{size}"

    return t.part.select("p_partkey", tag("p_type", "p_size").alias("tag"))


@case("q_udf_nondeterministic", "SELECT count(*) AS n, TRUE AS in_range FROM part")
def udf_nondeterministic(t: Tables) -> DataFrame:
    @F.udf("double")
    def draw():
        import random

        return random.random()

    drawn = t.part.select(draw.asNondeterministic()().alias("u"))
    return drawn.agg(F.count("*").alias("n"), F.bool_and(F.col("u").between(0, 1)).alias("in_range"))


@case("q_udf_registered", "SELECT c_custkey, length(c_name)::BIGINT * 2 AS twice FROM customer")
def udf_registered(t: Tables) -> DataFrame:
    @F.pandas_udf("bigint")
    def twice_length(names: pd.Series) -> pd.Series:
        return names.str.len() * 2

    t.spark.udf.register("millrace_twice_length", twice_length)
    return t.sql("SELECT c_custkey, millrace_twice_length(c_name) AS twice FROM {customer}")


@case("q_pandas_udf_scalar", "SELECT l_orderkey, l_partkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem")
def pandas_udf_scalar(t: Tables) -> DataFrame:
    @F.pandas_udf("double")
    def net(price: pd.Series, discount: pd.Series) -> pd.Series:
        return price * (1 - discount)

    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.round(net("l_extendedprice", "l_discount"), 4).alias("net"))


@case("q_pandas_udf_iterator", "SELECT doc_id, len(string_split(text, ' '))::BIGINT AS pieces FROM documents")
def pandas_udf_iterator(t: Tables) -> DataFrame:
    @F.pandas_udf("bigint")
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.str.count(" ") + 1

    return t.documents.select("doc_id", pieces("text").alias("pieces"))


@case("q_pandas_udf_grouped", """
SELECT l_returnflag, round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 4) AS weighted FROM lineitem GROUP BY 1""")
def pandas_udf_grouped(t: Tables) -> DataFrame:
    """A weighted mean per flag: the function sees a part of a flag, Spark adds the parts."""

    @F.pandas_udf("double")
    def weighted_sum(values: pd.Series, weights: pd.Series) -> float:
        return float((values * weights).sum())

    lines = t.lineitem
    part = bucket_of(["l_orderkey"], bucket_count(lines)).alias("part")
    parts = lines.groupBy("l_returnflag", part).agg(weighted_sum("l_extendedprice", "l_quantity").alias("s"))
    weights = lines.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("w"))
    whole = parts.groupBy("l_returnflag").agg(F.sum("s").alias("s")).join(weights, "l_returnflag")
    return whole.select("l_returnflag", F.round(F.col("s") / F.col("w"), 4).alias("weighted"))


@case("q_pandas_udf_window", """
SELECT conv_id, turn, round(median(length(text)) OVER (PARTITION BY conv_id), 4) AS mid FROM conversations""")
def pandas_udf_window(t: Tables) -> DataFrame:
    """A window is one talk, which has few turns."""
    from pyspark.sql import Window

    @F.pandas_udf("double")
    def mid(values: pd.Series) -> float:
        return values.median()

    over = mid(F.length("text")).over(Window.partitionBy("conv_id"))
    return t.conversations.select("conv_id", "turn", F.round(over, 4).alias("mid"))


@case("q_map_in_pandas", """
SELECT event_type, count(*) AS n, round(sum(value * value), 2) AS squares FROM events GROUP BY 1""")
def map_in_pandas(t: Tables) -> DataFrame:
    """Each batch gives its own sums; Spark merges them."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            grouped = b.assign(squares=b["value"] ** 2).groupby("event_type")
            yield grouped.agg(n=("value", "size"), squares=("squares", "sum")).reset_index()

    parts = t.events.select("event_type", "value").mapInPandas(sums, "event_type string, n bigint, squares double")
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.round(F.sum("squares"), 2).alias("squares"))


@case("q_map_in_arrow", "SELECT o_orderkey, o_totalprice * 2 AS doubled FROM orders WHERE o_totalprice > 100000")
def map_in_arrow(t: Tables) -> DataFrame:
    def doubled(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            kept = b.filter(pc.greater(b.column("o_totalprice"), 100000.0))
            yield pa.RecordBatch.from_arrays(
                [kept.column("o_orderkey"), pc.multiply(kept.column("o_totalprice"), 2.0)], names=["o_orderkey", "doubled"]
            )

    return t.orders.select("o_orderkey", "o_totalprice").mapInArrow(doubled, "o_orderkey bigint, doubled double")


@case("q_apply_in_pandas", """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, round(l_quantity - avg(l_quantity) OVER (PARTITION BY l_orderkey), 6) AS centred FROM lineitem""")
def apply_in_pandas(t: Tables) -> DataFrame:
    """Each call gets whole orders, many of them."""

    def centre(pdf: pd.DataFrame) -> pd.DataFrame:
        mean = pdf.groupby("l_orderkey")["l_quantity"].transform("mean")
        out = pdf[["l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"]].copy()
        out["centred"] = (pdf["l_quantity"] - mean).round(6)
        return out

    df = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity")
    schema = "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_suppkey bigint, centred double"
    return df.groupBy(bucket_of(["l_orderkey"], bucket_count(df)).alias("bucket")).applyInPandas(centre, schema)


@case("q_apply_in_pandas_salted", """
SELECT l_returnflag, count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 6) AS slope FROM lineitem GROUP BY 1""")
def apply_in_pandas_salted(t: Tables) -> DataFrame:
    """A fit per flag: each flag is large, so salted parts give sums that are merged into the fit."""

    def sums(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf["l_quantity"], pdf["l_extendedprice"]
        return pd.DataFrame({
            "l_returnflag": [pdf["l_returnflag"].iloc[0]], "n": [len(pdf)],
            "sx": [x.sum()], "sy": [y.sum()], "sxy": [(x * y).sum()], "sxx": [(x * x).sum()],
        })

    salt = bucket_of(["l_orderkey"], bucket_count(t.lineitem)).alias("salt")
    df = t.lineitem.select("l_returnflag", "l_quantity", "l_extendedprice", salt)
    parts = df.groupBy("l_returnflag", "salt").applyInPandas(sums, "l_returnflag string, n bigint, sx double, sy double, sxy double, sxx double")
    whole = parts.groupBy("l_returnflag").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxy", "sxx")])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    slope = (n * F.col("sxy") - sx * sy) / (n * F.col("sxx") - sx * sx)
    return whole.select("l_returnflag", "n", F.round(slope, 6).alias("slope"))


@case("q_cogroup_in_pandas", """
SELECT o_orderkey, count(l_orderkey) AS lines, round(coalesce(max(l_extendedprice), 0) - any_value(o_totalprice), 2) AS gap FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""")
def cogroup_in_pandas(t: Tables) -> DataFrame:
    """Orders and their lines meet in pandas, many orders to a call."""

    def gap(orders: pd.DataFrame, lines: pd.DataFrame) -> pd.DataFrame:
        stats = lines.groupby("l_orderkey")["l_extendedprice"].agg(lines="size", top="max")
        both = orders.join(stats, on="o_orderkey").fillna({"lines": 0, "top": 0.0})
        both["gap"] = (both["top"] - both["o_totalprice"]).round(2)
        return both[["o_orderkey", "lines", "gap"]].astype({"lines": "int64"})

    buckets = bucket_count(t.lineitem)
    orders = t.orders.select("o_orderkey", "o_totalprice").groupBy(bucket_of(["o_orderkey"], buckets))
    lines = t.lineitem.select("l_orderkey", "l_extendedprice").groupBy(bucket_of(["l_orderkey"], buckets))
    return orders.cogroup(lines).applyInPandas(gap, "o_orderkey bigint, lines bigint, gap double")


@case("q_vector_round_trip", "SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 6) AS head, len(embedding)::INTEGER AS n FROM embeddings")
def vector_round_trip(t: Tables) -> DataFrame:
    back = vector_to_array(array_to_vector(F.col("embedding").cast("array<double>")))
    return t.embeddings.select("vec_id", F.round(back[0], 6).alias("head"), F.size(back).alias("n"))


@case("q_rows_from_pandas", "SELECT o_orderpriority, CAST(left(o_orderpriority, 1) AS BIGINT) AS level, count(*) AS n FROM orders GROUP BY 1")
def rows_from_pandas(t: Tables) -> DataFrame:
    """A small local code table beside the orders: the frame is made from pandas by Arrow."""
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    codes = t.spark.createDataFrame(pd.DataFrame({"o_orderpriority": names, "level": range(1, 6)}))
    counts = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return counts.join(codes, "o_orderpriority").select("o_orderpriority", "level", "n")
