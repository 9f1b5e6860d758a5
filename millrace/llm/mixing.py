"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations only.

Sources in order of code point, null last, get weights in turn; together they are to give a
share of all words. A source's target stops at a multiple of its size and what is left over
goes to the others by weight, until none is above. A target of `e` sizes and a rest is `e`
complete epochs and a sample: every document draws the key `-ln(u) / weight`, with `u` from
a hash of its id and `weight` from its quality, and the smallest keys are taken until their
words reach the rest. The document at the edge is taken if that comes closer to the target.

Hot sources: keys are cut in `CUTS` ranges by `exp(-key)`. A partial aggregate sums the words
of each (source, range); the sums tell in which range the budget ends; only that range's
documents are sorted, the ranges before it are taken whole. No task sorts a source.

Nulls and ties: a null text has size 0; a null source is a source of its own; a null doc_id
draws as the text 'null:' and its size. Rows of equal key and id are taken in order of their size; rows
that repeat in all of these are interchangeable. Weights must be above zero. An empty table
gives no rows; further columns are kept by `mix` and never read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.frames import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5     # of all words
MOST = 2        # times a source's or a document's size
CUTS = 4096
SEED = "mix-1"


def words(column: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(column: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from a hash of the value's text: the same at every run, and in other engines."""
    head = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(column.cast("string"), F.lit("null"))).cast("binary")), 1, 12)
    return (F.conv(head, 16, 10).cast("double") + 0.5) / F.lit(2.0**48)


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Per source of `sizes` (source, source_size): weight and target. One row per source is sorted in one place.

    Sources reach their cap in order of cap / weight. With the first k capped, the others get
    `level * weight` for `level = (total - caps) / weights left`; the first k whose level
    leaves the next one under its cap is the answer.
    """
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.pmod(F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1, F.lit(len(weights))) + 1).cast("int"))
    given = sizes.withColumn("weight", pick).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    every, before = Window.partitionBy(), order.rowsBetween(Window.unboundedPreceding, -1)
    stepped = given.withColumn("level", (
        F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    open_ = F.col("level") * F.col("weight") <= F.col("cap")
    settled = stepped.withColumn("level", F.min(F.when(open_, F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(every)["level"])
    # a share that no cap leaves room for gives every source its cap
    return settled.select("source", "source_size", "weight",
                          F.coalesce(F.least("cap", F.col("level") * F.col("weight")), F.col("cap")).alias("target"))


def taken(rows: DataFrame, quality: str = "quality", cuts: int = CUTS, **options) -> DataFrame:
    """`rows` (source, size, doc_id, `quality`: a weight above zero) with source_size, target and copies.

    `rows` is read three times, so give it written.
    """
    # rows without an id draw by their size, so that they don't all draw the same
    key = -F.log(uniform(F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.col("size"))))) / F.col(quality)
    keyed = (rows.withColumn("key", key)
             .withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * cuts).cast("bigint")))
    ranges = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    sums = ranges.groupBy("source").agg(F.sum("range_size").alias("source_size"))
    goal = targets(sums, **options)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    goal = goal.withColumn("epochs", epochs).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    same_source = F.col("r.source").eqNullSafe(F.col("g.source"))
    plan = (ranges.withColumn("before", F.coalesce(F.sum("range_size").over(along), F.lit(0).cast("bigint"))).alias("r")
            .join(goal.alias("g"), same_source)
            .select("r.source", "range", "before", "range_size", "source_size", "target", "epochs", "rest"))
    here = F.col("k.source").eqNullSafe(F.col("p.source")) & (F.col("k.range") == F.col("p.range"))
    dealt = (keyed.alias("k").join(plan.alias("p"), here)
             .select("k.*", "before", "range_size", "source_size", "target", "epochs", "rest"))
    in_whole = F.col("before") + F.col("range_size") <= F.col("rest")
    # the range in which the budget ends; those behind it are left
    edge = ~in_whole & (F.col("before") < F.col("rest"))
    order = Window.partitionBy("source", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.col("before") + F.sum("size").over(order)
    closer = F.col("rest") - (upto - F.col("size")) >= upto - F.col("rest")
    at_edge = dealt.where(edge).withColumn("more", (upto <= F.col("rest")) | ((upto - F.col("size") < F.col("rest")) & closer))
    others = dealt.where(~edge).withColumn("more", in_whole)
    return (others.unionByName(at_edge).withColumn("copies", F.col("epochs") + F.col("more").cast("bigint"))
            .drop("key", "range", "before", "range_size", "epochs", "rest", "more"))


def quality_weights(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, source, size and quality: 2 for rows labelled good, 0.5 for bad ones, 1 where no label says."""
    scores = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
              .agg(F.pow(F.lit(2.0), 2 * F.avg("quality") - 1).alias("quality")))
    rows = docs.select("doc_id", "source", words("text").alias("size"))
    return (rows.alias("d").join(scores.alias("s"), F.col("d.doc_id") == F.col("s.doc_id"), "left")
            .select("d.*", F.coalesce("s.quality", F.lit(1.0)).alias("quality")))


def mixture(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted) for every row of `docs`."""
    rows = written(quality_weights(docs, labels), "sizes")
    return (taken(rows, **options)
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "source"))


def mix(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The mixed documents with all their columns, as many rows as copies are taken."""
    rows = written(quality_weights(docs, labels), "sizes")
    # rows that repeat a doc_id in a source share their copies evenly, the first ones get one more
    draws = (taken(rows, **options).groupBy("doc_id", "source", "size")
             .agg(F.sum("copies").alias("copies"), F.count("*").alias("n")))
    whole = written(draws.where("copies <> n OR n > 1"), "copies")
    # the row as one value: its columns may have any names
    d, c = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).alias("d"), whole.alias("c")
    match = (F.col("d.row.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.row.source").eqNullSafe(F.col("c.source"))
             & (words("d.row.text") == F.col("c.size")))
    joined = d.join(c, match, "left").select("d.row", "c.copies", "c.n")
    once = joined.where("n IS NULL OR n = 1").withColumn("copies", F.coalesce("copies", F.lit(1)))
    out = once
    if not whole.where("n > 1").isEmpty():
        nth = F.row_number().over(Window.partitionBy("row.doc_id", "row.source", words("row.text")).orderBy("row.text"))
        share = F.floor(F.col("copies") / F.col("n")) + (nth <= F.col("copies") % F.col("n")).cast("bigint")
        out = once.unionByName(joined.where("n > 1").withColumn("copies", share))
    copies = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies").cast("bigint")))
    return out.where("copies > 0").withColumn("copy", copies).select("row.*")
