"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model.

The model predicts the UTF-8 bytes of words, from a blank before to the blank behind, each
from up to `ORDER` - 1 bytes before it in the word. An n-gram is one number: its bytes, first
byte highest, under a leading one. So the context is `id >> 8`, the shorter n-gram a mask
away, and all counts are sums, groups and equi-joins on numbers that Spark deals out.

* Training text: documents labelled good, dealt in `FOLDS` folds by id hash. Model `m` is of
  all folds but `m` and scores the documents of fold `m`, so no document is scored by a model
  that has seen it, trusted or not. All models are built together, by (m, n-gram).
* Longest n-grams are counted; a shorter one counts the different bytes before it, but one that
  begins a word has no byte before it and keeps its own count. Each order has three discounts.
* Score of a byte at a place: with `p_k` the interpolated chance at order k and `g` the
  weight that a context leaves to shorter ones, `log p_K = log 1/256 + sum over k of
  log g(context_k) + sum over seen k of d(gram_k)`, where `d = log p_k - log g - log p_(k-1)`.
  So a document's score is a sum over its n-grams, each with two numbers of its own.
* The `HEAD` most used n-grams of a model go to every task, a bound on what is sent. The rest
  stay dealt out: a batch asks once for each n-gram of a different word that a bit filter lets
  through, and the join's sums by word are added to its documents. Texts are read once for it.
* A document goes whose log perplexity is above its language's threshold: the median of the
  language's n trusted rows, plus their `QUANTILE` of what is above the median, drawn by
  `n / (n + DRAW)` to that of all languages, plus `MARGIN` standard deviations of all over the
  root of n. So a language of few trusted rows is judged mildly and one of none not at all,
  by one rule at every size. Texts without words go.

Ties: rows that repeat an id and text score alike. Nulls: a null text has no words, a null
lang is a language of its own, a null doc_id or label is never trusted, labels of one id are
averaged. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import bytes_of, hash_words, mixed, slices, trim, words_of, written

ORDER = 5       # an id holds up to 7 bytes
QUANTILE = 0.995
FOLDS = 2
DRAW = 100.0
MARGIN = 2.0
HEAD = 1 << 17
FILTER_BITS = 1 << 26
SLICE_BYTES = 4 << 20  # of text at a time; what a slice makes is freed before the next, so a worker stays small
WORDS = 1 << 15  # different words looked at together, so that the arrays between stay small
_BLANK = 0x20
_WORD_KEYS = ("millrace-llm-key", "millrace-llm-two")  # 128 bits that tell words apart


def grams(words: pa.Array, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(ids of the n-grams that end at each predicted byte, by order; 0 where the word is too short), word and place of each byte."""
    data, at = bytes_of(words)
    sizes = np.diff(at)
    # blank, bytes, blank for each word; the first blank is not predicted
    text = np.full(at[-1] + 2 * len(sizes), _BLANK, dtype=np.uint64)
    start = at[:-1] + 2 * np.arange(len(sizes))
    inside = np.ones(len(text), dtype=bool)
    inside[start] = inside[start + sizes + 1] = False
    text[inside] = data
    word = np.repeat(np.arange(len(sizes)), sizes + 2)
    place = np.arange(len(text)) - start[word] if len(text) else np.zeros(0, np.int64)
    out, rolled = [], np.zeros(len(text), dtype=np.uint64)
    for k in range(1, order + 1):
        shifted = np.zeros(len(text), dtype=np.uint64)
        shifted[k - 1:] = text[:len(text) - k + 1] if k > 1 else text
        rolled = rolled | shifted << np.uint64(8 * (k - 1))
        out.append(np.where(place >= k - 1, rolled | np.uint64(1) << np.uint64(8 * k), np.uint64(0)))
    return out, word, place


def longest(words: pa.Array, times: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, count) of the longest n-gram of every predicted byte."""
    found, counts = [], []
    for at in range(0, len(words), WORDS):
        ids, word, place = grams(words.slice(at, WORDS), order)
        top = ids[-1]
        for k in range(order - 1, 1, -1):
            short = place == k - 1
            top[short] = ids[k - 1][short]
        seen, back = np.unique(top[place > 0], return_inverse=True)
        found.append(seen)
        counts.append(np.bincount(back, times[at:at + WORDS][word[place > 0]], minlength=len(seen)))
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    seen, back = np.unique(np.concatenate(found), return_inverse=True)
    return seen, np.bincount(back, np.concatenate(counts), minlength=len(seen)).astype(np.int64)


def count(texts: DataFrame, order: int, others: bool = False) -> DataFrame:
    """(m, id, raw): longest n-grams of the texts of each `m`, with their counts; with `others`, of all folds but `m`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            for m, part in parted(batch):
                codes, _, words = words_of(part["text"])
                times = np.bincount(codes, minlength=len(words))
                ids, n = longest(words.filter(pa.array(times > 0)), times[times > 0], order)  # white space at an end leaves an empty one
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), m)), pa.array(ids.astype(np.int64)), pa.array(n)], ["m", "id", "raw"])
            trim()

    rows = texts.select("text", "m").mapInArrow(run, "m bigint, id bigint, raw bigint")
    if others:
        folds = F.sequence(F.lit(0).cast("bigint"), F.lit(FOLDS - 1).cast("bigint"))
        rows = rows.withColumn("m", F.explode(F.array_remove(folds, F.col("m"))))
    return rows.groupBy("m", "id").agg(F.sum("raw").alias("raw"))


def parted(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each `m` of a batch."""
    own = batch["m"].to_numpy()
    for m in np.unique(own):
        yield int(m), batch.filter(pa.array(own == m))


def model(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """(m, id, uses, delta, log_gamma) for every n-gram of every model, from counts (m, id, raw) of the longest ones; id 1 is the empty context."""
    bytes_ = F.floor((F.length(F.conv(F.col("id").cast("string"), 10, 16)) - 1) / 2).cast("int")  # of an id, behind its leading one
    shorter = lambda k: F.col("id").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), 8 * k) - 1).bitwiseOR(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), 8 * k))
    ends = F.explode(F.transform(F.sequence(F.lit(1), bytes_), shorter))
    types = written(counts.select("m", ends.alias("id"), "raw").groupBy("m", "id").agg(F.sum("raw").alias("raw")).withColumn("k", bytes_), "types")
    # different bytes before an n-gram; none is before one that begins a word
    before = types.where("k > 1").select("m", shorter(F.col("k") - 1).alias("id")).groupBy("m", "id").agg(F.count("*").alias("n"))
    grams = written(types.join(before, ["m", "id"], "left").select("m", "id", "raw", "k", F.when(F.col("k") == order, F.col("raw")).otherwise(F.coalesce("n", "raw")).alias("n")), "grams")
    grams = grams.withColumn("context", F.shiftright("id", 8)).withColumn("taken", _discount(grams))
    contexts = written(grams.groupBy("m", "context").agg(F.sum("n").alias("total"), (F.sum("taken") / F.sum("n")).alias("gamma")), "contexts")
    own = (F.col("n") - F.col("taken")) / F.col("total")
    parts = written(grams.join(contexts, ["m", "context"]).select("m", "id", "k", "raw", own.alias("own"), "gamma"), "parts")
    out = None
    for k in range(1, order + 1):
        rows = parts.where(F.col("k") == k)
        if out is None:
            rows = rows.withColumn("lower", F.lit(1 / 256))
        else:
            rows = rows.withColumn("shorter", shorter(F.lit(k - 1))).join(below, ["m", "shorter"])
        rows = written(rows.select("m", "id", F.col("raw").alias("uses"), (F.col("own") + F.col("gamma") * F.col("lower")).alias("p"), "gamma", "lower"), f"chances{k}")
        below = rows.select("m", F.col("id").alias("shorter"), F.col("p").alias("lower"))
        deltas = rows.select("m", "id", "uses", (F.log("p") - F.log("gamma") - F.log("lower")).alias("delta"))
        out = deltas if out is None else out.unionByName(deltas)
    left = contexts.select("m", F.col("context").alias("id"), F.log("gamma").alias("log_gamma"))
    return (out.join(left, ["m", "id"], "full")
            .select("m", "id", F.coalesce("uses", F.lit(1 << 62)).alias("uses"), F.coalesce("delta", F.lit(0.0)).cast("float").alias("delta"),
                    F.coalesce("log_gamma", F.lit(0.0)).cast("float").alias("log_gamma")))


def _discount(rows: DataFrame) -> Column:
    """What is taken of a count, by model and order: three discounts from how many n-grams have each of the counts 1 to 4."""
    found: dict[tuple[int, int], list[float]] = {}
    for r in rows.groupBy("m", "k").agg(*[F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).collect():  # a row for each order of a model
        y = r.n1 / (r.n1 + 2 * r.n2) if r.n1 else 0.0
        raw = [i - (i + 1) * y * b / a if a and b else 0.5 for i, a, b in ((1, r.n1, r.n2), (2, r.n2, r.n3), (3, r.n3, r.n4))]
        found[r.m, r.k] = [min(max(x, 0.1), i - 0.1) for i, x in enumerate(raw, 1)]
    models = 1 + max((m for m, _ in found), default=0)
    most = 1 + max((k for _, k in found), default=0)
    every = F.array(*[F.lit(found.get((m, k), [0.5] * 3)[i]) for m in range(models) for k in range(most) for i in range(3)])
    return F.get(every, ((F.col("m") * most + F.col("k")) * 3 + F.least("n", F.lit(3)) - 1).cast("int"))


class Head:
    """Sorted ids of a model with their two numbers, and the bits of the ids that stay dealt out."""

    def __init__(self, m: int, ids: np.ndarray, delta: np.ndarray, log_gamma: np.ndarray, bits: np.ndarray):
        order = np.argsort(ids)
        self.m, self.ids, self.delta, self.log_gamma, self.bits = m, ids[order], delta[order], log_gamma[order], bits
        self.empty = float(self.log_gamma[0]) if len(ids) and self.ids[0] == 1 else 0.0

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(delta, log_gamma, not here but let through by the bits), by id; each different id is looked up once."""
        seen, back = np.unique(ids, return_inverse=True)
        place = np.minimum(np.searchsorted(self.ids, seen), len(self.ids) - 1)
        here = self.ids[place] == seen
        ask = ~here & (seen > 0)
        for n in (0, 1):
            left = np.flatnonzero(ask)
            bit = bit_of(seen[left], self.m, n)
            ask[left] = (self.bits[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
        return np.where(here, self.delta[place], 0.0)[back], np.where(here, self.log_gamma[place], 0.0)[back], ask[back]


def bit_of(ids: np.ndarray, m: int | np.ndarray, n: int) -> np.ndarray:
    step = np.atleast_1d(2 * np.asarray(m, dtype=np.uint64) + np.uint64(n + 1)) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(ids + step) & np.uint64(FILTER_BITS - 1)


def _bits(tail: DataFrame) -> np.ndarray:
    """The bit filter of the dealt-out ids of all models: FILTER_BITS bits, whatever their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, m = batch["id"].to_numpy().astype(np.uint64), batch["m"].to_numpy()
            bits = np.unique(np.concatenate([bit_of(ids, m, 0), bit_of(ids, m, 1)]))
            yield pa.RecordBatch.from_arrays([pa.array((bits >> np.uint64(6)).astype(np.int64)), pa.array((bits & np.uint64(63)).astype(np.int32))], ["at", "bit"])

    words = (tail.select("id", "m").mapInArrow(run, "at bigint, bit int")
             .groupBy("at").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("bit"))).alias("word")).toArrow())
    out = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    out[words["at"].to_numpy()] = words["word"].to_numpy().view(np.uint64)
    return out


def heads(table: DataFrame, head_size: int) -> tuple[dict[int, Head], DataFrame]:
    """The most used n-grams of each model, at most `head_size`, and the others, dealt out."""
    step = F.floor(8 * F.log2(F.col("uses") + 1)).cast("int")  # some five hundred steps of use
    steps = table.groupBy("m", step.alias("step")).agg(F.count("*").alias("n")).collect()
    first = {}
    for m in sorted({r.m for r in steps}):  # FOLDS of them
        held = 0
        for r in sorted((r for r in steps if r.m == m), key=lambda r: -r.step):
            held += r.n
            if held > head_size:
                break
            first[m] = r.step
        first.setdefault(m, 1 << 30)
    least = F.get(F.array(*[F.lit(first.get(m, 1 << 30)) for m in range(1 + max(first, default=0))]), F.col("m").cast("int"))
    tail = table.where(step < least)
    bits, out = _bits(tail), {}
    rows = table.where(step >= least).select("m", "id", "delta", "log_gamma").toArrow()
    for m in first:
        own = rows.filter(pc.equal(rows["m"], m))
        ids = own["id"].to_numpy().astype(np.uint64)
        # an empty table looks nothing up
        ids, delta, gamma = (ids, own["delta"].to_numpy(), own["log_gamma"].to_numpy()) if len(ids) else _NOTHING
        out[m] = Head(m, ids, delta, gamma, bits)
    return out, tail


_NOTHING = np.array([2], np.uint64), np.zeros(1, np.float32), np.zeros(1, np.float32)
_SCORED = "row bigint, doc_id {kind}, tie bigint, lang string, m bigint, n bigint, log_p double, uses array<struct<word:bigint,other:bigint,times:bigint>>, " \
          "word bigint, other bigint, id bigint, predicted bigint, context bigint"


def score(docs: DataFrame, table: DataFrame, order: int = ORDER, head_size: int = HEAD) -> DataFrame:
    """doc_id, tie (hash of the text), lang, n (predicted bytes) and log_p under model `m`, for every row of `docs`."""
    own, tail = heads(table, head_size)
    none = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    for m in range(FOLDS):  # a fold that no model was made for scores each byte by chance
        own.setdefault(m, Head(m, *_NOTHING, none))
    shared = docs.sparkSession.sparkContext.broadcast(own)
    base = docs.select("doc_id", "lang", "text", F.col("m").cast("bigint").alias("m"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tie"))
    schema = _SCORED.format(kind=docs.schema["doc_id"].dataType.simpleString())

    def of_words(head: Head, words: pa.Array) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """(log chance, predicted bytes) by word, and what is asked of the dealt-out n-grams: id, word, times predicted, times context."""
        values, sizes, asks = [np.zeros(0)], [np.zeros(0, np.int64)], [[np.zeros(0, np.int64)] * 4]
        for at in range(0, len(words), WORDS):
            value, n, (ids, word, predicted, context) = of_some(head, words.slice(at, WORDS))
            values.append(value)
            sizes.append(n)
            asks.append((ids, word + at, predicted, context))
        return np.concatenate(values), np.concatenate(sizes), [np.concatenate(x) for x in zip(*asks)]

    def of_some(head: Head, words: pa.Array) -> tuple[np.ndarray, np.ndarray, tuple]:
        ids, word, place = grams(words, order)
        value, asks = np.full(len(word), np.log(1 / 256) + head.empty), [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
        carried, size = None, np.bincount(word)
        for k in range(1, order + 1):
            delta, gamma, ask = head.find(ids[k - 1])
            value += delta
            if k > 1:  # the context of order k is the n-gram of order k - 1 that ends one byte before
                value[1:] += np.where(place[1:] >= k - 1, carried[:-1], 0.0)
            at = np.flatnonzero(ask)
            follows = (place[at] + 1 < size[word[at]]) & (k < order)
            asks.append((ids[k - 1][at], word[at], (place[at] > 0).astype(np.int64), follows.astype(np.int64)))
            carried = gamma
        own = place > 0
        asked, at, predicted, context = (np.concatenate(x) for x in zip(*asks))
        by = np.lexsort((asked, at))
        asked, at = asked[by], at[by]
        first = np.flatnonzero(np.concatenate([[True], (asked[1:] != asked[:-1]) | (at[1:] != at[:-1])])) if len(by) else by
        sums = [np.add.reduceat(x[by], first) if len(by) else x for x in (predicted, context)]
        return (np.bincount(word[own], value[own], minlength=len(words)), np.bincount(word[own], minlength=len(words)),
                (asked[first].astype(np.int64), at[first], *sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text", SLICE_BYTES):
            for m, part in parted(batch):
                codes, at, words = words_of(part["text"])
                value, n, (ids, word, predicted, context) = of_words(shared.value[m], words)
                mine = np.unique(word)
                names = [hash_words(words.take(pa.array(mine)), key).astype(np.int64) for key in _WORD_KEYS]
                # the words of each row that ask
                place = np.full(len(words), -1)
                place[mine] = np.arange(len(mine))
                asking = np.flatnonzero(place[codes] >= 0)
                pairs, times = np.unique(np.repeat(np.arange(len(at) - 1), np.diff(at))[asking] * max(len(mine), 1) + place[codes[asking]], return_counts=True)
                used = pairs % max(len(mine), 1)
                cut = np.searchsorted(pairs, np.arange(len(at)) * max(len(mine), 1)).astype(np.int32)
                uses = pa.ListArray.from_arrays(pa.array(cut), pa.StructArray.from_arrays([*(pa.array(x[used]) for x in names), pa.array(times)], ["word", "other", "times"]))
                total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[codes])])[at])
                yield _record(schema_of, row=np.arange(row, row + part.num_rows), doc_id=part["doc_id"], tie=part["tie"], lang=part["lang"], m=part["m"],
                              n=total(n).astype(np.int64), log_p=total(value), uses=uses)
                row += part.num_rows
                mine = np.searchsorted(mine, word)
                yield _record(schema_of, m=np.full(len(ids), m), word=names[0][mine], other=names[1][mine], id=ids, predicted=predicted, context=context)
            trim()

    schema_of = docs.sparkSession.createDataFrame([], schema).toArrow().schema
    found = written(base.mapInArrow(run, schema), "scored")
    rows = found.where("row IS NOT NULL").select("row", "doc_id", "tie", "lang", "n", "log_p")
    asked = found.where("row IS NULL").select("m", "word", "other", "id", "predicted", "context").distinct()
    by_word = (asked.join(tail.hint("merge"), ["m", "id"]).groupBy("m", "word", "other")
               .agg(F.sum(F.col("predicted") * F.col("delta").cast("double") + F.col("context") * F.col("log_gamma").cast("double")).alias("more")))
    uses = found.where("row IS NOT NULL").select("row", "m", F.explode("uses").alias("u")).select("row", "m", "u.*")
    more = uses.join(by_word, ["m", "word", "other"]).groupBy("row").agg(F.sum(F.col("times") * F.col("more")).alias("more"))
    return rows.join(more, "row", "left").select("doc_id", "tie", "lang", "n", (F.col("log_p") + F.coalesce("more", F.lit(0.0))).alias("log_p"))


def _record(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch of all columns of `schema`; those not given are null."""
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([(x if isinstance(x := columns[f.name], pa.Array) else pa.array(x)).cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema],
                                      names=schema.names)


def judge(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE, head_size: int = HEAD) -> DataFrame:
    """doc_id, tie, lang, n_bytes, perplexity, threshold and kept for every row of `docs`."""
    trusted = written(labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
                      .agg(F.avg("quality").alias("quality")).where("quality > 0.5").select("id"), "trusted")
    folded = docs.select("doc_id", "lang", "text", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).alias("m"))
    # the trusted ids grow with the table, so they are never sent whole, on small tables neither
    own = trusted.hint("merge")
    counts = written(count(folded.join(own, F.col("doc_id") == F.col("id"), "left_semi"), order, others=True), "counts")
    table = written(model(counts, order), "model")
    s = score(folded, table, order, head_size)
    known = F.col("id").isNotNull().alias("trusted")
    x = F.when(F.col("n") > 0, -F.col("log_p") / F.col("n")).alias("x")
    scored = written(s.join(own, F.col("doc_id") == F.col("id"), "left").select("doc_id", "tie", "lang", "n", x, known), "judged")
    sure = scored.where("trusted AND x IS NOT NULL")
    by_lang = thresholds(sure, quantile).alias("t")
    above = F.col("s.x") > F.col("t.most")
    return (scored.alias("s").join(by_lang, F.col("s.lang").eqNullSafe(F.col("t.lang")), "left")
            .select("s.doc_id", "s.tie", "s.lang", F.col("n").alias("n_bytes"), F.exp("s.x").alias("perplexity"), F.exp("t.most").alias("threshold"),
                    ((F.col("n") > 0) & ~F.coalesce(above, F.lit(False))).alias("kept")))


def thresholds(rows: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """(lang, most): the log perplexity that a language's documents may have, from `rows` (lang, x) of trusted ones."""
    middle = written(rows.groupBy("lang").agg(F.percentile_approx("x", 0.5, 10_000).alias("middle")), "middles").alias("l")
    spread = (rows.alias("r").join(middle, F.col("r.lang").eqNullSafe(F.col("l.lang")))
              .select("l.lang", "middle", (F.col("x") - F.col("middle")).alias("above")))
    top = F.percentile_approx("above", quantile, 10_000)
    every = spread.agg(top, F.stddev_pop("above")).first()
    n = F.count("*")
    drawn = (n * top + DRAW * (every[0] or 0.0)) / (n + DRAW) + MARGIN * (every[1] or 0.0) / F.sqrt(n)
    return spread.groupBy("lang", "middle").agg((F.col("middle") + drawn).alias("most")).drop("middle")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    gone = written(judge(docs, labels, **options).where("NOT kept").select("doc_id", "tie").distinct(), "rejected")
    d, g = docs.alias("d"), gone.alias("g")
    return d.join(g, F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.xxhash64(F.coalesce(F.col("d.text"), F.lit(""))) == F.col("g.tie")), "left_anti")
