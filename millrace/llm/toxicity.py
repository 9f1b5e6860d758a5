"""Toxicity by cumulative-link ordinal regression over sparse word features.

Grades run from 0 (clean) to `GRADES` - 1: `P(grade <= k) = sigmoid(cut_k - w . x)`, one
weight vector for all ordered cuts; the result is the expected grade.

* The fit sees at most `SAMPLE` labelled documents, those of the smallest id hash: a bound
  on what the driver holds, of the same size at any input size. Scores cover all documents.
* A feature is a word (letters only, small) or the start of a longer one, by its 64-bit hash.
  It has two values: whether it occurs, and how often for the length of the text. Features
  take part whose rate differs between toxic and clean rows by `Z` standard errors; Spark
  counts them over the sample.
* Labels say toxic or not. A toxic row's grade is its third by how many features that lean
  to toxic it has for its length: more of them is more severe.
* Scoring is one narrow pass; the model (a hash and two weights for each feature taken) is
  bounded by the sample.

Nulls and ties: a null or empty text has no features, so its grade follows from the cuts.
Labels of one id are averaged, 0.5 counts as toxic; null labels are left out. Without rows
of both kinds no feature is taken and everything has the grade shares of the sample (grade 0
if it is empty). Repeated rows score alike, an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import hash_words, owners, slices, whole, words_of, written

SAMPLE = 8_000
GRADES = 4
Z = 5.0
PREFIXES = range(3, 9)
PENALTY = 0.5
STEPS = 400


def counted(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(word code, row, times) for each different word of each text, words by row, words by code."""
    texts = pc.replace_substring_regex(pc.utf8_lower(whole(column, pa.large_string())), r"[^\pL]+", " ")
    codes, at, words = words_of(texts)
    n = max(len(words), 1)
    pairs, times = np.unique(owners(at) * n + codes, return_counts=True)
    return pairs % n, pairs // n, times, np.diff(at), words


def vocabulary(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature hash, word code) for every feature of every word."""
    hashes, codes = [hash_words(words)], [np.arange(len(words))]
    lengths = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    for k in PREFIXES:
        long = np.flatnonzero(lengths > k)
        starts = pc.utf8_slice_codeunits(words.take(pa.array(long)), 0, k).dictionary_encode()
        # a start and a word of the same letters are two features
        hashes.append(~hash_words(starts.dictionary)[starts.indices.to_numpy(zero_copy_only=False)] if len(long) else np.zeros(0, np.uint64))
        codes.append(long)
    return np.concatenate(hashes), np.concatenate(codes)


def by_feature(feature: np.ndarray, word: np.ndarray, codes: np.ndarray, row: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, row, times) of texts, where `feature` and `word` list the features of words."""
    order = np.argsort(word, kind="stable")
    feature, word = feature[order], word[order]
    first, last = np.searchsorted(word, codes, "left"), np.searchsorted(word, codes, "right")
    n = last - first
    pick = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
    width = int(feature.max(initial=0)) + 1
    keys, at = np.unique(np.repeat(row, n) * width + feature[pick], return_inverse=True)
    return keys % width, keys // width, np.bincount(at, np.repeat(times, n), minlength=len(keys)).astype(np.int64)


def known_features(chosen: np.ndarray, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place among the sorted `chosen`, row, times) of a column's texts, and words by row."""
    codes, row, times, size, words = counted(column)
    hashes, word = vocabulary(words)
    place = np.searchsorted(chosen, hashes)
    known = np.flatnonzero(place < len(chosen))
    known = known[chosen[place[known]] == hashes[known]]
    return *by_feature(place[known], word[known], codes, row, times), size


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def rate(times: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.log1p(100 * times / (size + 50))


@dataclass
class Ordinal:
    chosen: np.ndarray   # sorted feature hashes
    occurs: np.ndarray   # weights of "occurs" and of the rate
    often: np.ndarray
    cuts: np.ndarray     # rising, one fewer than grades

    def above(self, column: pa.Array) -> np.ndarray:
        """P(grade > k) by row and k."""
        place, row, times, size = known_features(self.chosen, column)
        value = self.occurs[place] + self.often[place] * rate(times, size[row])
        return sigmoid(np.bincount(row, value, minlength=len(column))[:, None] - self.cuts)


def fit(chosen: np.ndarray, sign: np.ndarray, place: np.ndarray, row: np.ndarray, times: np.ndarray, size: np.ndarray,
        toxic: np.ndarray, grades: int = GRADES) -> Ordinal:
    """Weights and cuts of largest penalised likelihood, by Adam over the whole sample."""
    n, rates = len(chosen), rate(times, size[row])
    y = np.zeros(len(toxic), dtype=np.int64)
    if toxic.any():
        lean = np.bincount(row, rates * (sign[place] > 0), minlength=len(toxic))
        y[toxic] = 1 + np.searchsorted(np.quantile(lean[toxic], [i / (grades - 1) for i in range(1, grades - 1)]), lean[toxic])
    share = np.array([(np.sum(y > k) + 0.5) / (len(y) + 1) for k in range(grades - 1)]) if len(y) else 1e-9 * 0.5 ** np.arange(grades - 1)
    cuts = -np.log(share / (1 - share))
    # the first cut and the logarithms of the steps between cuts, so that cuts stay in order
    p = np.concatenate([np.zeros(2 * n), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-3))])
    m = v = np.zeros_like(p)
    rows = np.arange(len(y))
    for t in range(1, STEPS * bool(n) + 1):
        w, steps = p[:2 * n], np.exp(p[2 * n + 1:])
        cuts = p[2 * n] + np.concatenate([[0], np.cumsum(steps)])
        score = np.bincount(row, w[place] + w[n + place] * rates, minlength=len(y))
        above = np.hstack([np.ones((len(y), 1)), sigmoid(score[:, None] - cuts), np.zeros((len(y), 1))])
        rise = above * (1 - above)
        chance = np.maximum(above[rows, y] - above[rows, y + 1], 1e-12)
        # derivative of log P(y) by the score, and by each cut
        up, down = rise[rows, y] / chance, rise[rows, y + 1] / chance
        pull = (up - down)[row]
        by_cut = np.array([np.sum(down[y == k]) - np.sum(up[y == k + 1]) for k in range(grades - 1)])
        slope = np.concatenate([
            np.bincount(place, pull, minlength=n) - PENALTY * w[:n], np.bincount(place, pull * rates, minlength=n) - PENALTY * w[n:],
            [by_cut.sum()], np.cumsum(by_cut[::-1])[::-1][1:] * steps])
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        p = p + 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    if n:
        cuts = p[2 * n] + np.concatenate([[0], np.cumsum(np.exp(p[2 * n + 1:]))])
    return Ordinal(chosen, p[:n], p[n:2 * n], cuts)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, grades: int = GRADES, z: float = Z) -> Ordinal:
    """Fit on at most `sample` labelled documents."""
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
             .agg((F.avg("toxic") >= 0.5).cast("bigint").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(sample))
    # at most `sample` rows of two numbers, so it may be sent to all
    joined = docs.select("doc_id", "text").join(F.broadcast(known), F.col("doc_id") == F.col("id"))
    rows = written(joined.select("text", "toxic"), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            codes, row, times, _, words = counted(batch["text"])
            hashes, word = vocabulary(words)
            features, own = np.unique(hashes, return_inverse=True)
            place, row, _ = by_feature(own, word, codes, row, times)
            hot = np.bincount(place, batch["toxic"].to_numpy()[row], minlength=len(features))
            yield pa.RecordBatch.from_arrays(
                [pa.array(features.view(np.int64)), pa.array(hot.astype(np.int64)), pa.array(np.bincount(place, minlength=len(features)))],
                ["feature", "hot", "both"])

    n, n1 = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if 0 < n1 < n:
        p = F.col("both") / n
        error = F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * (1 / n1 + 1 / (n - n1)))
        far = (F.col("hot") / n1 - (F.col("both") - F.col("hot")) / (n - n1)) / error
        found = (rows.mapInArrow(count, "feature bigint, hot bigint, both bigint").groupBy("feature")
                 .agg(F.sum("hot").alias("hot"), F.sum("both").alias("both"))
                 .select("feature", far.alias("far")).where(F.abs("far") >= z).toPandas())
    else:
        found = None
    chosen = found["feature"].to_numpy(dtype=np.int64).view(np.uint64) if found is not None else np.zeros(0, np.uint64)
    sign = np.sign(found["far"].to_numpy(dtype=float)) if found is not None else np.zeros(0)
    chosen, sign = chosen[np.argsort(chosen)], sign[np.argsort(chosen)]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            place, row, times, size = known_features(chosen, batch["text"])
            cut = np.searchsorted(row, np.arange(1, batch.num_rows))
            cells = [[x.astype(np.int32).tobytes() for x in np.split(values, cut)] for values in (place, times)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells[0], pa.binary()), pa.array(cells[1], pa.binary()), pa.array(size), batch["toxic"]],
                ["places", "times", "size", "toxic"])

    got = rows.mapInArrow(take, "places binary, times binary, size bigint, toxic bigint").toPandas()
    flat = [np.frombuffer(b"".join(got[c]), np.int32).astype(np.int64) for c in ("places", "times")]
    row = np.repeat(np.arange(len(got)), [len(x) // 4 for x in got["places"]])
    return fit(chosen, sign, flat[0], row, flat[1], got["size"].to_numpy(dtype=np.int64), got["toxic"].to_numpy(dtype=np.int64) > 0, grades)


def score(docs: DataFrame, model: Ordinal) -> DataFrame:
    """doc_id, expected_severity, p_toxic (chance of a grade above 0), toxic (a half or more), grade (the likeliest)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            above = shared.value.above(batch["text"])
            ends = np.hstack([np.ones((len(above), 1)), above, np.zeros((len(above), 1))])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(above.sum(axis=1)), pa.array(above[:, 0]), pa.array(above[:, 0] >= 0.5),
                 pa.array((ends[:, :-1] - ends[:, 1:]).argmax(axis=1))],
                ["doc_id", "expected_severity", "p_toxic", "toxic", "grade"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, expected_severity double, p_toxic double, toxic boolean, grade bigint")


def severity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    return score(docs, train(docs, labels, **options))
