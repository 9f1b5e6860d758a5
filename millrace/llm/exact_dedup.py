"""Exact dedup by composable polynomial fingerprints, every match checked byte by byte.

A text is cut in chunks of its UTF-8 bytes. A chunk's hash is a polynomial in a fixed base
modulo a prime; two neighbours combine as `hash(AB) = hash(A) * base**len(B) + hash(B)`, so
chunks of a huge document are hashed in parallel and put together afterwards. Two bases and
the byte length make up the fingerprint. Rows of equal fingerprints are then compared with
the row that would stay, chunk against chunk, as the chunks stream through a join; what
differs is grouped by the text itself.

Hot groups: fingerprints are counted with a partial aggregate; members meet their group's
row through `SALTS` copies of it, so a group of a third of all rows is dealt over that many
keys. Only texts that share a fingerprint are compared; the chunks of the row that would
stay are repeated once for every `SALT_ROWS` members.

Nulls and ties: a null text counts as the empty text. A null doc_id sorts below all others.
Rows that repeat a doc_id and text count as rows of the group, and the first of them stays.
An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import one_of_each, slices, whole, written

CHUNK_BYTES = 1 << 16   # the sum below stays under 2**63 for chunks up to this size
HUGE_BYTES = 8 << 20    # texts over this many bytes are hashed by several tasks
SALTS = 64
SALT_ROWS = 256
PRIME = 2**31 - 1
BASES = (1_103_515_245, 1_664_525_937)
_FINGERPRINT = ["n_bytes", "h1", "h2"]


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.int64)
    for i in range(1, n):
        out[i] = out[i - 1] * base % prime
    return out[::-1].copy()


class Polynomial:
    """Hashes of byte strings that combine by length."""

    def __init__(self, bases=BASES, prime: int = PRIME):
        self.bases, self.prime = [b % prime for b in bases], prime
        self.powers = [_powers(b, prime, CHUNK_BYTES) for b in self.bases]

    def chunk(self, data: np.ndarray) -> list[int]:
        """Of at most CHUNK_BYTES bytes; a byte counts one more than its value, so zero bytes count."""
        values = data.astype(np.int64) + 1
        return [int(values @ p[CHUNK_BYTES - len(values):]) % self.prime for p in self.powers]

    def combine(self, left: list[int], right: list[int], right_bytes: int) -> list[int]:
        return [(a * pow(b, right_bytes, self.prime) + c) % self.prime for a, b, c in zip(left, self.bases, right)]

    def text(self, data: np.ndarray) -> list[int]:
        out = [0] * len(self.bases)
        for at in range(0, len(data), CHUNK_BYTES):
            part = data[at:at + CHUNK_BYTES]
            out = self.combine(out, self.chunk(part), len(part))
        return out


def _base(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def _small(docs: DataFrame, poly_args: tuple) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        poly = Polynomial(*poly_args)
        for batch in slices(batches, "text"):
            out = []
            for cell in whole(batch["text"], pa.large_binary()):
                data = cell.as_buffer()
                out.append((len(data), *poly.text(np.frombuffer(data, np.uint8)), hashlib.sha256(data).hexdigest()))
            n, h1, h2, sha = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(x, pa.int64()) for x in (n, h1, h2)), pa.array(sha, pa.string())],
                ["doc_id", *_FINGERPRINT, "text_sha256"])

    return docs.mapInArrow(run, f"doc_id {kind}, n_bytes bigint, h1 bigint, h2 bigint, text_sha256 string")


def cut(docs: DataFrame) -> DataFrame:
    """Chunk rows (all columns but text, part, chunk): a text's UTF-8 bytes in pieces of CHUNK_BYTES."""
    others = [f for f in docs.schema.fields if f.name != "text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "part bigint", "chunk binary"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            parts, chunks, row = [], [], []
            for i, cell in enumerate(whole(batch["text"], pa.large_binary())):
                data = memoryview(cell.as_buffer())
                for k, at in enumerate(range(0, max(len(data), 1), CHUNK_BYTES)):
                    parts.append(k)
                    row.append(i)
                    chunks.append(bytes(data[at:at + CHUNK_BYTES]))
            rest = batch.select([f.name for f in others]).take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(parts, pa.int64()), pa.array(chunks, pa.binary())],
                [*(f.name for f in others), "part", "chunk"])

    return docs.mapInArrow(run, schema)


def combine_chunks(chunks: DataFrame, keys: list[str], poly_args: tuple = ()) -> DataFrame:
    """Fingerprints of documents kept as chunk rows (keys, part, chunk): chunks are hashed where they
    lie, only (part, length, hashes) meet, and combine in order of `part`."""
    @F.pandas_udf("n_bytes bigint, h1 bigint, h2 bigint")
    def hashed(chunk: pd.Series) -> pd.DataFrame:
        poly = Polynomial(*poly_args)
        return pd.DataFrame([(len(c), *poly.chunk(np.frombuffer(c, np.uint8))) for c in chunk], columns=_FINGERPRINT)

    @F.pandas_udf("n_bytes bigint, h1 bigint, h2 bigint")
    def joined(parts: pd.Series) -> pd.DataFrame:
        poly, out = Polynomial(*poly_args), []
        for rows in parts:
            n, h = 0, [0, 0]
            for row in rows:
                h = poly.combine(h, [row["h1"], row["h2"]], row["n_bytes"])
                n += row["n_bytes"]
            out.append((n, *h))
        return pd.DataFrame(out, columns=_FINGERPRINT)

    one = F.struct("part", "h.n_bytes", "h.h1", "h.h2")
    return (chunks.select(*keys, "part", hashed("chunk").alias("h"))
            .groupBy(*keys).agg(F.sort_array(F.collect_set(one)).alias("parts"), F.count_if(F.col("part") == 0).alias("n_rows"))
            .select(*keys, joined("parts").alias("f"), "n_rows").select(*keys, "f.*", "n_rows"))


def fingerprints(docs: DataFrame, huge_bytes: int = HUGE_BYTES, poly_args: tuple = ()) -> DataFrame:
    """One row per doc_id and text: n_bytes, h1, h2, text_sha256, n_rows (rows that repeat both)."""
    docs = _base(docs)
    keys = ["doc_id", "text_sha256"]
    small = (_small(docs.where(F.octet_length("text") <= huge_bytes), poly_args)
             .groupBy(*keys, *_FINGERPRINT).agg(F.count("*").alias("n_rows")))
    huge = docs.where(F.octet_length("text") > huge_bytes).withColumn("text_sha256", F.sha2("text", 256))
    chunks = cut(huge).repartition("doc_id", "part")
    return small.unionByName(combine_chunks(chunks, keys, poly_args))


def _salt(column: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(column), n)


def _salts(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1))


def exact_groups(docs: DataFrame, huge_bytes: int = HUGE_BYTES, poly_args: tuple = ()) -> DataFrame:
    """One row per doc_id and text: keep_id, group_size (rows of that text), text_sha256, n_rows, kept."""
    prints = written(fingerprints(docs, huge_bytes, poly_args), "prints")
    row = F.struct("doc_id", "text_sha256")
    groups = (prints.groupBy(*_FINGERPRINT)
              .agg(F.sum("n_rows").alias("group_size"), F.max(row).alias("keep"), F.count("*").alias("n_different"))
              .where("n_different > 1").withColumn("salt", _salts(F.lit(SALTS))))
    members = written(
        prints.withColumn("salt", _salt("doc_id", F.lit(SALTS))).join(groups, [*_FINGERPRINT, "salt"], "left")
        .select(*_FINGERPRINT, "doc_id", "text_sha256", "n_rows", F.ceil(F.col("n_different") / SALT_ROWS).alias("salts"),
                F.coalesce("group_size", "n_rows").alias("group_size"), F.coalesce("keep", row).alias("keep"),
                F.col("keep").isNotNull().alias("shared")), "members")
    differing = written(_differing(docs, members), "differing")
    keys = ["doc_id", "text_sha256"]
    if not differing.isEmpty():
        members = _regrouped(docs, members, differing)
    same = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("text_sha256") == F.col("keep.text_sha256"))
    return members.select(*keys, F.col("keep.doc_id").alias("keep_id"), "group_size", "n_rows", same.alias("kept"))


def _differing(docs: DataFrame, members: DataFrame) -> DataFrame:
    """Members whose chunks are not those of the row that would stay."""
    shared = members.where("shared").select(*_FINGERPRINT, "doc_id", "text_sha256", "salts", "keep")
    d, m = _base(docs).alias("d"), shared.alias("m")
    texts = (d.join(m, F.col("d.doc_id").eqNullSafe(F.col("m.doc_id")))
             .where(F.sha2(F.col("d.text"), 256) == F.col("m.text_sha256")).select("m.*", "d.text"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep.doc_id")) & (F.col("text_sha256") == F.col("keep.text_sha256"))
    chunks = cut(texts.withColumn("stays", stays).withColumn("salt", _salt("doc_id", F.col("salts"))).drop("keep"))
    first = (chunks.where("stays").dropDuplicates([*_FINGERPRINT, "part"])
             .select(*_FINGERPRINT, "part", F.col("chunk").alias("kept_chunk"), _salts(F.col("salts")).alias("salt")))
    return (chunks.where("NOT stays").join(first, [*_FINGERPRINT, "part", "salt"])
            .groupBy("doc_id", "text_sha256").agg(F.bool_and(F.col("chunk") == F.col("kept_chunk")).alias("same"))
            .where("NOT same").select("doc_id", "text_sha256"))


def _regrouped(docs: DataFrame, members: DataFrame, differing: DataFrame) -> DataFrame:
    """Fingerprint groups in which some text differs, grouped anew by the text."""
    keys = ["doc_id", "text_sha256"]
    bad = members.join(differing, keys, "left_semi").select(*_FINGERPRINT).distinct()
    null_safe = F.col("d.doc_id").eqNullSafe(F.col("m.doc_id"))
    again = members.join(bad, _FINGERPRINT, "left_semi").alias("m")
    texts = (_base(docs).alias("d").join(again, null_safe).where(F.sha2(F.col("d.text"), 256) == F.col("m.text_sha256"))
             .select("m.*", "d.text").dropDuplicates(keys))
    by_text = (texts.groupBy("text").agg(F.sum("n_rows").alias("group_size"), F.max(F.struct(*keys)).alias("keep"))
               .withColumn("salt", _salts(F.lit(SALTS))))
    dealt = texts.drop("group_size", "keep").withColumn("salt", _salt("doc_id", F.lit(SALTS)))
    anew = dealt.join(by_text, ["text", "salt"]).select(*members.columns)
    return members.join(bad, _FINGERPRINT, "left_anti").unionByName(anew)


def exact_dedup(docs: DataFrame, **options) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256."""
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows")))
    return (exact_groups(docs, **options).withColumn("copy", copy)
            .select("doc_id", "keep_id", "group_size", (F.col("kept") & (F.col("copy") == 1)).alias("kept"), "text_sha256"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    groups = written(exact_groups(docs, **options).where("NOT kept OR n_rows > 1"), "gone")
    d, g = docs.alias("d"), groups.where("NOT kept").alias("g")
    match = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.sha2(F.coalesce(F.col("d.text"), F.lit("")), 256) == F.col("g.text_sha256"))
    left = d.join(g, match, "left_anti")
    if groups.where("kept").isEmpty():
        return left
    again, l = groups.where("kept").alias("g"), left.alias("d")
    return l.join(again, match, "left_anti").unionByName(one_of_each(l.join(again, match, "left_semi")))
