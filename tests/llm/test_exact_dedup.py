import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import exact_dedup as E

SCHEMA = "doc_id bigint, text string, kept string, keep_id string"


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        first = True
        for i in ids:
            out.append((i, keep, len(ids), i == keep and first, hashlib.sha256(t.encode()).hexdigest()))
            first = first and i != keep
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)


@pytest.mark.parametrize("options", [
    {}, {"huge_bytes": 40},                               # some texts hashed chunk by chunk
    {"poly_args": ((3, 5), 7)}, {"poly_args": ((1, 1), 2)},  # fingerprints that collide
])
def test_groups(spark, options):
    words = ["", "a", "b", "ab", "ba", "é", "x" * 50, "y" * 50, "z" * 70_000, "z" * 70_000 + "é", "\x00", "\x00\x00"]
    pick = random.Random(5)
    rows = [(i, pick.choice(words)) for i in range(120)] + [(7, "a"), (7, "a"), (None, "b"), (None, None), (8, None), (119, "zz"), (119, "zz")]
    got = [tuple(r) for r in E.exact_dedup(frame(spark, rows), **options).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_empty_and_keep(spark):
    assert E.exact_dedup(frame(spark, [])).count() == 0
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b"), (5, "b"), (5, "c"), (None, "d")]
    kept = E.keep_one(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "kept", "keep_id"]
    assert sorted(((r[0], r[1] or "") for r in kept.collect()), key=str) == sorted([(2, "a"), (4, ""), (5, "b"), (5, "c"), (None, "d")], key=str)


def test_combine_is_associative():
    poly, data = E.Polynomial(), np.random.default_rng(1).integers(0, 256, 5000).astype(np.uint8)
    whole = poly.chunk(data)
    for cut in (0, 1, 1234, 5000):
        assert poly.combine(poly.chunk(data[:cut]), poly.chunk(data[cut:]), 5000 - cut) == whole
    assert poly.text(np.concatenate([data] * 30)) == poly.text(np.tile(data, 30))


def test_hot_group(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"))
    out = E.exact_dedup(docs)
    assert out.where("kept").count() == 2001
    assert out.where("group_size = 1000 AND keep_id = 2997").count() == 1000
