import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import multi_index as M

SCHEMA = "vec_id bigint, embedding array<double>, label int, id string, shard string, block int"
ENDS = (1 - (1 << 63), (1 << 63) - 1)


def brute(rows, every=100):
    rows = [(i, [min(max(math.floor(x * 256) if abs(x) < 1e300 else int(math.copysign(1 << 62, x)), -(1 << 62)), 1 << 62) for x in v],
             (lab + 1) % 10 if i is not None and i % 7 == 0 else lab)
            for i, v, lab in rows if lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = lambda r: (-r[1], -(1 << 63) if r[0] is None else r[0])
    out = []
    for k, (i, v, lab) in enumerate(rows):
        if i is None or i % every:
            continue
        seen = [(j, min(max(sum(a * b for a, b in zip(v, w)), ENDS[0]), ENDS[1]), other) for m, (j, w, other) in enumerate(rows) if m != k]
        for pos in sorted((r for r in seen if r[2] == lab), key=order)[:5]:
            fit = sorted((r for r in seen if r[2] != lab and 30 * pos[1] <= 100 * r[1] <= 90 * pos[1]), key=order)[:10]
            out += [(i, pos[0], n, r[0], pos[1], r[1]) for n, r in enumerate(fit, 1)]
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = M.mined(spark.createDataFrame([(i, v, lab, "x", "y", 3) for i, v, lab in rows], SCHEMA), **options)
    assert dict(df.dtypes)["rank"] == "int" and df.columns[0] == "anchor_id"
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(n=700, dim=7, seed=2):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(6, dim))
    rows = []
    for i in range(n):
        v = centres[pick.integers(6)] + pick.normal(size=dim) * pick.choice([0.1, 1.0])
        rows.append((i, [float(x) for x in v], int(pick.integers(4))))
    return rows


@pytest.mark.parametrize("options", [{}, {"shard": 40, "block": 2, "sample": 50}])
def test_against_brute_force(spark, options):
    base = made()
    rows = [*base, *[(1000 + k, base[0][1], k % 3) for k in range(150)],  # one vector over several shards, and many ties
            (2000, None, 1), (2100, [float("nan")] * 7, 1), (2200, [1.0] * 7, None), (2300, [None, 1.0], 1), (2400, [], 1), (2500, [0.0] * 7, 2),
            (2600, [0.5], 0), (None, base[100][1], 0), (None, base[200][1], 3), (2700, [float("inf")] * 7, 1), (2801, base[300][1], 2), (2900, base[300][1], 2)]
    assert run(spark, rows, **options) == brute(rows)


def test_wide_numbers(spark):
    rows = [(k, [x * scale for x in v], lab) for k, (_, v, lab) in enumerate(made(60, 3)) for scale in [(1e6, 1e12, 1e200)[k % 3]]]
    assert run(spark, rows, every=10, shard=20) == brute(rows, 10)


def test_none(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert run(spark, [(100, [1.0], 1)]) == [] and run(spark, [(100, [1.0], 1), (101, [1.0], 1)]) == []
    few = [(100, [1.0], 1), (101, [1.0], 1), (102, [0.5], 2)]
    assert run(spark, few) == brute(few) != []


def test_visits_cells_by_bound():
    pick = np.random.default_rng(1)
    first, second = pick.normal(size=9), pick.normal(size=8)
    held = {(int(a), int(b)): k for k, (a, b) in enumerate(pick.integers((9, 8), size=(30, 2)))}
    got = list(M.visits(first, second, held))
    bounds = [b for b, _ in got]
    assert bounds == sorted(bounds, reverse=True) and sorted(c for _, c in got) == sorted(held.values())
    assert all(abs(b - first[i] - second[j]) < 1e-12 for b, c in got for i, j in [next(k for k, v in held.items() if v == c)])


def test_stops_on_a_certified_window():
    """Vectors in far clusters: an anchor looks at a small part of the rows."""
    pick = np.random.default_rng(4)
    x = (np.concatenate([pick.normal(size=(400, 8)) + 40 * np.eye(8)[k] for k in range(8)]) * 256).astype(np.int64)
    codes = M.Codes((M.codebook(x[:, :4].astype(float), 8), M.codebook(x[:, 4:].astype(float), 8)))
    own, far = codes.file(x)
    for k in (0, 1):
        np.maximum.at(codes.radius[k], own[k], far[k])
    shard = M.Shard(codes, x, np.arange(len(x)), np.zeros(len(x)), own[0] * M.MOST_CODES + own[1])
    looked, count = [], M.scores
    M.scores = lambda rows, one: looked.append(len(rows)) or count(rows, one)
    try:
        (_, _, places, scores), = shard.top(x[:1], lambda i, label, order: [(np.ones(len(x), bool), *ENDS, 5)])
    finally:
        M.scores = count
    want = np.lexsort((np.arange(len(x)), -(x @ x[0])))[:5]
    assert places.tolist() == want.tolist() and scores.tolist() == (x @ x[0])[want].tolist() and sum(looked) < len(x) / 2
