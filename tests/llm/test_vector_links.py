import numpy as np
import pytest

from millrace.llm import vector_links as V
from millrace.llm.components import components

SCHEMA = "vec_id bigint, embedding array<double>, label int, n_links string"


def brute(rows, least=0.95):
    good = [(i, k) for k, (i, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dim = max((len(rows[k][1]) for _, k in good), default=1)
    x = np.array([[*rows[k][1], *[0.0] * (dim - len(rows[k][1]))] for _, k in good]).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True, initial=0)
    c = (x @ x.T) / np.sqrt(np.outer((x * x).sum(1), (x * x).sum(1)))
    links = {k: [] for k in range(len(rows))}
    for a in range(len(good)):
        links[good[a][1]] = [good[b][1] for b in range(len(good)) if b != a and c[a, b] >= least]
    low = {i: i for i, _ in rows}
    order = lambda i: -1 if i is None else i
    for _ in rows:
        for k, others in links.items():
            for o in others:
                m = min(low[rows[k][0]], low[rows[o][0]], key=order)
                low[rows[k][0]] = low[rows[o][0]] = m
    return sorted((order(i), len(links[k]), order(low[i]), low[i] == i) for k, (i, _) in enumerate(rows))


def run(spark, rows, **options):
    out = V.link(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA), **options).collect()
    return sorted((-1 if r.vec_id is None else r.vec_id, r.n_links, -1 if r.component_id is None else r.component_id, r.kept) for r in out)


def clusters(n=400, dim=16, seed=1):
    pick = np.random.default_rng(seed)
    centres = pick.normal(size=(25, dim))
    rows = []
    for i in range(n):
        v = centres[pick.integers(25)] + pick.normal(size=dim) * pick.choice([0.05, 0.1, 2.0])
        rows.append((int(i), [float(x) for x in v * pick.uniform(0.1, 9)]))
    return rows


@pytest.mark.parametrize("block", [16, 2048])
def test_against_brute_force(spark, block):
    base = clusters()
    rows = [*base, (900, base[0][1]), (901, base[0][1]), (901, base[1][1]), (None, base[2][1]), (902, None), (903, []), (904, [0.0] * 16),
            (905, [float("nan")] * 16), (906, [None, 1.0]), (907, [float("inf")] * 16), (908, [1.0]), (909, [-0.0, 1.0]), (910, [0.0, 1.0]),
            (911, [x * 1e200 for x in base[3][1]])]
    want, got = brute(rows), run(spark, rows, block=block)
    assert [r[0] for r in got] == [r[0] for r in want]
    found, real = sum(r[1] for r in got), sum(r[1] for r in want)
    assert found >= 0.97 * real and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g == w for g, w in zip(got, want)) >= 0.95 * len(want)


def test_few_and_none(spark):
    assert run(spark, []) == []
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [1.0, 0.0])]
    assert run(spark, rows) == brute(rows)


def test_components(spark):
    pick = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in pick.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(50)]
    low = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got.get(x, x) == r for x, r in low.items())


def test_one_pivot(spark):
    """Vectors in a cone leave one pivot; their near pairs link as well."""
    rows = [(1, [1.0, 0.0]), (2, [0.99, 0.05])]
    assert run(spark, rows) == brute(rows)
    pick = np.random.default_rng(5)
    rows = [(i, [float(x) for x in pick.normal(size=8) * 0.35 + 1.5]) for i in range(150)]
    rows += [(200, rows[0][1]), (None, rows[1][1])]
    want = brute(rows)
    assert 0 < sum(r[1] for r in want) < len(rows) * (len(rows) - 1)
    assert run(spark, rows, block=64) == want
