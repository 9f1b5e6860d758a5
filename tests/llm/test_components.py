import random

import pytest

from millrace.llm import components as C

KINDS = {
    "rising": [(i, i + 1) for i in range(1000)],
    "shuffled": [(a, b) for order in [random.Random(1).sample(range(1001), 1001)] for a, b in zip(order, order[1:])],
    "star": [(500, i) for i in range(1000) if i != 500],
    "loops": [(3, 3), (4, 4)],
}


@pytest.mark.parametrize("kind", KINDS)
def test_rounds_and_roots(spark, monkeypatch, kind):
    steps, write = [], C.written
    monkeypatch.setattr(C, "written", lambda df, name: steps.append(name) or write(df, name))
    edges = KINDS[kind]
    got = {r.node: r.root for r in C.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    low = min(min(e) for e in edges)
    assert got == ({} if kind == "loops" else {x: low for e in edges for x in e})
    # a chain of 1000 takes neither 1000 rounds nor 1000 steps in one
    assert steps.count("edges") <= 12 and steps.count("parents") <= {"rising": 13, "shuffled": 30, "star": 6, "loops": 0}[kind]
