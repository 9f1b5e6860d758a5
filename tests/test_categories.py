"""Category columns: edits of the levels, against pandas."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators.categories import encode

VALUES = ["b", None, "a", "x", "b", "c"]


@pytest.fixture()
def column(spark):
    return encode(spark.createDataFrame(list(enumerate(VALUES)), "id int, v string"), "v", ["c", "b", "a"], ordered=True)


def values(c):
    return [r.v for r in c.decoded().orderBy("id").collect()]


def test_edits_equal_pandas(column):
    want = pd.Series(pd.Categorical(VALUES, ["c", "b", "a"], ordered=True)).cat
    steps = [
        (lambda c: c.add(["d", "e"]), lambda p: p.add_categories(["d", "e"])),
        (lambda c: c.remove(["a"]), lambda p: p.remove_categories(["a"])),
        # a level that comes back is a new one: its old rows stay null
        (lambda c: c.add(["a"]), lambda p: p.add_categories(["a"])),
        (lambda c: c.rename({"b": "B"}), lambda p: p.rename_categories({"b": "B"})),
        (lambda c: c.reorder(["e", "B", "d", "c", "a"]), lambda p: p.reorder_categories(["e", "B", "d", "c", "a"], ordered=True)),
        (lambda c: c.remove_unused(), lambda p: p.remove_unused_categories()),
        (lambda c: c.set(["c", "z"]), lambda p: p.set_categories(["c", "z"], ordered=True)),
    ]
    for ours, theirs in steps:
        column, out = ours(column), theirs(want)
        want = out.cat
        assert column.names() == list(out.cat.categories)
        assert values(column) == [None if pd.isna(v) else v for v in out]


def test_order(column):
    at = column.decoded("place").where(F.col("place") >= column.place_of("b"))
    assert sorted(r.id for r in at.collect()) == [0, 2, 4]
    with pytest.raises(ValueError, match="order"):
        column.as_ordered(False).place_of("b")


def test_refusals(spark, column):
    for bad in (lambda: column.add(["b"]), lambda: column.remove(["q"]), lambda: column.rename({"a": "b"}), lambda: column.reorder(["a", "b"]),
                lambda: column.set(["a", "a"]), lambda: column.place_of("q"), lambda: encode(column.rows, "v", [1, 1])):
        with pytest.raises(ValueError):
            bad()
    none = encode(spark.createDataFrame([], "v string"), "v", ["a"])
    assert none.decoded("p").collect() == [] and none.remove_unused().names() == []
