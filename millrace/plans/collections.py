"""Query cases: array, map, struct and higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import Tables, case


def shown(column: Column, name: str) -> Column:
    """An array as text, so results compare on plain cells."""
    return F.array_join(column, ",", "~").alias(name)


def entries(column: Column, name: str) -> Column:
    """A map as text, in key order."""
    pairs = F.array_sort(F.map_entries(column))
    return F.array_join(F.transform(pairs, lambda e: F.concat_ws(":", e["key"].cast("string"), e["value"].cast("string"))), ",").alias(name)


# each document's first letters of its words, in three small arrays made from the row
_ARRAYS = """
WITH a AS (SELECT p_partkey, [p_size, p_size % 7, p_size % 3] AS x, [p_size % 5, p_size % 3, 1] AS y,
                  [CASE WHEN p_size % 2 = 0 THEN p_size END, p_size % 4] AS z FROM part)
"""


def arrays(t: Tables) -> DataFrame:
    s = F.col("p_size")
    return t.part.select(
        "p_partkey", F.array(s, s % 7, s % 3).alias("x"), F.array(s % 5, s % 3, F.lit(1)).alias("y"),
        F.array(F.when(s % 2 == 0, s), s % 4).alias("z"),
    )


@case("q_array_lookup", _ARRAYS + """
SELECT p_partkey, list_contains(x, 1) AS has, list_has_any(x, y) AS overlap, coalesce(list_position(x, 2), 0)::BIGINT AS pos, x[2] AS second, x[-1] AS last_,
       NULL::INTEGER AS none, len(x)::INTEGER AS n, list_min(x) AS lo, list_max(x) AS hi FROM a""")
def array_lookup(t: Tables) -> DataFrame:
    x = F.col("x")
    return arrays(t).select(
        "p_partkey", F.array_contains(x, 1).alias("has"), F.arrays_overlap(x, "y").alias("overlap"), F.array_position(x, 2).alias("pos"),
        F.element_at(x, 2).alias("second"), F.element_at(x, -1).alias("last_"), F.try_element_at(x, F.lit(9)).alias("none"),
        F.size(x).alias("n"), F.array_min(x).alias("lo"), F.array_max(x).alias("hi"),
    )


@case("q_array_edit", _ARRAYS + """
SELECT p_partkey, array_to_string(x[2:3], ',') AS sl, array_to_string(list_transform(z, lambda e: coalesce(CAST(e AS VARCHAR), '~')), ',') AS joined,
       array_to_string(list_filter(x, lambda e: e <> 1), ',') AS removed, array_to_string(list_reverse(x), ',') AS rev, array_to_string(list_concat(x, y), ',') AS cat,
       array_to_string([p_partkey, p_partkey], ',') AS rep, array_to_string(flatten([x, y]), ',') AS flat FROM a""")
def array_edit(t: Tables) -> DataFrame:
    return arrays(t).select(
        "p_partkey", shown(F.slice("x", 2, 2), "sl"), shown(F.col("z"), "joined"), shown(F.array_remove("x", 1), "removed"),
        shown(F.reverse("x"), "rev"), shown(F.concat("x", "y"), "cat"), shown(F.array_repeat("p_partkey", 2), "rep"),
        shown(F.flatten(F.array("x", "y")), "flat"),
    )


@case("q_array_sets", _ARRAYS + """
SELECT p_partkey, array_to_string(list_sort(list_distinct(x)), ',') AS dist, array_to_string(list_sort(list_intersect(x, y)), ',') AS inter,
       array_to_string(list_sort(list_distinct(list_concat(x, y))), ',') AS uni,
       array_to_string(list_sort(list_distinct(list_filter(x, lambda e: NOT list_contains(y, e)))), ',') AS exc FROM a""")
def array_sets(t: Tables) -> DataFrame:
    return arrays(t).select(
        "p_partkey", shown(F.array_sort(F.array_distinct("x")), "dist"), shown(F.array_sort(F.array_intersect("x", "y")), "inter"),
        shown(F.array_sort(F.array_union("x", "y")), "uni"), shown(F.array_sort(F.array_except("x", "y")), "exc"),
    )


@case("q_array_sort", _ARRAYS + """
SELECT p_partkey, array_to_string(list_transform(list_sort(z, 'ASC', 'NULLS LAST'), lambda e: coalesce(CAST(e AS VARCHAR), '~')), ',') AS last_,
       array_to_string(list_transform(list_sort(z, 'ASC', 'NULLS FIRST'), lambda e: coalesce(CAST(e AS VARCHAR), '~')), ',') AS first_,
       array_to_string(list_reverse_sort(x), ',') AS down, TRUE AS shuffled_ok FROM a""")
def array_sort(t: Tables) -> DataFrame:
    return arrays(t).select(
        "p_partkey", shown(F.array_sort("z"), "last_"), shown(F.sort_array("z"), "first_"), shown(F.sort_array("x", asc=False), "down"),
        (F.array_sort(F.shuffle("x")) == F.array_sort("x")).alias("shuffled_ok"),
    )


@case("q_array_zip_sequence", _ARRAYS + """
SELECT p_partkey, array_to_string(list_transform(list_zip(x, y), lambda e: e[1] || '/' || e[2]), ',') AS zipped, array_to_string(range(1, 8, 3), ',') AS seq,
       array_to_string(list_transform(range(DATE '2024-01-01', DATE '2024-01-04', INTERVAL 1 DAY), lambda d: strftime(d, '%Y-%m-%d')), ',') AS days FROM a""")
def array_zip_sequence(t: Tables) -> DataFrame:
    return arrays(t).select(
        "p_partkey", shown(F.transform(F.arrays_zip("x", "y"), lambda e: F.concat_ws("/", e["x"], e["y"])), "zipped"),
        shown(F.sequence(F.lit(1), F.lit(7), F.lit(3)), "seq"),
        shown(F.transform(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date")), lambda d: d.cast("string")), "days"),
    )


@case("q_array_higher_order", _ARRAYS + """
SELECT p_partkey, array_to_string(list_transform(x, lambda e, i: e * i), ',') AS mapped, len(list_filter(x, lambda e: e > 5)) > 0 AS any_, len(list_filter(x, lambda e: e >= 0)) = 3 AS all_,
       array_to_string(list_filter(x, lambda e: e % 2 = 0), ',') AS kept, CAST(list_sum(x) * 10 AS INTEGER) AS folded,
       array_to_string(list_transform(list_zip(x, y), lambda e: e[1] + e[2]), ',') AS merged FROM a""")
def array_higher_order(t: Tables) -> DataFrame:
    x = F.col("x")
    return arrays(t).select(
        "p_partkey", shown(F.transform(x, lambda e, i: e * (i + 1)), "mapped"), F.exists(x, lambda e: e > 5).alias("any_"), F.forall(x, lambda e: e >= 0).alias("all_"),
        shown(F.filter(x, lambda e: e % 2 == 0), "kept"), F.aggregate(x, F.lit(0), lambda acc, e: acc + e, lambda acc: acc * 10).alias("folded"),
        shown(F.zip_with(x, "y", lambda a, b: a + b), "merged"),
    )


@case("q_vector_dot_norm", """
SELECT vec_id, round(list_sum(list_transform(embedding, lambda e: CAST(e AS DOUBLE) * e)), 5) AS sq FROM embeddings""")
def vector_dot_norm(t: Tables) -> DataFrame:
    sq = F.aggregate("embedding", F.lit(0.0), lambda acc, e: acc + e.cast("double") * e)
    return t.embeddings.select("vec_id", F.round(sq, 5).alias("sq"))


# -- maps ---------------------------------------------------------------------------

@case("q_map_build", """
SELECT c_custkey, 'a:' || c_custkey || ',b:' || c_nationkey AS made, 'a:' || c_custkey || ',b:' || c_nationkey AS from_arrays, 'a:' || c_custkey AS from_entries,
       'a:' || c_custkey || ',b:' || c_nationkey || ',c:1' AS merged FROM customer""")
def map_build(t: Tables) -> DataFrame:
    two = F.create_map(F.lit("a"), "c_custkey", F.lit("b"), "c_nationkey")
    return t.customer.select(
        "c_custkey", entries(two, "made"),
        entries(F.map_from_arrays(F.array(F.lit("a"), F.lit("b")), F.array("c_custkey", "c_nationkey")), "from_arrays"),
        entries(F.map_from_entries(F.array(F.struct(F.lit("a"), "c_custkey"))), "from_entries"),
        entries(F.map_concat(two, F.create_map(F.lit("c"), F.lit(1))), "merged"),
    )


@case("q_map_functions", """
SELECT c_custkey, 'a,b' AS ks, c_custkey || ',' || c_nationkey AS vs, c_custkey AS at_a, 'ax:' || c_custkey || ',bx:' || c_nationkey AS rekeyed,
       'a:' || (c_custkey * 2) || ',b:' || (c_nationkey * 2) AS revalued, 'b:' || c_nationkey AS filtered, 'a:' || (c_custkey + 1) || ',b:' || (c_nationkey + 2) AS zipped
FROM customer""")
def map_functions(t: Tables) -> DataFrame:
    two = F.create_map(F.lit("a"), "c_custkey", F.lit("b"), "c_nationkey")
    other = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    return t.customer.select(
        "c_custkey", shown(F.map_keys(two), "ks"), shown(F.map_values(two), "vs"), F.element_at(two, "a").alias("at_a"),
        entries(F.transform_keys(two, lambda k, v: F.concat(k, F.lit("x"))), "rekeyed"), entries(F.transform_values(two, lambda k, v: v * 2), "revalued"),
        entries(F.map_filter(two, lambda k, v: k == "b"), "filtered"), entries(F.map_zip_with(two, other, lambda k, a, b: a + b), "zipped"),
    )


# -- explode ------------------------------------------------------------------------

@case("q_explode_words", r"""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(lower(text), '[ \t\n\f\r]+')) AS word FROM documents) WHERE word <> '' GROUP BY 1""")
def explode_words(t: Tables) -> DataFrame:
    words = t.documents.select(F.explode(F.split(F.lower("text"), r"[ \t\n\f\r]+")).alias("word"))
    return words.where("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


_OUTER = "SELECT c_custkey, CASE c_nationkey WHEN 0 THEN NULL WHEN 1 THEN [] ELSE [c_nationkey, c_custkey] END AS xs FROM customer"


def _maybe(t: Tables) -> DataFrame:
    xs = F.when(F.col("c_nationkey") == 1, F.array().cast("array<bigint>")).when(F.col("c_nationkey") > 1, F.array("c_nationkey", "c_custkey"))
    return t.customer.select("c_custkey", xs.alias("xs"))


@case("q_explode_drop", f"SELECT c_custkey, unnest(xs) AS x FROM ({_OUTER})")
def explode_drop(t: Tables) -> DataFrame:
    return _maybe(t).select("c_custkey", F.explode("xs").alias("x"))


@case("q_explode_outer", f"SELECT c_custkey, unnest(CASE WHEN xs IS NULL OR len(xs) = 0 THEN [NULL] ELSE xs END) AS x FROM ({_OUTER})")
def explode_outer(t: Tables) -> DataFrame:
    return _maybe(t).select("c_custkey", F.explode_outer("xs").alias("x"))


@case("q_posexplode", f"""
SELECT c_custkey, CAST(i - 1 AS INTEGER) AS pos, xs[i] AS x FROM (SELECT c_custkey, xs, unnest(range(1, len(xs) + 1)) AS i FROM ({_OUTER}))""")
def posexplode(t: Tables) -> DataFrame:
    return _maybe(t).select("c_custkey", F.posexplode("xs").alias("pos", "x"))


@case("q_posexplode_outer", f"""
SELECT c_custkey, CAST(i - 1 AS INTEGER) AS pos, xs[i] AS x FROM (SELECT c_custkey, xs, unnest(range(1, len(xs) + 1)) AS i FROM ({_OUTER}))
UNION ALL SELECT c_custkey, NULL, NULL FROM ({_OUTER}) WHERE xs IS NULL OR len(xs) = 0""")
def posexplode_outer(t: Tables) -> DataFrame:
    return _maybe(t).select("c_custkey", F.posexplode_outer("xs").alias("pos", "x"))
