"""Query cases: projections, filters, predicates, column operators and row shaping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.clean import (
    clean_identifier, clean_postcode, comma_text, label_of, parse_day, parse_int, parse_number,
)
from millrace.operators.joins import broadcast_if_small
from millrace.plans.registry import Tables, case
from millrace.sources.links import not_landed, page_links

_HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*["'']?([^"''\s>]*)"""
_LINKS = f"""
WITH links AS (
  SELECT page_id, unnest(regexp_extract_all(html, '{_HREF}', 1)) AS href FROM pages),
named AS (SELECT page_id, href, split_part(href, '/', -1) AS file_name,
                 split_part(split_part(href, '/', -1), '.', 1) AS file_stem FROM links)
"""


# -- pages to files -------------------------------------------------------------

@case("q_links_extract", _LINKS + "SELECT page_id, href, file_name, file_stem FROM named")
def links_extract(t: Tables) -> DataFrame:
    return page_links(t.pages)


@case("q_links_marked", _LINKS + "SELECT page_id, href, file_name, file_stem FROM named WHERE contains(href, 'ion')")
def links_marked(t: Tables) -> DataFrame:
    return page_links(t.pages, marker="ion")


@case("q_links_not_landed", _LINKS + """
SELECT page_id, href, file_name, file_stem FROM named
WHERE file_name NOT IN (SELECT file_name FROM named WHERE page_id % 2 = 0)""")
def links_not_landed(t: Tables) -> DataFrame:
    links = page_links(t.pages)
    landed = links.where(F.col("page_id") % 2 == 0).select("file_name").distinct()
    return not_landed(links, landed)


# -- cleaning rules -------------------------------------------------------------

@case("q_clean_day", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM orders""")
def clean_day(t: Tables) -> DataFrame:
    bad = F.when(F.col("o_orderkey") % 10 == 0, F.lit("31/02/2023")).otherwise(F.date_format("o_orderdate", "yyyy/MM"))
    text = F.when(F.col("o_orderkey") % 5 == 0, bad).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    return t.orders.select("o_orderkey", parse_day(text).cast("string").alias("day"))


@case("q_clean_identifier", """
SELECT c_custkey, trim(regexp_replace(' ' || c_name || './-' || c_custkey || ' ', '[.\\-/]', '', 'g')) AS ident,
       replace(c_name || '-0', '-', '') AS post FROM customer""")
def clean_identifiers(t: Tables) -> DataFrame:
    text = F.concat(F.lit(" "), "c_name", F.lit("./-"), F.col("c_custkey").cast("string"), F.lit(" "))
    return t.customer.select(
        "c_custkey", clean_identifier(text).alias("ident"),
        clean_postcode(F.concat("c_name", F.lit("-0"))).alias("post"),
    )


@case("q_clean_number", """
SELECT l_orderkey, l_linenumber, l_partkey, round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE), 3) AS price,
       CASE WHEN l_extendedprice < 1000 THEN round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE), 3) END AS two_marks,
       round(CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE), 3) AS with_thousands
FROM lineitem""")
def clean_number(t: Tables) -> DataFrame:
    price = F.col("l_extendedprice")
    dotted = F.translate(F.format_number(price, 2), ",.", ".,")
    shown = [parse_number(comma_text(price)), parse_number(dotted), parse_number(dotted, thousands=".")]
    names = ["price", "two_marks", "with_thousands"]
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        *[F.round(c.cast("double"), 3).alias(n) for c, n in zip(shown, names)],
    )


@case("q_clean_int", """
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN CAST(p_size AS INTEGER) WHEN 1 THEN NULL
       WHEN 2 THEN CAST(1000 + p_size AS INTEGER) WHEN 3 THEN CAST(p_size AS INTEGER) WHEN 4 THEN NULL
       ELSE CAST(-p_size AS INTEGER) END AS size FROM part""")
def clean_int(t: Tables) -> DataFrame:
    size, turn = F.col("p_size").cast("string"), F.col("p_partkey") % 6
    text = (
        F.when(turn == 0, F.concat(F.lit(" "), size, F.lit(" ")))
        .when(turn == 1, F.concat(F.lit("S/N "), size))
        .when(turn == 2, F.format_number(F.col("p_size") + 1000, 0))
        .when(turn == 3, F.concat(size, F.lit(".9")))
        .when(turn == 4, F.concat(F.lit("30000000"), F.lpad(size, 2, "0")))
        .otherwise(F.concat(F.lit("-"), size))
    )
    return t.part.select("p_partkey", parse_int(text).alias("size"))


@case("q_clean_required", "SELECT count(*) FILTER (c_acctbal >= 0) AS kept, count(*) FILTER (c_acctbal < 0) AS rejected FROM customer")
def clean_required(t: Tables) -> DataFrame:
    amount = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal"))
    return t.customer.select(amount.alias("amount")).agg(
        F.count_if(F.col("amount").isNotNull()).alias("kept"), F.count_if(F.col("amount").isNull()).alias("rejected")
    )


@case("q_clean_code_label", """
SELECT n_name, CASE n_regionkey WHEN 0 THEN 'Africa' WHEN 2 THEN 'Asia' END AS area, r_name AS joined
FROM nation JOIN region ON n_regionkey = r_regionkey""")
def clean_code_label(t: Tables) -> DataFrame:
    codes = broadcast_if_small(t.region, 1000)
    return t.nation.join(codes, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        "n_name", label_of(F.col("n_regionkey"), {0: "Africa", 2: "Asia"}).alias("area"),
        F.col("r_name").alias("joined"),
    )


@case("q_clean_full_row_dedup", "SELECT DISTINCT l_returnflag, l_linestatus, l_discount, l_tax FROM lineitem")
def clean_full_row_dedup(t: Tables) -> DataFrame:
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_discount", "l_tax").dropDuplicates()


# -- projections ----------------------------------------------------------------

@case("q_select_columns", "SELECT o_orderkey, o_totalprice AS price, o_totalprice * 2 AS doubled FROM orders")
def select_columns(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.col("o_totalprice").alias("price"), (F.col("o_totalprice") * 2).alias("doubled"))


@case("q_select_expr", "SELECT o_orderkey, o_custkey % 10 AS digit, upper(o_orderstatus) AS st FROM orders")
def select_expr(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey", "o_custkey % 10 AS digit", "upper(o_orderstatus) AS st")


@case("q_filter_where", """
SELECT o_orderkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' AND o_orderstatus = 'F'
  AND (CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE o_custkey % 3 = 1 END)""")
def filter_where(t: Tables) -> DataFrame:
    maybe = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") % 3 == 1)
    return (
        t.orders.filter(F.col("o_orderdate") >= "1998-01-01").where("o_orderdate < '1999-01-01'")
        .filter((F.col("o_orderstatus") == "F") & maybe).select("o_orderkey", "o_totalprice")
    )


@case("q_with_columns", """
SELECT s_suppkey, s_name AS supplier_name, s_acctbal + 1 AS s_acctbal, s_suppkey * 2 AS twice, s_suppkey * 3 AS thrice
FROM supplier""")
def with_columns(t: Tables) -> DataFrame:
    return (
        t.supplier.withColumn("s_acctbal", F.col("s_acctbal") + 1)
        .withColumns({"twice": F.col("s_suppkey") * 2, "thrice": F.col("s_suppkey") * 3})
        .withColumnRenamed("s_name", "supplier_name").withColumnRenamed("absent", "ignored")
        .drop("s_nationkey", "absent")
    )


@case("q_to_df_names", "SELECT doc_id AS document, quality AS good, toxic AS bad FROM labels")
def to_df_names(t: Tables) -> DataFrame:
    return t.labels.toDF("document", "good", "bad")


@case("q_alias_self_join", """
SELECT a.o_orderkey AS child, b.o_orderkey AS parent FROM orders a JOIN orders b ON a.o_custkey = b.o_orderkey""")
def alias_self_join(t: Tables) -> DataFrame:
    a, b = t.orders.alias("a"), t.orders.alias("b")
    return a.join(b, F.col("a.o_custkey") == F.col("b.o_orderkey")).select(
        F.col("a.o_orderkey").alias("child"), F.col("b.o_orderkey").alias("parent")
    )


@case("q_col_regex", "SELECT c_custkey, c_nationkey FROM customer")
def col_regex(t: Tables) -> DataFrame:
    df = t.customer
    return df.select(df.colRegex("`c_.*key`"))


@case("q_frame_transform", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def frame_transform(t: Tables) -> DataFrame:
    def above(df, limit):
        return df.where(F.col("o_totalprice") > limit)

    def counted(df):
        return df.groupBy("o_orderstatus").agg(F.count("*").alias("n"))

    return t.orders.transform(above, 100000).transform(counted)


@case("q_row_to_json", """
SELECT c_custkey, '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}' AS doc FROM customer""")
def row_to_json(t: Tables) -> DataFrame:
    """What `toJSON` gives, as a column expression and so without leaving the frame."""
    return t.customer.select("c_custkey", F.to_json(F.struct("c_custkey", "c_name")).alias("doc"))


@case("q_temp_view", "SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1")
def temp_view(t: Tables) -> DataFrame:
    t.customer.createOrReplaceTempView("millrace_customer")
    return t.spark.table("millrace_customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))


@case("q_observe_metrics", "SELECT l_returnflag, sum(l_quantity) AS qty FROM lineitem GROUP BY 1")
def observe_metrics(t: Tables) -> DataFrame:
    """Metrics under a name, for a listener. An `Observation` object would stay in the
    session, and classifiers fitted in that session could then no longer be sent to tasks."""
    watched = t.lineitem.observe("line_metrics", F.count("*").alias("rows"), F.max("l_quantity").alias("top"))
    return watched.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("qty"))


@case("q_is_empty", """
SELECT (SELECT count(*) FROM orders WHERE o_totalprice < 0) = 0 AS none_negative,
       (SELECT count(*) FROM orders) = 0 AS nothing""")
def is_empty(t: Tables) -> DataFrame:
    rows = t.orders.agg(F.count_if(F.col("o_totalprice") < 0).alias("neg"), F.count("*").alias("n"))
    return rows.select((F.col("neg") == 0).alias("none_negative"), (F.col("n") == 0).alias("nothing"))


# -- column operators -------------------------------------------------------------

@case("q_arithmetic_operators", """
SELECT l_orderkey, l_partkey, l_linenumber, -l_quantity AS neg, l_quantity + l_tax AS plus, l_quantity - l_tax AS minus,
       l_quantity * l_tax AS times, l_quantity / (l_tax + 1) AS divided, l_partkey % 7 AS rem,
       1 + l_linenumber AS radd, CAST(10 - l_linenumber AS INTEGER) AS rsub, CAST(3 * l_linenumber AS INTEGER) AS rmul,
       1.0::DOUBLE / l_linenumber AS rdiv, 100 % l_linenumber AS rmod, pow(l_linenumber, 2) AS power, pow(2, l_linenumber) AS rpower
FROM lineitem""")
def arithmetic_operators(t: Tables) -> DataFrame:
    q, x, n = F.col("l_quantity"), F.col("l_tax"), F.col("l_linenumber")
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", (-q).alias("neg"), (q + x).alias("plus"), (q - x).alias("minus"),
        (q * x).alias("times"), (q / (x + 1)).alias("divided"), (F.col("l_partkey") % 7).alias("rem"),
        (1 + n).alias("radd"), (10 - n).alias("rsub"), (3 * n).alias("rmul"), (1 / n).alias("rdiv"),
        (100 % n).alias("rmod"), (n ** 2).alias("power"), (2 ** n).alias("rpower"),
    )


@case("q_comparison_operators", """
SELECT o_orderkey, o_custkey = 5 AS eq, o_custkey <> 5 AS ne, o_custkey < 50 AS lt, o_custkey <= 50 AS le,
       o_custkey > 50 AS gt, o_custkey >= 50 AS ge,
       (CASE WHEN o_custkey % 2 = 0 THEN o_custkey END) IS NOT DISTINCT FROM (CASE WHEN o_custkey % 4 = 0 THEN o_custkey END) AS null_safe,
       o_custkey IN (1, 2, 3) AS in_list, o_custkey BETWEEN 10 AND 20 AS in_range
FROM orders""")
def comparison_operators(t: Tables) -> DataFrame:
    c = F.col("o_custkey")
    even, fourth = F.when(c % 2 == 0, c), F.when(c % 4 == 0, c)
    return t.orders.select(
        "o_orderkey", (c == 5).alias("eq"), (c != 5).alias("ne"), (c < 50).alias("lt"), (c <= 50).alias("le"),
        (c > 50).alias("gt"), (c >= 50).alias("ge"), even.eqNullSafe(fourth).alias("null_safe"),
        c.isin(1, 2, 3).alias("in_list"), c.between(10, 20).alias("in_range"),
    )


@case("q_logic_operators", """
SELECT o_orderkey, (a AND b) AS both_, (a OR b) AS either, NOT a AS neither, (TRUE AND b) AS rand_, (FALSE OR b) AS ror_
FROM (SELECT o_orderkey, o_totalprice > 200000 AS a, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey % 3 = 1 END AS b FROM orders)""")
def logic_operators(t: Tables) -> DataFrame:
    a = F.col("o_totalprice") > 200000
    b = F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") % 3 == 1)
    return t.orders.select(
        "o_orderkey", (a & b).alias("both_"), (a | b).alias("either"), (~a).alias("neither"),
        (True & b).alias("rand_"), (False | b).alias("ror_"),
    )


@case("q_bit_operators", """
SELECT o_orderkey, o_custkey | 12 AS bor, o_custkey & 12 AS band, xor(o_custkey, 12) AS bxor FROM orders""")
def bit_operators(t: Tables) -> DataFrame:
    c = F.col("o_custkey")
    return t.orders.select(
        "o_orderkey", c.bitwiseOR(12).alias("bor"), c.bitwiseAND(12).alias("band"), c.bitwiseXOR(12).alias("bxor")
    )


@case("q_nested_access", """
SELECT c_custkey, c_name AS second, c_nationkey AS field, c_custkey + 1 AS added, c_name AS mapped FROM customer""")
def nested_access(t: Tables) -> DataFrame:
    packed = t.customer.select(
        "c_custkey", F.array(F.lit("x"), "c_name").alias("a"), F.create_map(F.lit("k"), "c_name").alias("m"),
        F.struct("c_nationkey", "c_name").alias("s"),
    )
    grown = F.col("s").withField("next", F.col("c_custkey") + 1).dropFields("c_name")
    return packed.withColumn("s", grown).select(
        "c_custkey", F.col("a").getItem(1).alias("second"), F.col("s").getField("c_nationkey").alias("field"),
        F.col("s.next").alias("added"), F.col("m").getItem("k").alias("mapped"),
    )


@case("q_text_predicates", """
SELECT p_partkey, contains(p_name, 'widget') AS has, regexp_matches(p_name, '^(small|cold)') AS rx,
       p_name LIKE '%dg_t' AS lk, p_name ILIKE '%WIDGET' AS ilk, starts_with(p_name, 'co') AS sw,
       ends_with(p_name, 't') AS ew, substr(p_name, 2, 3) AS part FROM part""")
def text_predicates(t: Tables) -> DataFrame:
    c = F.col("p_name")
    return t.part.select(
        "p_partkey", c.contains("widget").alias("has"), c.rlike("^(small|cold)").alias("rx"), c.like("%dg_t").alias("lk"),
        c.ilike("%WIDGET").alias("ilk"), c.startswith("co").alias("sw"), c.endswith("t").alias("ew"),
        c.substr(2, 3).alias("part"),
    )


@case("q_null_tests", """
SELECT c_custkey, v IS NULL AS no, v IS NOT NULL AS yes, v IS NULL AS no2, COALESCE(v, 0.0) AS filled,
       isnan(x) AS bad, CASE WHEN isnan(x) THEN 1.0 ELSE x END AS good
FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS v,
             CASE WHEN c_custkey % 4 = 0 THEN 'NaN'::DOUBLE ELSE c_acctbal END AS x FROM customer)""")
def null_tests(t: Tables) -> DataFrame:
    v = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    x = F.when(F.col("c_custkey") % 4 == 0, F.lit(float("nan"))).otherwise(F.col("c_acctbal"))
    return t.customer.select(
        "c_custkey", v.isNull().alias("no"), v.isNotNull().alias("yes"), F.isnull(v).alias("no2"),
        F.coalesce(v, F.lit(0.0)).alias("filled"), F.isnan(x).alias("bad"), F.nanvl(x, F.lit(1.0)).alias("good"),
    )


@case("q_case_when", """
SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'high' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'low' END AS band,
       CASE WHEN o_orderstatus = 'F' THEN 1 END AS maybe FROM orders""")
def case_when(t: Tables) -> DataFrame:
    p = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.when(p > 300000, "high").when(p > 100000, "mid").otherwise("low").alias("band"),
        F.when(F.col("o_orderstatus") == "F", 1).name("maybe"),
    )


@case("q_cast_types", """
SELECT l_orderkey, l_partkey, CAST(l_orderkey AS INTEGER) AS as_int, CAST(l_quantity AS VARCHAR) AS as_text,
       CAST(trunc(l_extendedprice) AS BIGINT) AS as_long, l_linenumber > 0 AS as_bool, NULL::DOUBLE AS bad,
       CAST(CAST(l_discount AS DECIMAL(6,2)) AS VARCHAR) AS as_dec
FROM lineitem""")
def cast_types(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_partkey", F.col("l_orderkey").cast("int").alias("as_int"),
        F.col("l_quantity").astype("string").alias("as_text"),
        F.col("l_extendedprice").cast("bigint").alias("as_long"), F.col("l_linenumber").cast("boolean").alias("as_bool"),
        F.col("l_returnflag").try_cast("double").alias("bad"),
        F.col("l_discount").cast("decimal(6,2)").cast("string").alias("as_dec"),
    )


@case("q_greatest_least", """
SELECT l_orderkey, l_partkey, l_linenumber, greatest(l_quantity, l_linenumber * 5.0, l_tax) AS hi,
       least(l_quantity, CASE WHEN l_linenumber > 3 THEN l_tax END) AS lo, 'k' AS const FROM lineitem""")
def greatest_least(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.greatest("l_quantity", F.col("l_linenumber") * 5.0, "l_tax").alias("hi"),
        F.least("l_quantity", F.when(F.col("l_linenumber") > 3, F.col("l_tax"))).alias("lo"), F.lit("k").alias("const"),
    )


@case("q_struct_pack", "SELECT c_name, c_nationkey AS region, c_custkey * 2 AS doubled FROM customer")
def struct_pack(t: Tables) -> DataFrame:
    packed = t.customer.select("c_name", F.struct(F.col("c_nationkey").alias("region"), F.expr("c_custkey * 2").alias("doubled")).alias("s"))
    return packed.select("c_name", "s.*")


@case("q_assert_true", "SELECT count(*) AS n, NULL::INTEGER AS checked FROM orders WHERE o_totalprice > 0")
def assert_true(t: Tables) -> DataFrame:
    checked = F.assert_true(F.col("o_totalprice") > 0, "price must be positive")
    return t.orders.where(checked.isNull()).agg(F.count("*").alias("n"), F.lit(None).cast("int").alias("checked"))


@case("q_raise_error_guard", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def raise_error_guard(t: Tables) -> DataFrame:
    status = F.when(F.col("o_orderstatus").isin("F", "O", "P"), F.col("o_orderstatus")).otherwise(
        F.raise_error(F.concat(F.lit("unknown status "), "o_orderstatus"))
    )
    return t.orders.select(status.alias("o_orderstatus")).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@case("q_file_and_row_ids", """
SELECT 'orders.parquet' AS file_name, count(*) AS n, count(*) AS n_ids, TRUE AS ids_ok FROM orders""")
def file_and_row_ids(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.substring_index(F.input_file_name(), "/", -1).alias("file_name"),
        F.monotonically_increasing_id().alias("id"), F.spark_partition_id().alias("part"),
    )
    return rows.groupBy("file_name").agg(
        F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"),
        F.min((F.shiftright("id", 33) == F.col("part"))).alias("ids_ok"),
    )


@case("q_broadcast_checked", """
SELECT r_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1""")
def broadcast_checked(t: Tables) -> DataFrame:
    dims = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    dims = broadcast_if_small(dims.select("n_nationkey", "r_name"), 1000)
    return t.customer.join(dims, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("r_name").agg(F.count("*").alias("n"))
