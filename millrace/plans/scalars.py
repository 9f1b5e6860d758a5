"""Query cases: math, bit, hash, string, JSON and CSV functions over whole columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.plans.registry import Tables, case


def r6(column: Column, name: str, scale: int = 6) -> Column:
    return F.round(column, scale).alias(name)


# -- math ---------------------------------------------------------------------------

_LINE_KEYS = ("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
_LINE_KEYS_SQL = ", ".join(_LINE_KEYS)



@case("q_math_trig", f"""
SELECT {_LINE_KEYS_SQL}, round(acos(x), 6) AS acos_, round(asin(x), 6) AS asin_, round(atan(x), 6) AS atan_, round(cos(x), 6) AS cos_,
       round(sin(x), 6) AS sin_, round(tan(x), 6) AS tan_, round(cot(x + 0.1), 6) AS cot_, round(1 / sin(x + 0.1), 6) AS csc_,
       round(1 / cos(x), 6) AS sec_, round(atan2(x, y), 6) AS atan2_, round(degrees(x), 6) AS deg, round(radians(y), 6) AS rad
FROM (SELECT *, l_discount AS x, l_quantity AS y FROM lineitem)""")
def math_trig(t: Tables) -> DataFrame:
    x, y = F.col("l_discount"), F.col("l_quantity")
    return t.lineitem.select(
        *_LINE_KEYS, r6(F.acos(x), "acos_"), r6(F.asin(x), "asin_"), r6(F.atan(x), "atan_"), r6(F.cos(x), "cos_"), r6(F.sin(x), "sin_"),
        r6(F.tan(x), "tan_"), r6(F.cot(x + 0.1), "cot_"), r6(F.csc(x + 0.1), "csc_"), r6(F.sec(x), "sec_"),
        r6(F.atan2(x, y), "atan2_"), r6(F.degrees(x), "deg"), r6(F.radians(y), "rad"),
    )


@case("q_math_hyperbolic", f"""
SELECT {_LINE_KEYS_SQL}, round(cosh(x), 6) AS cosh_, round(sinh(x), 6) AS sinh_, round(tanh(x), 6) AS tanh_, round(acosh(y), 6) AS acosh_,
       round(asinh(y), 6) AS asinh_, round(atanh(x), 6) AS atanh_
FROM (SELECT *, l_discount AS x, l_quantity AS y FROM lineitem)""")
def math_hyperbolic(t: Tables) -> DataFrame:
    x, y = F.col("l_discount"), F.col("l_quantity")
    return t.lineitem.select(
        *_LINE_KEYS, r6(F.cosh(x), "cosh_"), r6(F.sinh(x), "sinh_"), r6(F.tanh(x), "tanh_"), r6(F.acosh(y), "acosh_"),
        r6(F.asinh(y), "asinh_"), r6(F.atanh(x), "atanh_"),
    )


@case("q_math_exp_log", f"""
SELECT {_LINE_KEYS_SQL}, round(exp(x), 6) AS exp_, round(exp(x) - 1, 6) AS expm1_, round(ln(y), 6) AS ln_, round(ln(y) / ln(3), 6) AS log3_,
       round(log10(y), 6) AS log10_, round(log2(y), 6) AS log2_, round(ln(1 + x), 6) AS log1p_, round(sqrt(y), 6) AS sqrt_,
       round(cbrt(y), 6) AS cbrt_, round(sqrt(x * x + y * y), 6) AS hypot_, round(pow(y, 2.5), 4) AS pow_
FROM (SELECT *, l_discount AS x, l_quantity AS y FROM lineitem)""")
def math_exp_log(t: Tables) -> DataFrame:
    x, y = F.col("l_discount"), F.col("l_quantity")
    return t.lineitem.select(
        *_LINE_KEYS, r6(F.exp(x), "exp_"), r6(F.expm1(x), "expm1_"), r6(F.log(y), "ln_"), r6(F.log(3.0, y), "log3_"),
        r6(F.log10(y), "log10_"), r6(F.log2(y), "log2_"), r6(F.log1p(x), "log1p_"), r6(F.sqrt(y), "sqrt_"), r6(F.cbrt(y), "cbrt_"),
        r6(F.hypot(x, y), "hypot_"), r6(F.pow(y, F.lit(2.5)), "pow_", 4),
    )


@case("q_math_round", """
SELECT c_custkey, abs(c_acctbal) AS abs_, CAST(ceil(c_acctbal) AS BIGINT) AS ceil_, CAST(floor(c_acctbal) AS BIGINT) AS floor_, round_even(c_acctbal, 0) AS rint_,
       CAST(sign(c_acctbal) AS DOUBLE) AS sign_, CAST(round(CAST(c_custkey AS DECIMAL(18,2)) / 4, 1) AS DOUBLE) AS round_up,
       CASE WHEN c_custkey % 10 = 5 THEN CASE WHEN (c_custkey // 10) % 2 = 0 THEN c_custkey - 5 ELSE c_custkey + 5 END
            ELSE CAST(round(c_custkey / 10.0) * 10 AS BIGINT) END AS bround_
FROM customer""")
def math_round(t: Tables) -> DataFrame:
    b, k = F.col("c_acctbal"), F.col("c_custkey")
    return t.customer.select(
        "c_custkey", F.abs(b).alias("abs_"), F.ceil(b).alias("ceil_"), F.floor(b).alias("floor_"), F.rint(b).alias("rint_"),
        F.signum(b).alias("sign_"), F.round(k / 4, 1).alias("round_up"), F.bround(k, -1).alias("bround_"),
    )


@case("q_math_integers", """
SELECT p_partkey, CAST(factorial(CAST(p_size % 15 AS INTEGER)) AS BIGINT) AS fact, ~p_size AS bnot, CAST(p_size AS BIGINT) << 3 AS shl, p_partkey >> 2 AS shr,
       CASE WHEN p_partkey % 2 = 0 THEN p_partkey // 2 ELSE 9223372036854775807 - (p_partkey // 2) END AS shru,
       bin(p_partkey) AS bin_, hex(p_partkey) AS hex_, to_base(p_partkey, 7) AS conv_, hex(unhex('0A' || lpad(hex(p_size), 2, '0'))) AS unhexed
FROM part""")
def math_integers(t: Tables) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    signed = F.when(k % 2 == 0, k).otherwise(-k)
    return t.part.select(
        "p_partkey", F.factorial(s % 15).alias("fact"), F.bitwise_not(s).alias("bnot"), F.shiftleft(s.cast("bigint"), 3).alias("shl"),
        F.shiftright(k, 2).alias("shr"), F.shiftrightunsigned(signed, 1).alias("shru"), F.bin(k).alias("bin_"), F.hex(k).alias("hex_"),
        F.conv(k.cast("string"), 10, 7).alias("conv_"),
        F.hex(F.unhex(F.concat(F.lit("0A"), F.lpad(F.hex(s), 2, "0")))).alias("unhexed"),
    )


@case("q_math_random", "SELECT l_returnflag, TRUE AS uniform_ok, TRUE AS normal_ok, TRUE AS in_range FROM lineitem GROUP BY 1")
def math_random(t: Tables) -> DataFrame:
    """Means of many draws lie near 1/2 and 0, and uniform draws in [0, 1)."""
    drawn = t.lineitem.select("l_returnflag", F.rand(3).alias("u"), F.randn(4).alias("z"))
    width = 6 / F.sqrt(F.count("*"))
    return drawn.groupBy("l_returnflag").agg(
        (F.abs(F.avg("u") - 0.5) < width).alias("uniform_ok"), (F.abs(F.avg("z")) < width).alias("normal_ok"),
        ((F.min("u") >= 0) & (F.max("u") < 1)).alias("in_range"),
    )


# -- hashes -------------------------------------------------------------------------

@case("q_hash_digests", """
SELECT doc_id, md5(text) AS md5_, sha1(text) AS sha1_, sha256(text) AS sha2_ FROM documents""")
def hash_digests(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5("text").alias("md5_"), F.sha1("text").alias("sha1_"), F.sha2("text", 256).alias("sha2_"))


@case("q_hash_keys", "SELECT count(DISTINCT text) AS texts, count(DISTINCT text) AS xx, TRUE AS crc_ok, TRUE AS murmur_ok FROM documents")
def hash_keys(t: Tables) -> DataFrame:
    """Equal texts hash alike, so the 64-bit hash has as many values as there are texts."""
    hashed = t.documents.select("text", F.xxhash64("text").alias("x"), F.crc32("text").alias("c"), F.hash("text").alias("m"))
    return hashed.agg(
        F.count_distinct("text").alias("texts"), F.count_distinct("x").alias("xx"),
        ((F.min("c") >= 0) & (F.max("c") < 4294967296)).alias("crc_ok"), (F.count_distinct("m") <= F.count_distinct("text")).alias("murmur_ok"),
    )


# -- strings ------------------------------------------------------------------------

@case("q_string_case", """
SELECT p_partkey, upper(p_name) AS up, lower(p_type) AS low, ascii(p_name) AS asc_, length(p_name)::INTEGER AS len, strlen(p_name)::INTEGER AS bytes,
       (8 * strlen(p_name))::INTEGER AS bits, repeat(p_type, 2) AS rep, reverse(p_name) AS rev,
       upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' ||
       upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) AS cap
FROM part""")
def string_case(t: Tables) -> DataFrame:
    n = F.col("p_name")
    return t.part.select(
        "p_partkey", F.upper(n).alias("up"), F.lower("p_type").alias("low"), F.ascii(n).alias("asc_"), F.length(n).alias("len"),
        F.octet_length(n).alias("bytes"), F.bit_length(n).alias("bits"), F.repeat("p_type", 2).alias("rep"), F.reverse(n).alias("rev"),
        F.initcap(n).alias("cap"),
    )


@case("q_string_length_text", """
SELECT doc_id, length(text)::INTEGER AS chars, strlen(text)::INTEGER AS bytes, (8 * strlen(text))::INTEGER AS bits FROM documents""")
def string_length_text(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), F.bit_length("text").alias("bits")
    )


@case("q_string_trim_pad", """
SELECT p_partkey, trim('  ' || p_name || ' ') AS tr, ltrim('  ' || p_name || ' ') AS lt, rtrim('  ' || p_name || ' ') AS rt, lpad(p_type, 10, '*') AS lp,
       rpad(p_type, 10, '-+') AS rp, lpad(p_name, 4, 'x') AS cut FROM part""")
def string_trim_pad(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), "p_name", F.lit(" "))
    return t.part.select(
        "p_partkey", F.trim(padded).alias("tr"), F.ltrim(padded).alias("lt"), F.rtrim(padded).alias("rt"), F.lpad("p_type", 10, "*").alias("lp"),
        F.rpad("p_type", 10, "-+").alias("rp"), F.lpad("p_name", 4, "x").alias("cut"),
    )


@case("q_string_concat", """
SELECT c_custkey, concat_ws('|', CASE WHEN c_custkey % 2 = 0 THEN c_name END, c_mktsegment) AS ws, c_name || c_mktsegment AS cc,
       printf('%05d-%s', c_custkey, c_mktsegment) AS fmt, format('{:,.2f}', c_acctbal) AS num FROM customer""")
def string_concat(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", F.concat_ws("|", F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")), "c_mktsegment").alias("ws"),
        F.concat("c_name", "c_mktsegment").alias("cc"), F.format_string("%05d-%s", "c_custkey", "c_mktsegment").alias("fmt"),
        F.format_number("c_acctbal", 2).alias("num"),
    )


@case("q_string_binary", """
SELECT doc_id, base64(encode(lang || source)) AS b64, decode(from_base64(base64(encode(lang || source)))) AS back,
       hex(encode(source)) AS enc, source AS dec FROM documents""")
def string_binary(t: Tables) -> DataFrame:
    text = F.concat("lang", "source")
    return t.documents.select(
        "doc_id", F.base64(text.cast("binary")).alias("b64"), F.unbase64(F.base64(text.cast("binary"))).cast("string").alias("back"),
        F.hex(F.encode("source", "UTF-8")).alias("enc"), F.decode(F.encode("source", "UTF-16BE"), "UTF-16BE").alias("dec"),
    )


@case("q_string_search", """
SELECT doc_id, instr(text, 'an')::INTEGER AS ins, CASE WHEN instr(substr(text, 20), 'an') = 0 THEN 0 ELSE instr(substr(text, 20), 'an') + 19 END::INTEGER AS loc,
       substr(text, 5, 7) AS sub, CASE WHEN instr(text, ' ') = 0 THEN text ELSE substr(text, 1, instr(text, ' ') - 1) END AS idx,
       split_part(text, ' ', -1) AS last_word, substr(text, 1, 2) || '##' || substr(text, 5) AS over_
FROM documents""")
def string_search(t: Tables) -> DataFrame:
    x = F.col("text")
    return t.documents.select(
        "doc_id", F.instr(x, "an").alias("ins"), F.locate("an", x, 20).alias("loc"), F.substring(x, 5, 7).alias("sub"),
        F.substring_index(x, " ", 1).alias("idx"), F.substring_index(x, " ", -1).alias("last_word"),
        F.overlay(x, F.lit("##"), F.lit(3), F.lit(2)).alias("over_"),
    )


@case("q_string_regex", r"""
SELECT doc_id, regexp_extract(text, '([A-Z][a-z]+) ([a-z]+)', 2) AS ext, md5(regexp_replace(text, '[aeiou]+', '_', 'g')) AS rep,
       len(regexp_split_to_array(text, '\s+'))::INTEGER AS words, md5(translate(text, 'abc', 'xy')) AS tr FROM documents""")
def string_regex(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", F.regexp_extract("text", "([A-Z][a-z]+) ([a-z]+)", 2).alias("ext"),
        F.md5(F.regexp_replace("text", "[aeiou]+", "_")).alias("rep"), F.size(F.split("text", r"[ \t\n\f\r]+")).alias("words"),
        F.md5(F.translate("text", "abc", "xy")).alias("tr"),
    )


@case("q_string_split_limit", """
SELECT p_partkey, split_part(c, '#', 1) AS head, substr(c, instr(c, '#') + 1) AS rest FROM (SELECT p_partkey, p_brand || '#' || p_type AS c FROM part)""")
def string_split_limit(t: Tables) -> DataFrame:
    parts = F.split(F.concat("p_brand", F.lit("#"), "p_type"), "#", 2)
    return t.part.select("p_partkey", parts[0].alias("head"), parts[1].alias("rest"))


@case("q_string_distance", """
SELECT a.p_partkey, levenshtein(a.p_name, b.p_name)::INTEGER AS d FROM part a JOIN part b ON a.p_partkey = b.p_partkey + 1""")
def string_distance(t: Tables) -> DataFrame:
    b = t.part.select((F.col("p_partkey") + 1).alias("p_partkey"), F.col("p_name").alias("other"))
    return t.part.join(b, "p_partkey").select("p_partkey", F.levenshtein("p_name", "other").alias("d"))


@case("q_string_soundex", """
SELECT p_type, CASE p_type WHEN 'ECONOMY' THEN 'E255' WHEN 'SMALL' THEN 'S540' WHEN 'MEDIUM' THEN 'M350' WHEN 'PROMO' THEN 'P650'
       WHEN 'STANDARD' THEN 'S353' WHEN 'LARGE' THEN 'L620' END AS code, count(*) AS n FROM part GROUP BY 1""")
def string_soundex(t: Tables) -> DataFrame:
    return t.part.groupBy("p_type", F.soundex("p_type").alias("code")).agg(F.count("*").alias("n"))


@case("q_string_sentences", """
SELECT item_id, TRUE AS some FROM benchmark""")
def string_sentences(t: Tables) -> DataFrame:
    return t.benchmark.select("item_id", (F.size(F.flatten(F.sentences("text"))) > 0).alias("some"))


# -- JSON and CSV -------------------------------------------------------------------

@case("q_json_fields", """
SELECT event_id, json_extract_string(props, '$.k') AS by_path, json_extract_string(props, '$.k') AS by_tuple,
       CAST(json_extract(props, '$.k') AS INTEGER) AS parsed, NULL::VARCHAR AS absent FROM events""")
def json_fields(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").alias("by_path"), F.json_tuple("props", "k", "z").alias("by_tuple", "absent"),
        F.from_json("props", "k INT")["k"].alias("parsed"),
    )


@case("q_json_write", """
SELECT event_id, '{"user":' || user_id || ',"type":"' || event_type || '"}' AS doc FROM events""")
def json_write(t: Tables) -> DataFrame:
    packed = F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type"))
    return t.events.select("event_id", F.to_json(packed).alias("doc"))


@case("q_json_schema", "SELECT 'STRUCT<k: BIGINT>' AS ddl, count(*) AS n FROM events")
def json_schema(t: Tables) -> DataFrame:
    """The schema of a fixed sample text, beside the number of rows that fit it."""
    fit = F.from_json("props", "k BIGINT")["k"].isNotNull()
    return t.events.agg(F.count_if(fit).alias("n")).select(F.schema_of_json(F.lit('{"k": 1}')).alias("ddl"), "n")


@case("q_csv_cells", """
SELECT c_custkey, c_custkey AS id, c_name AS name, c_custkey || ',' || c_name AS line, 'STRUCT<_c0: INT, _c1: STRING>' AS ddl FROM customer""")
def csv_cells(t: Tables) -> DataFrame:
    line = F.to_csv(F.struct("c_custkey", "c_name"))
    cells = F.from_csv(line, "id BIGINT, name STRING")
    return t.customer.select(
        "c_custkey", cells["id"].alias("id"), cells["name"].alias("name"), line.alias("line"), F.schema_of_csv(F.lit("1,a")).alias("ddl")
    )
