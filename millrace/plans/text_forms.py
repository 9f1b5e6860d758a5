"""Query cases: string and calendar accessors of the pandas manner."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import calendar as cal
from millrace.functions import text as tx
from millrace.plans.registry import Tables, case


@case("q_text_case_shape", """
SELECT p_partkey, upper(substr(n, 1, 1)) || lower(substr(n, 2)) AS capital, upper(n) AS swapped, rpad(p_type, 9, '.') AS lj, lpad(p_type, 9, '.') AS rj,
       lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS zf, '-' || lpad(CAST(p_size AS VARCHAR), 4, '0') AS zneg, substr(n, 3, 3) AS sl, substr(n, length(n) - 1) AS tail,
       substr(n, 1, 1) || '##' || substr(n, 4) AS repl, substr(n, 1, 1) || substr(n, 3, 1) || substr(n, 5, 1) AS stepped
FROM (SELECT *, p_name AS n FROM part)""")
def text_case_shape(t: Tables) -> DataFrame:
    n = F.col("p_name")
    return t.part.select(
        "p_partkey", tx.capitalize(n).alias("capital"), tx.swapcase(n).alias("swapped"), tx.ljust(F.col("p_type"), 9, ".").alias("lj"),
        tx.pad(F.col("p_type"), 9, "left", ".").alias("rj"), tx.zfill(F.col("p_partkey").cast("string"), 7).alias("zf"),
        tx.zfill(F.concat(F.lit("-"), F.col("p_size").cast("string")), 5).alias("zneg"), tx.slice_text(n, 2, 5).alias("sl"),
        tx.slice_text(n, -2).alias("tail"), tx.slice_replace(n, 1, 3, "##").alias("repl"), tx.slice_text(n, 0, 5, 2).alias("stepped"),
    )


@case("q_text_title_center", """
SELECT p_partkey, array_to_string(list_transform(string_split(n, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS titled,
       repeat('*', e // 2) || n || repeat('*', e - e // 2) AS even_, repeat('*', o // 2 + o % 2) || n || repeat('*', o // 2) AS odd_,
       length(p_brand)::INTEGER AS last_hash, p_brand AS before_, p_size::VARCHAR AS after_, n AS whole, p_partkey % 2 = 0 AS numeric_, p_partkey % 3 = 0 AS title_
FROM (SELECT *, p_name AS n, greatest(14 - length(p_name), 0) AS e, greatest(15 - length(p_name), 0) AS o FROM part)""")
def text_title_center(t: Tables) -> DataFrame:
    n, tagged = F.col("p_name"), F.concat_ws("#", "p_brand", "p_size")
    mixed = F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_brand"))
    cased = F.when(F.col("p_partkey") % 3 == 0, tx.title(n)).otherwise(n)
    return t.part.select(
        "p_partkey", tx.title(n).alias("titled"), tx.center(n, 14, "*").alias("even_"), tx.center(n, 15, "*").alias("odd_"),
        tx.index_of(tagged, "#", last=True).alias("last_hash"), tx.rpartition(tagged, "#")[0].alias("before_"), tx.rpartition(tagged, "#")[2].alias("after_"),
        tx.rpartition(n, "#")[2].alias("whole"), tx.is_class(mixed, "isnumeric").alias("numeric_"), tx.is_class(cased, "istitle").alias("title_"),
    )


@case("q_text_search", """
SELECT doc_id, instr(text, 'an')::INTEGER - 1 AS f, CASE WHEN instr(reverse(text), 'na') = 0 THEN -1 ELSE length(text) - instr(reverse(text), 'na') - 1 END::INTEGER AS rf,
       regexp_matches(text, '^[A-Z]') AS m, len(regexp_extract_all(text, '[aeiou]'))::INTEGER AS vowels, array_to_string(regexp_extract_all(text, '[A-Z][a-z]+'), ' ') AS caps,
       regexp_extract(text, '[a-z]+', 0) AS ext FROM documents""")
def text_search(t: Tables) -> DataFrame:
    x = F.col("text")
    return t.documents.select(
        "doc_id", tx.find(x, "an").alias("f"), tx.rfind(x, "an").alias("rf"), tx.matches(x, "[A-Z]").alias("m"), tx.count(x, "[aeiou]").alias("vowels"),
        F.array_join(tx.findall(x, "[A-Z][a-z]+"), " ").alias("caps"), F.regexp_extract(x, "[a-z]+", 0).alias("ext"),
    )


@case("q_text_extract_all", """
SELECT page_id, CAST(i - 1 AS INTEGER) AS place, v[i] AS tag FROM (SELECT page_id, v, unnest(range(1, len(v) + 1)) AS i
FROM (SELECT page_id, regexp_extract_all(html, '<([a-z0-9]+)', 1) AS v FROM pages))""")
def text_extract_all(t: Tables) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit("<([a-z0-9]+)"), F.lit(1))
    return t.pages.select("page_id", F.posexplode(found).alias("place", "tag"))


@case("q_text_split_join", """
SELECT page_id, split_part(url, '://', 1) AS scheme, split_part(url, '/', -1) AS last_, length(url) - length(split_part(url, '/', -1)) - 1 AS head_len,
       split_part(substr(url, instr(url, '://') + 3), '/', 1) AS host, array_to_string(string_split(url, '/'), '-') AS joined, string_split(url, '/')[3] AS third,
       CASE WHEN instr(url, '?') > 0 THEN substr(url, instr(url, '?') + 1) ELSE '' END AS query_
FROM pages""".replace("length(url) - length(split_part(url, '/', -1)) - 1 AS", "CAST(length(url) - length(split_part(url, '/', -1)) - 1 AS INTEGER) AS"))
def text_split_join(t: Tables) -> DataFrame:
    u = F.col("url")
    right = tx.rsplit_n(u, "/", 1)
    after = tx.partition(u, "://")[2]
    return t.pages.select(
        "page_id", tx.split_n(u, "://", 1)[0].alias("scheme"), right[1].alias("last_"), F.length(right[0]).alias("head_len"),
        tx.partition(after, "/")[0].alias("host"), F.array_join(tx.split_n(u, "/"), "-").alias("joined"), tx.split_n(u, "/")[2].alias("third"),
        tx.partition(u, "?")[2].alias("query_"),
    )


@case("q_text_flags", """
SELECT l_orderkey, l_linenumber, l_partkey, (l_returnflag = 'R' OR l_linestatus = 'R')::INTEGER AS R, (l_returnflag = 'O' OR l_linestatus = 'O')::INTEGER AS O FROM lineitem""")
def text_flags(t: Tables) -> DataFrame:
    both = F.concat_ws("|", "l_returnflag", "l_linestatus")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", *[c.alias(v) for v, c in tx.flags(both, ["R", "O"]).items()])


@case("q_text_trim_replace", """
SELECT c_custkey, trim(s, '*-') AS both_, ltrim(s, '*-') AS left_, rtrim(s, '*-') AS right_, replace(c_mktsegment, 'E', 'e') AS lit_, regexp_replace(c_mktsegment, '[AEIOU]', '.') AS first_only,
       translate(c_mktsegment, 'AE', 'ae') AS tr, length(c_mktsegment)::INTEGER AS n
FROM (SELECT *, '*-' || c_mktsegment || '-*' AS s FROM customer)""")
def text_trim_replace(t: Tables) -> DataFrame:
    seg = F.col("c_mktsegment")
    s = F.concat(F.lit("*-"), seg, F.lit("-*"))
    marks = F.lit("*-")
    return t.customer.select(
        "c_custkey", F.trim(s, marks).alias("both_"), F.ltrim(s, marks).alias("left_"), F.rtrim(s, marks).alias("right_"),
        tx.replace(seg, "E", "e", regex=False).alias("lit_"), tx.replace(seg, "[AEIOU]", ".", n=1).alias("first_only"),
        F.translate(seg, "AE", "ae").alias("tr"), F.length(seg).alias("n"),
    )


@case("q_text_class_tests", r"""
SELECT kind, count(*) FILTER (regexp_matches(w, '^[\p{L}\p{N}]+$')) AS isalnum, count(*) FILTER (regexp_matches(w, '^\p{L}+$')) AS isalpha, count(*) FILTER (regexp_matches(w, '^\p{Nd}+$')) AS isdigit,
       count(*) FILTER (w = upper(w) AND w <> lower(w)) AS isupper, count(*) FILTER (w = lower(w) AND w <> upper(w)) AS islower, count(*) FILTER (regexp_matches(w, '^\s+$')) AS isspace
FROM (SELECT lang AS kind, unnest(string_split_regex(text, '[ \t\n\f\r]+')) AS w FROM documents) GROUP BY 1""")
def text_class_tests(t: Tables) -> DataFrame:
    words = t.documents.select(F.col("lang").alias("kind"), F.explode(F.split("text", r"[ \t\n\f\r]+")).alias("w"))
    tests = ["isalnum", "isalpha", "isdigit", "isupper", "islower", "isspace"]
    return words.groupBy("kind").agg(*[F.count_if(tx.is_class(F.col("w"), name)).alias(name) for name in tests])


@case("q_text_normal_form", "SELECT doc_id, md5(nfc_normalize(text)) AS digest FROM documents")
def text_normal_form(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(tx.normalize(F.col("text"), "NFC")).alias("digest"))


@case("q_text_wrap", r"SELECT item_id, TRUE AS fits, trim(regexp_replace(text, '[ \t\n\f\r]+', ' ', 'g')) AS same_words FROM benchmark")
def text_wrap(t: Tables) -> DataFrame:
    wrapped = t.benchmark.select("item_id", tx.wrap(F.col("text"), 40).alias("w"))
    lines = F.split("w", "\n")
    return wrapped.select(
        "item_id", F.forall(lines, lambda x: F.length(x) <= 40).alias("fits"), F.replace("w", F.lit("\n"), F.lit(" ")).alias("same_words")
    )


# -- calendar ----------------------------------------------------------------------------

@case("q_calendar_fields", """
SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date_, strftime(ts, '%H:%M:%S') AS time_, (isodow(ts) - 1)::INTEGER AS weekday, dayname(ts) AS day_name,
       monthname(ts) AS month_name, day(last_day(ts))::INTEGER AS dim, (microsecond(ts) % 1000000)::INTEGER AS us FROM events""")
def calendar_fields(t: Tables) -> DataFrame:
    c = F.col("ts")
    return t.events.select(
        "event_id", F.to_date(c).cast("string").alias("date_"), F.date_format(c, "HH:mm:ss").alias("time_"), cal.weekday(c).alias("weekday"),
        cal.day_name(c).alias("day_name"), cal.month_name(c).alias("month_name"), cal.days_in_month(c).alias("dim"), cal.microsecond(c).alias("us"),
    )


@case("q_calendar_tests", """
SELECT o_orderkey, day(d) = 1 AS ms, d = last_day(d) AS me, day(d) = 1 AND month(d) IN (1, 4, 7, 10) AS qs, d = last_day(d) AND month(d) IN (3, 6, 9, 12) AS qe,
       dayofyear(d) = 1 AS ys, strftime(d, '%m%d') = '1231' AS ye, day(last_day(make_date(year(d), 2, 1))) = 29 AS leap FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def calendar_tests(t: Tables) -> DataFrame:
    c = F.col("o_orderdate")
    tests = {
        "ms": cal.is_month_start, "me": cal.is_month_end, "qs": cal.is_quarter_start, "qe": cal.is_quarter_end,
        "ys": cal.is_year_start, "ye": cal.is_year_end, "leap": cal.is_leap_year,
    }
    return t.orders.select("o_orderkey", *[f(c).alias(n) for n, f in tests.items()])


_FMT = "'%Y-%m-%d %H:%M:%S'"


@case("q_calendar_rounding", f"""
SELECT event_id, strftime(b, {_FMT}) AS floor_, strftime(CASE WHEN b = ts THEN b ELSE b + INTERVAL 15 MINUTE END, {_FMT}) AS ceil_,
       strftime(CASE WHEN ts - b > INTERVAL 450 SECOND THEN b + INTERVAL 15 MINUTE ELSE b END, {_FMT}) AS round_, strftime(date_trunc('day', ts), {_FMT}) AS midnight
FROM (SELECT *, time_bucket(INTERVAL 15 MINUTE, ts) AS b FROM events)""")
def calendar_rounding(t: Tables) -> DataFrame:
    c, pattern = F.col("ts"), "yyyy-MM-dd HH:mm:ss"
    shapes = {"floor_": cal.floor_to(c, 900), "ceil_": cal.ceil_to(c, 900), "round_": cal.round_to(c, 900), "midnight": cal.normalize(c)}
    return t.events.select("event_id", *[F.date_format(x, pattern).alias(n) for n, x in shapes.items()])


@case("q_calendar_time_filters", """
SELECT event_id FROM events WHERE strftime(ts, '%H:%M:%S.%f') >= '22:00:00.000000' OR strftime(ts, '%H:%M:%S.%f') <= '03:30:00.000000' OR strftime(ts, '%H:%M:%S') = '12:00:00'""")
def calendar_time_filters(t: Tables) -> DataFrame:
    c = F.col("ts")
    return t.events.where(cal.between_time(c, "22:00:00", "03:30:00") | cal.at_time(c, "12:00:00")).select("event_id")
