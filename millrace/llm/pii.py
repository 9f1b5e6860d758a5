"""Personal data in texts, in DataFrame operations only: one narrow pass, no shuffle.

Regular expressions propose spans; checksum and range validators confirm them; words near a
span move its score. Email, ip, card and phone are the base kinds: a confirmed span stays
whatever its score. Iban (country length and mod-97) and ssn are added where their score
reaches `KEEP`; an ssn needs a word that speaks for it.

A match's place comes from the pieces between matches: `split` and `regexp_extract_all` walk
a text alike, so the lengths of pieces and matches before a match add up to its start, in
code points. The sums are taken in blocks of about the square root of the number of matches,
so a text with very many of them costs no quadratic time.

The patterns are written with possessive quantifiers and a look behind where the plain form
would try every start within a run again: the same matches, in time linear in the text, and
no deep recursion on very long runs.

A null text counts as empty and has no span. Rows are independent of each other: repeated
rows give repeated results, an empty table gives none; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP = 50       # lowest score of an added span, of 100
NEAR = 40       # code points before and after a span that are looked at
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn")

_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
OCTETS = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"

# Length of an IBAN by country, as the ISO 13616 registry has it.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24,
    "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26,
    "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

#: (pattern, the plain form of it, score, words that speak for it, words that speak against it)
RULES = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
              r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 80, "mail|contact|write|reach", "noreply|no-reply"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
           r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", 60, "ip|host|server|address|login", "version|release|section"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9](?:[\x20-]?[0-9])+", 70, "card|visa|master|credit|pay", "order|tracking|isbn"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", 70, "phone|call|tel|mobile|fax", "isbn|version"),
    "iban": (r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}", 80, "iban|bank|account|transfer", "serial|model"),
    "ssn": (r"[0-9]{3}-[0-9]{2}-[0-9]{4}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 30, "ssn|social|security|tax", "part|order|model"),
}
UP, DOWN = 20, 20


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running_sums(values: Column) -> Column:
    """Sums up to and with each entry of an array of bigint, in time n * sqrt(n)."""
    zero = F.lit(0).cast("bigint")
    total = lambda part: F.aggregate(part, zero, lambda a, x: a + x)

    def cut(v: Column, width: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(v) / width).cast("int") - 1),
                             lambda k: total(F.slice(v, k * width + 1, width)))
        empty = F.struct(F.array().cast("array<bigint>").alias("sums"), zero.alias("sum"))
        before = F.aggregate(blocks, empty, lambda a, x: F.struct(
            F.concat(a["sums"], F.array(a["sum"])).alias("sums"), (a["sum"] + x).alias("sum")))["sums"]
        return let(before, lambda b: F.transform(v, lambda x, i: b[F.floor(i / width).cast("int")] + x + total(
            F.slice(v, (F.floor(i / width) * width).cast("int") + 1, (i % width).cast("int")))))

    return let(values, lambda v: F.when(F.size(v) == 0, v).otherwise(
        let(F.ceil(F.sqrt(F.size(v))).cast("int"), lambda width: cut(v, width))))


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of at most 20 digits passes Luhn's check: every second digit from the right counts double."""
    padded = F.lpad(number, 20, "0")

    def step(total: Column, i: Column) -> Column:
        digit = F.substring(padded, i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0), step) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an IBAN without blanks leaves 1 on division by 97: first four signs last, letters as 10 to 35."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))

    def step(rest: Column, sign: Column) -> Column:
        number = F.when(sign.rlike("[0-9]"), sign.cast("int")).otherwise(F.ascii(sign) - 55)
        return (rest * F.when(number > 9, 100).otherwise(10) + number) % 97

    signs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(turned), F.lit(1))), lambda i: F.substring(turned, i, F.lit(1)))
    return F.aggregate(F.filter(signs, lambda s: s != ""), F.lit(0), step) == 1


def _iban(match: Column) -> Column:
    """The start of a match that is as long as its country's codes are; empty where it is too short."""
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    length = F.coalesce(F.try_element_at(lengths, F.substring(match, 1, 2)), F.lit(99))
    pattern = F.concat(F.lit(r"^(?:\x20?[A-Z0-9]){"), length.cast("string"), F.lit("}"))
    return F.coalesce(F.regexp_substr(match, pattern), F.lit(""))


def _count(match: Column, least: int, most: int) -> Column:
    return F.length(digits(match)).between(least, most)


def _confirmed(kind: str, s: Column) -> Column:
    match = s["match"]
    if kind == "ip":
        return match.rlike(OCTETS)
    if kind == "card":
        return F.when(_count(match, 13, 19), luhn(digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return _count(match, 9, 15)
    if kind == "iban":
        return F.when(match != "", mod97(F.replace(match, F.lit(" "), F.lit("")))).otherwise(F.lit(False))
    if kind == "ssn":
        return ~s["before"].rlike("[0-9]$") & ~s["after"].rlike("^[0-9]")
    return F.lit(True)


def _score(kind: str, s: Column) -> Column:
    _, _, score, good, bad = RULES[kind]
    near = F.lower(F.concat_ws(" ", s["before"], s["after"]))
    word = lambda words: near.rlike(rf"(?:^|[^a-z])(?:{words})")
    moved = F.lit(score) + F.when(word(good), UP).otherwise(0) - F.when(word(bad), DOWN).otherwise(0)
    return F.least(moved, F.lit(100))


def spans(text: Column, kind: str) -> Column:
    """Array of (kind, start, end, score) of a text's confirmed spans of one kind, by start."""
    pattern = RULES[kind][0]
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:int>>")

    def placed(m: Column, g: Column) -> Column:
        steps = F.transform(m, lambda x, i: (F.length(g[i]) + F.when(i > 0, F.length(m[F.greatest(i - 1, F.lit(0))])).otherwise(0)).cast("bigint"))
        proposed = let(running_sums(steps), lambda starts: F.transform(m, lambda x, i: F.struct(
            (_iban(x) if kind == "iban" else x).alias("match"), starts[i].alias("start"),
            F.right(g[i], F.lit(NEAR)).alias("before"), F.left(g[i + 1], F.lit(NEAR)).alias("after"))))
        scored = F.transform(F.filter(proposed, lambda s: _confirmed(kind, s)), lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), (s["start"] + F.length(s["match"])).alias("end"),
            _score(kind, s).cast("int").alias("score")))
        return scored if kind in BASE else F.filter(scored, lambda s: s["score"] >= KEEP)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) == 0, none).otherwise(
        let(F.split(text, pattern, -1), lambda g: placed(m, g))))


def find(docs: DataFrame) -> DataFrame:
    """doc_id and `found`, the array of all spans by kind and start."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", *[spans(text, kind).alias(kind) for kind in (*BASE, *ADDED)])


def _joined(kinds: tuple[str, ...], score: bool = False) -> Column:
    fields = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"], *([s["score"]] if score else []))
    return F.array_join(F.transform(F.concat(*kinds), fields), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans, all spans and their scores as text."""
    n = [F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in (*BASE, *ADDED)]
    return find(docs).select("doc_id", *n, F.sha2(_joined(BASE).cast("binary"), 256).alias("base_sha256"),
                             _joined((*BASE, *ADDED)).alias("spans"), _joined((*BASE, *ADDED), score=True).alias("scores"))


def redact(docs: DataFrame) -> DataFrame:
    """All columns of `docs`, with `<kind>` in the text in place of every span; where spans overlap, the first one by start."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(*[spans(text, kind) for kind in (*BASE, *ADDED)])
    by_start = F.array_sort(F.transform(found, lambda s: F.struct(s["start"], s["end"], s["kind"])))
    state = F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("at"))

    def step(a: Column, s: Column) -> Column:
        piece = F.substring(F.col("text"), (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int"))
        return F.when(s["start"] < a["at"], a).otherwise(F.struct(
            F.concat(a["text"], piece, F.lit("<"), s["kind"], F.lit(">")).alias("text"), s["end"].alias("at")))

    ended = lambda a: F.concat(a["text"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.length("text")))
    return docs.withColumn("text", F.when(F.col("text").isNotNull(), F.aggregate(by_start, state, step, ended)))


def _sql_kind(kind: str) -> str:
    """DuckDB SQL for one kind's spans: (row, kind, nth kind, start, end, score)."""
    _, plain, score, good, bad = RULES[kind]
    match = "m[i]"
    if kind == "iban":
        lengths = "MAP {" + ", ".join(f"'{k}': {v}" for k, v in IBAN_LENGTHS.items()) + "}"
        match = f"regexp_extract(m[i], '^(?:\\x20?[A-Z0-9]){{' || coalesce({lengths}[m[i][1:2]], 99)::VARCHAR || '}}')"
    number = "regexp_replace(match, '[^0-9]', '', 'g')"
    turned = "replace(match, ' ', '')[5:] || replace(match, ' ', '')[1:4]"
    double = f"(lpad({number}, 20, '0')[x]::INT * (1 + x % 2))"
    luhn_sum = f"list_sum(list_transform(range(1, 21), lambda x: {double} - CASE WHEN {double} > 9 THEN 9 ELSE 0 END))"
    value = "CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE (ascii(c) - 55)::VARCHAR END"
    sure = {
        "ip": f"regexp_matches(match, '{OCTETS}')",
        "card": f"CASE WHEN length({number}) BETWEEN 13 AND 19 THEN {luhn_sum} % 10 = 0 ELSE FALSE END",
        "phone": f"length({number}) BETWEEN 9 AND 15",
        "iban": f"CASE WHEN match <> '' THEN list_reduce(list_transform(list_concat(['0'], string_split(array_to_string(list_transform(string_split({turned}, ''), lambda c: {value}), ''), '')), lambda d: d::INT), lambda a, d: (a * 10 + d) % 97) = 1 ELSE FALSE END",
        "ssn": "NOT regexp_matches(bef, '[0-9]$') AND NOT regexp_matches(aft, '^[0-9]')",
    }.get(kind, "TRUE")
    near = "lower(right(bef, 40) || ' ' || left(aft, 40))"
    points = f"least(100, {score} + CASE WHEN regexp_matches({near}, '(?:^|[^a-z])(?:{good})') THEN {UP} ELSE 0 END - CASE WHEN regexp_matches({near}, '(?:^|[^a-z])(?:{bad})') THEN {DOWN} ELSE 0 END)"
    nth = (*BASE, *ADDED).index(kind)
    keep = "TRUE" if kind in BASE else f"score >= {KEEP}"
    return f"""
      SELECT r, '{kind}' AS kind, {nth} AS nth, s, s + length(match) AS e, {points} AS score
      FROM (SELECT r, {match} AS match, g[i] AS bef, g[i + 1] AS aft,
              sum(length(g[i]) + CASE WHEN i > 1 THEN length(m[i - 1]) ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS s
            FROM (SELECT r, m, g, unnest(range(1, len(m) + 1)) AS i FROM (
              SELECT r, regexp_extract_all(t, '{plain}') AS m, string_split_regex(t, '{plain}') AS g FROM d) WHERE len(m) > 0))
      WHERE {sure} AND {keep}"""


def sql() -> str:
    kinds = (*BASE, *ADDED)
    text = "string_agg(kind || ':' || CAST(s AS BIGINT)::VARCHAR || ':' || CAST(e AS BIGINT)::VARCHAR{}, ',' ORDER BY nth, s)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in kinds)
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    found AS ({' UNION ALL '.join(_sql_kind(k) for k in kinds)}),
    a AS (SELECT r, {counts}, {text.format('')} AS spans, {text.format(" || ':' || score::VARCHAR")} AS scores,
            {text.format('')} FILTER (nth < {len(BASE)}) AS base FROM found GROUP BY r)
    SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in kinds)}, sha256(coalesce(base, '')) AS base_sha256,
      coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM d LEFT JOIN a USING (r)"""
