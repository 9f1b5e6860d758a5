"""Nulls, ties, repeated rows, empty tables and further columns for op2, op4, op9, op10; whole pipeline on made rows."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing, perspectives, pii, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


TEXTS = [
    None, "", "mail a.b@c.de, or x@y@z.org and a@b.", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 01.02.03.004",
    "card 4111 1111 1111 1111 not 4111 1111 1111 1112; 4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1", "call +49 (30) 1234-567 or +1 2",
    "é😀 q@r.st " * 300, "+" * 5000 + "1.1.1.1", "9" * 20000,
]
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, match):
    number = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "phone":
        return 9 <= len(number) <= 15
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(number[::-1])]
        return 13 <= len(number) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return True


def test_pii_against_plain_patterns(spark):
    got = {r["doc_id"]: r for r in pii.digest(docs(spark, [(i, t, "a") for i, t in enumerate(TEXTS)]).withColumn("spans", F.lit(1))).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        found = {k: [m.span() for m in re.finditer(p, text or "") if passes(k, m.group())] for k, p in PLAIN.items()}
        joined = ",".join(f"{k}:{a}:{b}" for k, spans in found.items() for a, b in spans)
        assert [got[i][f"n_{k}"] for k in PLAIN] == [len(found[k]) for k in PLAIN], text and text[:60]
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert got[i]["spans"].startswith(joined)
    assert pii.digest(docs(spark, [(1, "x", "a")]).limit(0)).count() == 0


def test_mixture_bounds_nulls_and_repeats(spark):
    rows = [(i, "w " * (1 + i % 7), "big") for i in range(300)] + [(1000 + i, "w", None) for i in range(20)]
    rows += [(2000, None, "b"), (2001, "", "b"), (None, "a b", "c"), (3000, "x y z", "c"), (3000, "x y z", "c")]
    table, labels = docs(spark, rows), spark.createDataFrame([(1, 1, 0), (2, None, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    first = mixing.mixture(table, labels).collect()
    assert sorted(map(str, first)) == sorted(map(str, mixing.mixture(table.repartition(5), labels).collect()))
    assert len(first) == len(rows) and all(0 <= r["taken"] <= 2 * r["size"] for r in first)
    total = sum(r["size"] for r in first)
    by_source = {}
    for r in first:
        by_source.setdefault(r["source"], []).append(r)
    goals = {s: x[0]["target"] for s, x in by_source.items()}
    assert sum(goals.values()) == pytest.approx(1.5 * total) or all(goals[s] == 2 * x[0]["source_size"] for s, x in by_source.items())
    for own in by_source.values():
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
    mixed = mixing.mix(table.withColumn("copies", F.lit("mine")), labels)
    assert mixed.columns == [*table.columns, "copies"] and mixed.count() == sum(r["copies"] for r in first)
    assert mixing.mixture(table.limit(0), labels).count() == 0


def test_perspectives_of_nulls_ties_and_parts(spark):
    turns = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|>"), (1, 2, "bob", None), (1, 2, "bob", None), (1, 3, None, "x"),
             (None, None, "cy", ""), (2, 0, "system", "alone")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {(r["conv_id"], r["perspective"], r["part"]): r for r in perspectives.perspectives(table.withColumn("part", F.lit("mine"))).collect()}
    assert {k[:2] for k in got} == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "cy")}
    ann = got[1, "ann", 0]
    a, b = map(int, ann["mask"].split(":"))
    assert ann["text"][a:b] == "hi < |end|><|end|>\n" and ann["n_turns"] == 5
    assert len(got[1, "bob", 0]["mask"].split(",")) == 2
    halves = perspectives.perspectives(table.where("conv_id = 1"), part_turns=2).where("perspective = 'ann'").orderBy("part").collect()
    assert [r["n_turns"] for r in halves] == [2, 2, 1] and "".join(r["text"] for r in halves) == ann["text"]
    assert [r["opening"] for r in halves] == ["", "<|system|>\nbe kind<|end|>\n", "<|system|>\nbe kind<|end|>\n"]
    assert perspectives.perspectives(table.limit(0)).count() == 0


def test_parts_open_with_the_system_turn_in_force(spark):
    """A talk of many parts with system turns between, against a plain walk over its turns."""
    turns = [(7, i, "system" if i % 5 == 3 else "ab"[i % 2], f"t{i}") for i in range(40)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {(r["perspective"], r["part"]): r for r in perspectives.perspectives(table, part_turns=4).collect()}
    assert len(got) == 20
    for (_, part), row in got.items():
        before, first = [t for t in turns[:4 * part] if t[2] == "system"], turns[4 * part]
        assert row["opening"] == (f"<|system|>\n{before[-1][3]}<|end|>\n" if before and first[2] != "system" else "")


def test_codes_of_every_country_and_redaction(spark):
    """Account numbers with right check digits of every country are found, with a wrong one not; all spans are replaced."""
    codes = []
    for country, length in pii.IBAN_LENGTHS.items():
        body = "".join(str((i * 7 + length) % 10) for i in range(length - 4))
        number = int("".join(str(int(c, 36)) for c in body + country + "00"))
        codes.append((f"{country}{98 - number % 97:02d}{body}", f"{country}{(98 - number % 97) % 96 + 2:02d}{body}"))
    rows = [(i, f"bank account {good}, and {wrong} é", "a") for i, (good, wrong) in enumerate(codes)]
    rows += [(900, "😀 mail a.b@c.de now, 1.2.3.4 ip", "a"), (901, None, "a"), (902, "", "a"), (None, "plain", None)]
    table = docs(spark, rows)
    got = {r["doc_id"]: r for r in pii.digest(table).collect()}
    for i, (good, wrong) in enumerate(codes):
        assert good != wrong and f"iban:13:{13 + len(good)}" in got[i]["spans"].split(",") and got[i]["n_iban"] == 1, good
    clean = {r["doc_id"]: r["text"] for r in pii.redact(table).collect()}
    assert clean[900] == "😀 mail <email> now, <ip> ip" and clean[None] == "plain" and not clean[901] and clean[902] == ""
    assert all(clean[i].startswith("bank account <iban>, and ") for i in range(len(codes)))


def test_toxicity_fit_is_the_greatest_likelihood():
    """The fit against a plain likelihood, row by row: no step along a weight or a cut makes it greater."""
    import math

    import numpy as np

    pick = np.random.default_rng(4)
    rows, n = 90, 3
    has = pick.random((rows, n)) < 0.4
    times, size = pick.integers(1, 5, (rows, n)), pick.integers(5, 60, rows)
    toxic = has[:, 0] & (pick.random(rows) < 0.8) | (pick.random(rows) < 0.1)
    row, place = np.nonzero(has)
    model = toxicity.fit(np.arange(n).astype(np.uint64), np.array([1.0, 1.0, -1.0]), place, row, times[row, place], size, toxic)
    rate = np.log1p(100 * times / (size[:, None] + 50))
    lean = (rate * has)[:, :2].sum(axis=1)
    thirds = np.quantile(lean[toxic], [1 / 3, 2 / 3])
    grade = [0 if not toxic[i] else 1 + sum(lean[i] > q for q in thirds) for i in range(rows)]

    def likelihood(p):
        total = -toxicity.PENALTY / 2 * sum(x * x for x in p[:2 * n])
        for i in range(rows):
            at = sum((p[j] + p[n + j] * rate[i, j]) for j in range(n) if has[i, j])
            above = [1.0, *(1 / (1 + math.exp(-(at - cut))) for cut in p[2 * n:]), 0.0]
            total += math.log(above[grade[i]] - above[grade[i] + 1])
        return total

    best = [*model.occurs, *model.often, *model.cuts]
    assert list(model.cuts) == sorted(model.cuts)
    top = likelihood(best)
    for k in range(len(best)):
        for step in (-0.05, 0.05):
            assert likelihood([x + step * (j == k) for j, x in enumerate(best)]) < top + 1e-3
    assert top > likelihood([0.0] * (2 * n) + list(model.cuts))


def test_toxicity_on_made_rows(spark):
    good = [(i, f"the garden was calm and word{i % 13} grew", "a") for i in range(120)]
    bad = [(500 + i, f"you vile scum word{i % 13} {'vile ' * (i % 4)}", "a") for i in range(60)]
    table = docs(spark, good + bad + [(900, None, "a"), (901, "", None), (902, "vile scum " * 20_000, "a"), (903, "calm garden", "a")])
    marks = [(i, 1, int(i >= 500)) for i, *_ in good + bad] + [(None, 1, 1), (900, 1, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity.severity(table, labels).collect()}
    assert all(got[i]["toxic"] for i, *_ in bad) and not any(got[i]["toxic"] for i, *_ in good)
    assert got[902]["toxic"] and not got[903]["toxic"] and not got[900]["toxic"] and not got[901]["toxic"]
    assert all(0 <= r["expected_severity"] <= 3 for r in got.values())
    assert toxicity.severity(table.limit(0), labels.limit(0)).count() == 0
    assert toxicity.severity(table, labels.where("toxic = 0")).where("toxic").count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    texts = [" ".join(words[(7 * i + j * (1 + i % 5)) % 400] for j in range(60)) for i in range(30)]
    rows = [(i, t, "ab"[i % 2]) for i, t in enumerate(texts)]
    rows += [(100, texts[0], "a"), (101, texts[1] + " tail", "b")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    table, folder = spark.read.parquet(str(tmp_path / "documents.parquet")), str(tmp_path)
    stage = dict(corpus_pipeline.STAGES)
    for name in list(stage)[:-1]:
        assert stage[name](spark, table, folder).columns == table.columns
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").collect()}
    every = {i for i, *_ in rows}
    assert ids(stage["exact dedup"](spark, table, folder)) == every - {0}
    assert len(every & ids(stage["near dedup"](spark, table, folder))) == 30
    assert ids(corpus_pipeline.run(spark, folder)) <= every - {0}
