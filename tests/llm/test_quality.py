import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import quality as Q

DOCS = "doc_id bigint, text string, lang string, kept string, n string"
FOLD = "0 AS m"


def brute_model(words, order):
    """Chance of a byte after its context, by the textbook recursion."""
    tops = Counter()
    for w in words:
        s = b" " + w + b" "
        for i in range(1, len(s)):
            tops[s[max(0, i - order + 1):i + 1]] += 1
    a = {order: {g: c for g, c in tops.items() if len(g) == order}}
    for k in range(order - 1, 0, -1):
        a[k] = Counter(g[1:] for g in a[k + 1])
        a[k].update({g: c for g, c in tops.items() if len(g) == k})
    stats = {}
    for k, grams in a.items():
        n = [sum(c == i for c in grams.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
        d = [i - (i + 1) * y * n[i + 1] / n[i] if n[i] and n[i + 1] else 0.5 for i in (1, 2, 3)]
        d = [min(max(x, 0.1), i - 0.1) for i, x in enumerate(d, 1)]
        total, left = Counter(), defaultdict(float)
        for g, c in grams.items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3) - 1]
        stats[k] = (d, total, left)

    def p(g):
        if not g:
            return 1 / 256
        d, total, left = stats[len(g)]
        lower = p(g[1:])
        c = a[len(g)].get(g, 0)
        if not total.get(g[:-1]):
            return lower
        return (c - (d[min(c, 3) - 1] if c else 0)) / total[g[:-1]] + left[g[:-1]] / total[g[:-1]] * lower

    return p


def brute_score(p, text, order):
    n, total = 0, 0.0
    for w in (text or "").encode().split():
        s = b" " + w + b" "
        for i in range(1, len(s)):
            total += math.log(p(s[max(0, i - order + 1):i + 1]))
            n += 1
    return n, total


@pytest.mark.parametrize("order,head", [(7, 1 << 20), (3, 1 << 20), (7, 20), (2, 1)])
def test_scores_against_brute_force(spark, order, head):
    pick = random.Random(order)
    text = lambda k: " ".join("".join(pick.choices("abcdeé", k=pick.randint(1, 6))) for _ in range(k))
    train = [text(pick.randint(1, 30)) for _ in range(40)] + ["a", "bb"]
    rows = [*enumerate([*train, text(9), "zzz xyz", "", None, " \n", "漢字 " * 50, "e" * 3000]), (3, "twice b"), (3, "twice b"), (None, "ab")]
    table = Q.model(Q.count(spark.createDataFrame([(t,) for t in train], "text string").selectExpr("text", FOLD), order), order)
    p = brute_model([w for t in train for w in t.encode().split()], order)
    docs = spark.createDataFrame([(i, t, "l", "x", "y") for i, t in rows], DOCS).selectExpr("*", FOLD)
    got = sorted(((r.doc_id if r.doc_id is not None else -1, r.n, r.log_p) for r in Q.score(docs, table, order, head).collect()))
    want = sorted((i if i is not None else -1, *brute_score(p, t, order)) for i, t in rows)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(math.isclose(g[2], w[2], rel_tol=1e-6, abs_tol=1e-6) for g, w in zip(got, want))


def test_five_bytes_are_told_apart(spark):
    """Both words have only known stretches of four bytes; the fifth byte of "abcde" never follows "abcd"."""
    train = spark.createDataFrame([("abcdx zbcde",)] * 20, "text string").selectExpr("text", FOLD)
    table = Q.model(Q.count(train, Q.ORDER))
    docs = spark.createDataFrame([(1, "abcdx", "l", "x", "y"), (2, "abcde", "l", "x", "y"), (3, "zbcde", "l", "x", "y")], DOCS).selectExpr("*", FOLD)
    for head in (1 << 20, 1):
        got = {r.doc_id: r.log_p for r in Q.score(docs, table, head_size=head).collect()}
        assert got[2] < min(got[1], got[3]) - 1


def test_the_model_grows_with_the_vocabulary(spark):
    pick = random.Random(4)
    words = ["".join(pick.choices("etaoinsrhld", k=8)) for _ in range(2000)]
    sizes = [Q.model(Q.count(spark.createDataFrame([(" ".join(words[:n]),)], "text string").selectExpr("text", FOLD), Q.ORDER)).count() for n in (500, 2000)]
    assert sizes[1] > 2 * sizes[0]


@pytest.mark.parametrize("head", [1 << 20, 5])
def test_models_leave_out_their_fold(spark, head):
    """Model 0 has seen the texts of fold 1 only, and scores fold 0; both are built together."""
    texts = {0: "aaa bbb aab " * 9, 1: "ccc ddd ccd " * 7}
    train = spark.createDataFrame([(t, m) for m, t in texts.items()], "text string, m int")
    counts = Q.count(train, 4).withColumn("m", 1 - F.col("m"))
    docs = spark.createDataFrame([(m, t, "l", "x", "y", m) for m, t in texts.items()], DOCS + ", m int")
    got = {r.doc_id: r.log_p for r in Q.score(docs, Q.model(counts, 4), 4, head).collect()}
    for m in (0, 1):
        p = brute_model(texts[1 - m].encode().split(), 4)
        assert math.isclose(got[m], brute_score(p, texts[m], 4)[1], rel_tol=1e-5)


def test_thresholds_against_brute_force(spark):
    pick = random.Random(9)
    rows = [(lang, pick.gauss(mean, 0.3)) for lang, mean, n in (("a", 1, 900), ("b", 2, 40), (None, 3, 1)) for _ in range(n)]
    middle, top = {}, lambda xs, q: sorted(xs)[max(math.ceil(q * len(xs)) - 1, 0)]
    for lang in ("a", "b", None):
        middle[lang] = top([x for k, x in rows if k == lang], 0.5)
    above = [x - middle[lang] for lang, x in rows]
    mean = sum(above) / len(above)
    sd = math.sqrt(sum((x - mean) ** 2 for x in above) / len(above))
    want = {}
    for lang, m in middle.items():
        xs = [x - m for k, x in rows if k == lang]
        want[lang] = m + (len(xs) * top(xs, 0.995) + Q.DRAW * top(above, 0.995)) / (len(xs) + Q.DRAW) + Q.MARGIN * sd / math.sqrt(len(xs))
    got = {r.lang: r.most for r in Q.thresholds(spark.createDataFrame(rows, "lang string, x double")).collect()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-9) for k in want)


def test_judges_by_language(spark):
    pick = random.Random(7)
    say = {"x": "the of and ing ed ly".split(), "y": "que les des une ent".split()}
    text = lambda lang: " ".join("".join(pick.choices(say[lang], k=pick.randint(1, 3))) for _ in range(60))
    docs = [(i, text("xy"[i % 2]), "xy"[i % 2], "a", "b") for i in range(400)]
    docs += [(1000 + i, "#$%^ qqzx 9999 " * 20, "xy"[i % 2], "a", "b") for i in range(20)] + [(2000, None, None, None, None), (None, text("x"), None, "a", "b")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 400)] + [(1000, 0, 0), (None, 1, 0), (5, None, 1)], "doc_id bigint, quality int, toxic int")
    frame = spark.createDataFrame(docs, DOCS)
    kept = Q.keep_good(frame, labels)
    assert kept.columns == frame.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids & set(range(400))) >= 385 and not ids & {2000, *range(1000, 1020)} and None in ids
    assert Q.judge(frame.limit(0), labels).count() == 0
    assert Q.judge(frame, labels.limit(0)).where("kept").count() == len(docs) - 1


def test_clean_texts_of_small_languages_stay(spark):
    """12 trusted rows in one language, one in another and none in a third; bad texts of the first still go."""
    pick = random.Random(3)
    say = {"x": "the of and ing ed ly".split(), "y": "que les des une ent".split(), "z": "wok zug kopf jahr".split(), "w": "ñam çok búl".split()}
    text = lambda lang: " ".join("".join(pick.choices(say[lang], k=pick.randint(1, 3))) for _ in range(pick.choice([8, 60])))
    docs = [(1000 * k + i, text(lang), lang, "a", "b") for k, lang in enumerate("xyzw") for i in range(240 if lang == "x" else 60)]
    docs += [(9000 + i, "#$%^ qqzx 9999 " * 20, "xy"[i % 2], "a", "b") for i in range(10)]
    labels = spark.createDataFrame([(i, 1, 0) for i in [*range(220), *range(1000, 1012), 2000]], "doc_id bigint, quality int, toxic int")
    out = Q.judge(spark.createDataFrame(docs, DOCS), labels).collect()
    gone = {r.doc_id for r in out if not r.kept}
    assert len(out) == len(docs) and set(range(9000, 9010)) <= gone
    assert not {i for i in gone if 1000 <= i < 9000} and len(gone) <= 16
    assert {r.lang: r.threshold is not None for r in out} == {"x": True, "y": True, "z": True, "w": False}


def test_a_worker_takes_text_in_small_slices():
    """Counting and scoring go through a batch a few MB of text at a time, so a worker's memory stays bounded, whatever its batch holds."""
    import pyarrow as pa

    from millrace.llm.frames import slices

    text = "word " * 200_000  # a MB a row
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 20)], ["text"])
    pieces = list(slices(iter([batch]), "text", Q.SLICE_BYTES))
    assert sum(p.num_rows for p in pieces) == 20
    assert max(sum(len(t) for t in p["text"].to_pylist()) for p in pieces) <= 4 << 20
