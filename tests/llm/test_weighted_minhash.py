import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from millrace.llm import weighted_minhash as M

SCHEMA = "doc_id bigint, text string, class_id string, kept int"


def sets(texts):
    words = [(t or "").split() for t in texts]
    tf = [Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter() for w in words]
    df = Counter(s for c in tf for s in c)
    idf = {s: min(1.0, max(M.FLOOR, math.log((len(texts) + M.PRIOR) / n) / math.log(1 / M.COMMON))) for s, n in df.items()}
    return [{s: n * idf[s] for s, n in c.items()} for c in tf]


def brute(rows, least=0.8):
    weights = sets([t for _, t in rows])
    low = {i: i for i, _ in rows}
    order = lambda i: -1 if i is None else i
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            x, y = weights[a], weights[b]
            both = sum(min(x[s], y[s]) for s in x.keys() & y.keys())
            total = sum(x.values()) + sum(y.values()) - both
            if (rows[a][1] or "") == (rows[b][1] or "") or total and both / total >= least:
                pairs.append((rows[a][0], rows[b][0]))
    for _ in rows:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b], key=order)
    return [(i, low[i]) for i, _ in rows]


def corpus(seed, n=60):
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows, i = [], 0
    for _ in range(n):
        words = pick.choices(vocabulary, k=pick.choice([3, 12, 60, 150]))
        for _ in range(pick.choice([1, 1, 2, 6])):
            own = list(words)
            for _ in range(pick.choice([0, 0, 1, 2])):
                own[pick.randrange(len(own))] = pick.choice(vocabulary)
            rows.append((i, " ".join(own)))
            i += 1
    # a group with a third of all rows, each one edited
    words = pick.choices(vocabulary, k=200)
    for _ in range(len(rows) // 2):
        own = list(words)
        own[pick.randrange(200)] = "x"
        rows.append((i, " ".join(own)))
        i += 1
    return rows


def test_against_brute_force(spark):
    rows = [*corpus(4), (5000, None), (5001, ""), (None, "w1 w2"), (5002, "w1 w2"), (5003, "b a b a " * 4000), (5004, "b a b a " * 4000 + "c"), (7, "alone but of id seven"), (5005, "one"), (5005, "one")]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    out = M.near_dedup(frame).collect()
    key = lambda x: (-1 if x[0] is None else x[0], -1 if x[1] is None else x[1])
    got, want = sorted(((r.doc_id, r.class_id) for r in out), key=key), sorted(brute(rows), key=key)
    assert len(got) == len(want)
    assert sum(g == w for g, w in zip(got, want)) >= 0.98 * len(want)
    classes = {c for _, c in got}
    assert sum(r.kept for r in out) == len(classes) and {r.doc_id for r in out if r.kept} == classes
    kept = M.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(key((r.doc_id, 0)) for r in kept.collect()) == sorted(key((c, 0)) for c in classes)


def test_empty(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert M.near_dedup(frame).count() == 0 and M.keep_one(frame).count() == 0


def test_samples_agree_as_often_as_texts_are_similar():
    pick = np.random.default_rng(1)
    n, agree, real = 400, 0, 0.0
    for _ in range(n):
        h = np.unique(pick.integers(0, 1 << 50, 40).astype(np.uint64))
        w1, w2 = pick.choice([0.2, 0.7, 1, 1, 1, 3], len(h)), pick.choice([0.2, 0.7, 1, 1, 1, 3], len(h))
        both = np.concatenate([h, h])
        first = np.array([0, len(h)])
        got = np.array([M.samples(both, np.concatenate([w1, w2]), first, k) for k in range(48)])
        agree += (got[:, 0] == got[:, 1]).mean()
        real += np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    assert abs(agree - real) / n < 0.02


def test_common_shingles_are_counted_exactly(spark):
    texts = [f"a b c d e f{i % 2} {' '.join(f'v{i}{k}' for k in range(9))}" for i in range(900)]
    weights = M.weights_of(spark.createDataFrame([(t,) for t in texts], "text string").repartition(7))
    hashes, row, _ = M.shingles(pa.array(texts))
    df = Counter(hashes.tolist())
    want = {h: n for h, n in df.items() if n > (900 + M.PRIOR) * M.COMMON}
    assert sorted(want) == weights.hashes.tolist()
    assert np.allclose(weights.idf, [min(1, max(M.FLOOR, math.log(1000 / want[h]) / math.log(4))) for h in sorted(want)])


def test_texts_of_one_id_are_documents_of_their_own(spark):
    """Null and repeated ids lose no text, and don't join classes that are not near."""
    pick = random.Random(9)
    a, b, c, d = (pick.choices([f"{k}{i}" for i in range(200)], k=120) for k in "abcd")
    near = lambda words: " ".join([*words[:-1], "end"])
    say = " ".join
    rows = [(None, say(a)), (None, say(b)), (None, say(b)), (5, near(a)), (9, near(b)), (7, say(c)), (7, say(d)), (7, say(d)), (8, near(d))]
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    kept = sorted((r.doc_id or -1, r.text) for r in M.keep_one(frame).collect())
    assert kept == sorted([(-1, say(a)), (-1, say(b)), (7, say(c)), (7, say(d))])
    out = M.near_dedup(frame).collect()
    assert len(out) == len(rows) and sorted(r.doc_id or -1 for r in out if r.kept) == [-1, -1, 7, 7]
    assert {(r.doc_id, r.class_id) for r in out} == {(None, None), (5, None), (9, None), (7, 7), (8, 7)}


def boilerplate():
    """600 texts, a fifth of which begin with the same 100 words and go on with ten of their own."""
    same = " ".join(f"s{i}" for i in range(100))
    return [(i, (same if i < 120 else " ".join(f"t{i}_{k}" for k in range(100))) + " " + " ".join(f"o{i}_{k}" for k in range(10))) for i in range(600)]


def test_every_shingle_is_counted_and_weighs_by_its_count(spark):
    rows = [*boilerplate(), (600, boilerplate()[599][1]), (601, "p q r s t p q r s t p q r s t")]
    weights = M.weights_of(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5))
    hashes, row, _ = M.shingles(pa.array([t for _, t in rows]))
    df = Counter(hashes.tolist())
    got = {r.node: r for r in weights.documents.collect()}
    assert sorted(got) == [i for i, _ in rows] and weights.n == len(rows)
    for i, _ in rows:
        own = hashes[row == i]
        assert (M._unpacked(bytes(got[i].dfs), len(own)) + 1).tolist() == [df[h] for h in own.tolist()]
    assert {1, 2, 120} <= set(df.values())
    rising = M.idf(np.array([1, 2, 50, 120, 175, 176, 400, 702]), 602)
    assert (np.diff(rising) < 0).all() and abs(rising[4] - 1) < 0.01


def test_a_passage_of_many_documents_does_not_make_them_near(spark):
    frame = spark.createDataFrame(boilerplate(), "doc_id bigint, text string")
    assert {(r.doc_id, r.class_id) for r in M.near_dedup(frame).collect()} == {(i, i) for i in range(600)}


def test_the_pipeline_keeps_documents_that_share_a_passage_of_many(spark):
    from corpus_pipeline import near

    frame = spark.createDataFrame(boilerplate(), "doc_id bigint, text string")
    assert near(spark, frame, "").count() == 600
