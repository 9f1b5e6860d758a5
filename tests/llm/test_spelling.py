import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import spelling as S

SCHEMA = "doc_id bigint, text string, run string, n bigint, path string"


def near_words(words):
    """word -> its words one edit away, by neighbours that differ in one letter."""
    return {a: [b for b in words if S.one_edit(a.encode("latin-1"), b.encode("latin-1"))] for a in words}


def brute(docs):
    count = {}
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] = count.get(run, 0) + 1
    count = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    near, form = near_words(count), {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= 10 * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return sorted(out)


def run(spark, docs, **options):
    rows = S.spelling_variants(spark.createDataFrame([(i, t, "x", 3, "y") for i, t in docs], SCHEMA), **options).collect()
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows)


def made(seed=3):
    pick = random.Random(seed)
    base = ["".join(pick.choice("aabcdeéÿ") for _ in range(pick.randint(7, 10))) for _ in range(40)]
    words = list(base)
    for w in base:
        for _ in range(6):
            at, other = pick.randrange(len(w)), pick.choice("abxéß")
            words.append(pick.choice([w[:at] + w[at + 1:], w[:at] + other + w[at:], w[:at] + other + w[at + 1:]]))
    docs = []
    for i in range(60):
        some = [pick.choice(base[:5]) for _ in range(60)] + [pick.choice(words) for _ in range(60)]
        docs.append((i, " ".join(w.upper() if pick.random() < 0.05 else w for w in some)))
    return docs


@pytest.mark.parametrize("options", [{}, {"node": 20, "slice_": 30}])
def test_against_brute_force(spark, options):
    docs = [*made(), (None, "nulldoc nulldoc nulldoc"), (7, None), (8, ""), (9, "short a b"), (9, "twiceid twiceid"), (9, "twiceid twiceid"),
            (10, "Grüße×÷ Grüße×÷ GRÜßE×÷"), (11, ("aaaaaaaa " * 50 + "aaaaaaab ") * 2)]
    assert run(spark, docs, **options) == brute(docs)


def test_very_long_words(spark):
    long = "abcdefgh" * 900
    docs = [(1, f"{long} {long} {long}x {long}x x{long} {long[:-1]} {long[:-1]}"), (2, f"x{long} {'z' * 300} {'z' * 300} {'z' * 301} {'z' * 301}")]
    assert run(spark, docs) == brute(docs) == run(spark, docs, node=2, slice_=2)


def test_chains_of_forms(spark):
    docs = [(1, "abcdefgh " * 2 + "abcdefgi " * 25 + "abcdefii " * 300 + "abcdeiii " * 4000)]
    got = run(spark, docs)
    assert got == brute(docs) and {r[2] for r in got if r[0] == "abcdefgh"} == {"abcdeiii"}


def test_none(spark):
    assert run(spark, []) == [] and run(spark, [(1, None), (2, ""), (3, "no words")]) == []


def test_one_edit():
    pick = random.Random(5)
    for _ in range(3000):
        a = "".join(pick.choice("ab") for _ in range(pick.randint(0, 6)))
        b = "".join(pick.choice("ab") for _ in range(pick.randint(0, 6)))
        edits = {a[:i] + a[i + 1:] for i in range(len(a))} | {a[:i] + c + a[i:] for i in range(len(a) + 1) for c in "ab"}
        edits |= {a[:i] + c + a[i + 1:] for i in range(len(a)) for c in "ab"}
        assert S.one_edit(a.encode(), b.encode()) == (b in edits and a != b)


def test_vectorised_verification():
    pick = random.Random(6)
    words = sorted({"".join(pick.choice("abc") for _ in range(pick.choice([7, 8, 9, 60]))) for _ in range(300)})
    words += [w[:3] + "d" + w[3:] for w in words[::3]] + [w[:-1] for w in words[::4]]
    cells = [w.encode() for w in words]
    own = S.Words(np.frombuffer(b"".join(cells), np.uint8), np.concatenate([[0], np.cumsum([len(c) for c in cells])]))
    i, j = np.divmod(np.arange(len(cells) ** 2), len(cells))
    assert S.near(own, i, own, j).tolist() == [S.one_edit(cells[a], cells[b]) for a, b in zip(i, j)]
