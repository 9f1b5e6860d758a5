import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm import id_files, packing
from millrace.llm.tokens import Encoder, default_tokenizer

SIGNS = ["a", "Z", "é", "é", "́", ".", ",", "...", "'s", "'", " ", "  ", "\n", "\t", "\x1c", "\x85", " ", "　", "\x01", "1", "12", "%",
         "<|endoftext|>", "<|ENDOFTEXT|>", "İ", "ß", "Σ", "漢字", "😀", "ẖ", "H̱", "x,y", "-", "\x00", "ﬁ", "word", "THE", "'re,", "don't."]
TEXTS = ["", None, " ", "\n\n", "the end.", "a,,b", "a., b", "x" * 5000, "word " * 3000]


def texts(n=400, seed=3):
    pick = random.Random(seed)
    return [*TEXTS, *("".join(pick.choices(SIGNS, k=pick.randint(0, 25))) for _ in range(n))]


def brute(ts):
    plain = Tokenizer.from_file(default_tokenizer())
    return [[*plain.encode(t or "", add_special_tokens=False).ids, 2] for t in ts]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


@pytest.mark.parametrize("by_word", [True, False])
def test_words_give_the_ids_of_whole_texts(by_word):
    ts = texts()
    ids, at = Encoder(default_tokenizer(), by_word).encode(pa.array(ts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == brute(ts)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id bigint, text string, start int, length int")


def test_pack_against_brute_force(spark):
    ts = texts(200)
    rows = [*enumerate(ts), (3, "twice"), (3, "twice"), (None, "no id"), (None, None)]
    want = sorted((i if i is not None else -1, crc(x[a:a + 64]), len(x), a) for (i, t), x in zip(rows, brute([t for _, t in rows])) for a in range(0, len(x), 64))
    out = packing.pack(frame(spark, rows), places=64).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.ids_crc32, r.doc_tokens, r.start) for r in out) == want
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(by) == list(range(len(by)))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(frame(spark, [])).count() == 0


def test_patterns_hold_the_histogram():
    pick = random.Random(1)
    for _ in range(30):
        want = {pick.randint(1, 100): pick.randint(1, 1000) for _ in range(pick.randint(0, 60))}
        patterns = packing.shortest_pack_first(want, 100)
        got = {}
        for packs, parts in patterns:
            assert sum(n * t for n, t in parts) <= 100
            for n, t in parts:
                got[n] = got.get(n, 0) + packs * t
        assert got == want
        assert len(patterns) <= 2 * len(want)


def test_elias_fano():
    pick = np.random.default_rng(0)
    for n, most in ((1, 0), (1, 9), (2, 1), (500, 3), (500, 10**6), (3000, 5000)):
        values = np.sort(pick.integers(0, most + 1, n))
        ef = id_files.EliasFano.of(values)
        assert ef.all().tolist() == values.tolist() == [ef[i] for i in range(n)]
        for a, b in pick.integers(0, n + 1, (30, 2)).tolist():
            assert ef.stretch(a, b).tolist() == values[a:b].tolist()
    values = np.cumsum(pick.integers(1, 2000, 100_000))
    ef = id_files.EliasFano.of(values)
    assert 8 * sum(x.nbytes for x in (ef.low, ef.high, ef.samples)) < 14 * len(values)


@pytest.mark.parametrize("block_ids", [1, 50, 1 << 20])
def test_id_files_round_trip(spark, block_ids):
    rows = [*((7 * i % 409, t) for i, t in enumerate(texts(300))), (3, "twice"), (3, "twice"), (None, "no id")]
    out = id_files.write_and_read(frame(spark, rows), block_ids=block_ids).collect()
    want = sorted((i if i is not None else -1, len(x), crc(x)) for (i, t), x in zip(rows, brute([t for _, t in rows])))
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.ids_crc32) for r in out) == want
    at = 0
    for r in sorted(out, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id if r.doc_id is not None else -1 for r in sorted(out, key=lambda r: r.start)]
    assert ids == sorted(ids)
    assert id_files.write_and_read(frame(spark, [])).count() == 0


@pytest.mark.parametrize("block_ids", [1, 50, 1 << 20])
def test_look_up_of_documents(spark, tmp_path, block_ids, monkeypatch):
    """Documents asked for by id come with the ids and the start that a read of everything gives."""
    monkeypatch.setattr(id_files, "RUN", 7)
    rows = [*((3 * i, t) for i, t in enumerate(texts(60))), (9, "twice"), (9, "twice"), (None, "no id"), (None, "nor here")]
    path = id_files.write(frame(spark, rows), str(tmp_path / "ids"), block_ids=block_ids)
    starts = {}
    for r in id_files.read(spark, path).collect():
        starts.setdefault(r.doc_id, set()).add((r.start, r.n_tokens, r.ids_crc32))
    asked = [0, 9, 10, 33, 3 * 59, -5, 10**12]
    got = id_files.look_up(spark, path, asked).collect()
    assert len(got) == sum(len(starts[i]) for i in asked if i in starts)
    assert all((r.start, len(r.ids), crc(r.ids)) in starts[r.doc_id] for r in got)
    assert id_files.look_up(spark, path, []).count() == 0 and id_files.look_up(spark, path, [10]).count() == 0
