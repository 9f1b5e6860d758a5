"""All stages of the pipeline on rows that are easily mishandled."""

import pytest

import corpus_pipeline

STAGE = dict(corpus_pipeline.STAGES)
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, tie bigint, node bigint, copies bigint, n int, copy int, size int, `_tie` int, "
          "`_n` int, `_copies` int, row string, id int, sha string, kept boolean, `a.b` int")
EXTRA = (None,) * 13 + (7,)
LABELS = "doc_id bigint, quality int, toxic int"


def written(spark, folder, rows, labels):
    for name, data, schema in (("documents", rows, SCHEMA), ("labels", labels, LABELS)):
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def row(doc_id, text, source="a"):
    return (doc_id, text, "en", source, None, *EXTRA)


def prose(seed, n=40):
    return " ".join(f"w{(seed * 37 + k * (3 + seed % 5)) % 211}" for k in range(n))


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    rows = [row(i, prose(i), "ab"[i % 2]) for i in range(20)]
    rows += [row(1, None), row(1, ""), row(1, ""), row(None, None), row(None, prose(90)), row(None, prose(91)), row(None, prose(91)), row(50, prose(3)),
             row(51, prose(4) + " more"), row(52, "x " * 60_000, None), row(53, "long" * 50_000), row(54, prose(92), None), row(54, prose(92), None)]
    return written(spark, folder, rows, [(i, 1, 0) for i in range(20)] + [(None, 1, 1), (3, None, None)]), folder


def kept(df):
    return sorted(((r["doc_id"], r["text"] or "") for r in df.collect()), key=str)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_and_empty_table(spark, table, name):
    docs, folder = table
    assert STAGE[name](spark, docs.limit(0), folder).collect() == []
    out = STAGE[name](spark, docs, folder)
    assert out.columns == docs.columns and {r["a.b"] for r in out.collect()} == {7}


def test_exact(spark, table):
    docs, folder = table
    texts, order = {}, lambda i: -1 if i is None else i
    for i, text in kept(docs):
        texts[text] = max(texts.get(text, i), i, key=order)
    assert kept(STAGE["exact dedup"](spark, docs, folder)) == sorted(((i, t) for t, i in texts.items()), key=str)


def test_near(spark, table):
    docs, folder = table
    out = kept(STAGE["near dedup"](spark, docs, folder))
    assert len({t for _, t in out}) == len(out) and (None, prose(90)) in out and (None, prose(91)) in out
    assert (51, prose(4) + " more") not in out and (50, prose(3)) not in out and len([t for _, t in out if not t]) == 1


def test_mix(spark, table):
    docs, folder = table
    out = kept(STAGE["mix sources"](spark, docs, folder))
    size = lambda rows: sum(len(t.split()) for _, t in rows)
    assert set(out) <= set(kept(docs)) and size(out) == pytest.approx(1.5 * size(kept(docs)), rel=0.7)


def test_pack(spark, table):
    docs, folder = table
    assert STAGE["pack"](spark, docs.limit(0), folder).count() == 0
    by_doc = {}
    for r in STAGE["pack"](spark, docs, folder).collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    assert by_doc.keys() == {r.doc_id for r in docs.collect()}
    assert sum(r.length for r in by_doc[52]) == by_doc[52][0].doc_tokens


def test_run_on_no_rows(spark, tmp_path):
    written(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
