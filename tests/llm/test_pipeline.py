"""The pipeline's stages on a small corpus, and the registered queries."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from sensorweave.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"
NAMES = [f"op{n}_" for n in range(1, 14)]


def test_registered():
    names = list(driver.queries())
    assert [sum(n.startswith(p) for n in names) for p in NAMES] == [1] * 13 and "pipeline" in names
    assert set(SQL) <= set(QUERIES) and set(driver.oracle_sql()) <= set(names)


def test_stages_follow_each_other(corpus):
    docs = corpus.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, [r.asDict() for r in docs.collect()]
    toxic_junk = {r.doc_id for r in corpus.read.parquet(f"{SMALL}/labels.parquet").where("quality = 0").collect()}
    clean = {r.doc_id for r in corpus.read.parquet(f"{SMALL}/labels.parquet").where("quality = 1").collect()}
    sizes = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = stage(corpus, docs, SMALL)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
            docs = corpus.createDataFrame(docs.collect(), docs.schema)
            after = {r.doc_id for r in docs.collect()}
            assert after <= before
            sizes.append(len(after))
            if i == 0:
                assert not after & toxic_junk and clean <= after
            if i == 1:
                assert len(clean - after) <= 1
            if i == 2:
                assert after == before
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == after and sizes[0] < len(rows) and sizes[3] < sizes[2]
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "", "en", "s", 0), (2, None, None, None, None), (2, "a b c", "en", "s", 5)]])
def test_stages_on_odd_tables(corpus, tmp_path, rows):
    docs = corpus.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    corpus.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES:
        stage(corpus, docs, str(tmp_path)).collect()


def test_near_duplicates_by_row_not_by_id(corpus):
    """Repeated ids, identical rows, NULL ids, texts without words: one row of each group stays, and no
    other row goes."""
    words = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
    long = " ".join(f"{w}{i}" for i in range(3) for w in words)
    near, other = long + " more", " ".join(f"{w}x{i}" for i in range(3) for w in words)
    rows = [(5, long), (3, near), (3, other), (5, long), (None, long), (8, None), (8, ""), (9, other), (9, other), (None, "short text")]
    docs = corpus.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicate_stage(corpus, docs, SMALL).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(3, near), (3, other), (8, None), (8, ""), (None, "short text")], key=str)


def test_pipeline_on_odd_rows(corpus):
    """What the stages do with NULL and empty texts and with clashing names."""
    rows = [(1, "", "en", "s", 0, 7), (2, None, None, None, None, 7), (2, "a b c d e f", "en", "s", 5, 7), (None, "a b c d e f", "en", "s", 5, 7)]
    docs = corpus.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rank long")
    lines = corpus_pipeline.line_stage(corpus, docs, SMALL)
    assert lines.columns == docs.columns and lines.count() == 4
    kept = corpus_pipeline.near_duplicate_stage(corpus, docs, SMALL)
    assert sorted(((r.doc_id, r.text, r.rank) for r in kept.collect()), key=str) == sorted([(1, "", 7), (2, None, 7), (2, "a b c d e f", 7)], key=str)
    pieces = corpus_pipeline.packing_stage(corpus, docs, SMALL).collect()
    assert sorted((r.doc_id or 0, r.length) for r in pieces if r.length == 1) == [(1, 1), (2, 1)]
