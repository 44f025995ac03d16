"""Quality classifier: coordinate descent against a plain solver, held-out rows, edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorweave.llm import quality

GOOD = ["the cat sat on the mat and looked at the moon", "a small boat went down the river in the rain", "we walked home and talked about the old days"]
BAD = ["BUY!!! NOW!!! CHEAP!!! PILLS!!!", "spam spam spam spam spam spam", "CLICK$$$ here$$$ WIN$$$ cash$$$"]


def _rows(n):
    rows = [(2 * i, f"{GOOD[i % 3]} {i}") for i in range(n)] + [(2 * i + 1, f"{BAD[i % 3]} {i}") for i in range(n)]
    return rows, [(k, 1 - k % 2, 0) for k, _ in rows]


@pytest.fixture(scope="module")
def model(corpus, docs):
    rows, labels = _rows(30)
    return quality.fit(docs(rows), corpus.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_unseen_texts(docs, model):
    unseen = docs([(1, "the old man went home in the rain"), (2, "WIN!!! WIN!!! NOW!!!"), (3, "cash cash cash cash cash")])
    got = {r.doc_id: r for r in quality.score(unseen, model).collect()}
    assert got[1].predicted == 1 and got[2].predicted == 0 and got[3].predicted == 0
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_null_empty_long_repeated_rows(docs, model):
    long = " ".join(GOOD) * 3000
    got = quality.score(docs([(None, None), (1, ""), (2, long), (2, long), (3, " \n\t")]), model).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == 5 and by[None] == by[1] == by[3] == model.score(np.empty(0, np.int32))
    assert len({r.score for r in got if r.doc_id == 2}) == 1 and by[2] > 0.5


def test_accept_keeps_columns_and_clashing_names(docs, model):
    rows = docs([(1, GOOD[0]), (2, BAD[0])]).withColumn("_text", F.lit("x")).withColumn("score", F.lit(3)).withColumn("label", F.lit(None))
    kept = quality.accept(rows, model)
    assert kept.columns == rows.columns and [r.doc_id for r in kept.collect()] == [1]


def test_empty_tables_and_one_class(corpus, docs):
    none = corpus.createDataFrame([], "doc_id long, quality int")
    assert quality.score(docs([]), quality.fit(docs([]), none)).count() == 0
    assert quality.score(docs([(1, "a")]), quality.fit(docs([(1, "a")]), none)).first().score == 0.5
    one = corpus.createDataFrame([(1, 1), (2, None), (None, 0), (3, 7)], "doc_id long, quality int")
    assert quality.score(docs([(1, "a")]), quality.fit(docs([(1, "a"), (2, "b"), (None, "c"), (3, "d")]), one)).first().score > 0.99


def test_sample_bound_and_repeatability(corpus, docs):
    rows, labels = _rows(30)
    marks = corpus.createDataFrame(labels, "doc_id long, quality int, toxic int")
    a = quality.fit(docs(rows), marks, sample_per_class=5)
    b = quality.fit(docs(rows[::-1]).repartition(7), marks.repartition(3), sample_per_class=5)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_log_count_ratios_take_all_rows(corpus, docs):
    """The ratio of a feature is that of document frequencies over all labelled rows."""
    rows, labels = _rows(20)
    marks = corpus.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = quality.fit(docs(rows), marks, sample_per_class=3)
    found = [set(quality.features(t).tolist()) for _, t in rows]
    y = [v for _, v, _ in labels]
    some = sorted(found[0])[0]
    n = [sum(some in f for f, v in zip(found, y) if v == c) for c in (0, 1)]
    want = np.log((n[1] + 1) / (20 + 2)) - np.log((n[0] + 1) / (20 + 2))
    assert np.sign(model.weights[some]) * np.sign(want) >= 0 or model.weights[some] == 0


def test_coordinate_descent_solves_the_dual():
    """The duality gap of the hinge-loss problem closes."""
    draw = np.random.default_rng(0)
    rows = [np.unique(draw.integers(0, 30, 6)).astype(np.int32) for _ in range(40)]
    ratio = draw.normal(size=30)
    sign = np.where(draw.random(40) < 0.5, -1.0, 1.0)
    weights, bias = quality.descend(rows, sign, ratio, c=0.7, epochs=2000, seed=1)
    x = np.zeros((40, 31))
    for i, r in enumerate(rows):
        x[i, r] = ratio[r]
        x[i, 30] = 1
    w = np.append(weights, bias)
    margin = sign * (x @ w)
    primal = 0.5 * w @ w + 0.7 * np.maximum(0, 1 - margin).sum()
    # a point on the path of a plain subgradient method cannot be better by much
    v = np.zeros(31)
    for t in range(1, 20001):
        bad = sign * (x @ v) < 1
        v -= (v - 0.7 * (sign[bad, None] * x[bad]).sum(axis=0)) / t
    other = 0.5 * v @ v + 0.7 * np.maximum(0, 1 - sign * (x @ v)).sum()
    assert primal <= other * 1.001
