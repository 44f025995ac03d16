"""Embedding links against brute force; recall of the traversal."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorweave.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.98):
    links = {i: 0 for i, _, _ in rows}
    up = {i: i for i in links}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    good = [(i, np.array(v, np.float32).astype(float), label) for i, v, label in rows if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for a in range(len(good)):
        for b in range(a):
            (i, x, k), (j, y, m) = good[a], good[b]
            if k == m and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                links[i] += 1
                links[j] += 1
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    return {i: (links[i], find(i)) for i in links}


def make(n=400, dims=16, seed=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, dims))
    rows = []
    for i in range(n):
        c = centres[i % 12] if i % 3 else draw.normal(size=dims)
        v = (c + draw.normal(size=dims) * draw.choice([0.0, 0.05, 0.1, 0.14, 0.2]) * np.linalg.norm(c) / np.sqrt(dims)) * draw.choice([1, 10])
        rows.append((int(draw.integers(0, 1 << 40)), [float(np.float32(x)) for x in v], int(i % 2)))
    return rows


@pytest.mark.parametrize(("block", "words"), [(2048, None), (16, 3), (7, 1), (32, 12)])
def test_against_brute_force(corpus, block, words):
    rows = make()
    got = vectors.near_vectors(corpus.createDataFrame(rows, SCHEMA), recall=1.0, block=block, words=words).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_of_the_calibrated_reach(corpus):
    rows = make(1200, 32, seed=3)
    want = brute(rows)
    got = {r.vec_id: r for r in vectors.near_vectors(corpus.createDataFrame(rows, SCHEMA), recall=0.999, words=8).collect()}
    found, total = sum(got[i].n_links for i in want), sum(n for n, _ in want.values())
    assert total > 1000 and found / total > 0.99 and all(got[i].n_links <= n for i, (n, _) in want.items())


def test_vectors_near_few_dimensions(corpus):
    """Neighbours that differ along the directions that part the code words are all linked by default."""
    draw = np.random.default_rng(11)
    n, dims = 6000, 64
    x = (draw.normal(size=(n, 4)) @ draw.normal(size=(4, dims))).astype(np.float32)
    unit = vectors.unit(x.astype(float))
    want = np.concatenate([(unit[i : i + 1000] @ unit.T >= 0.98).sum(axis=1) - 1 for i in range(0, n, 1000)])
    frame = corpus.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], SCHEMA)
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(frame, words=9).collect()}
    assert want.sum() > 10_000 and [got[i] for i in range(n)] == want.tolist()


def test_traversal_is_complete():
    """With the full radius every vector within it lies in a visited cell."""
    draw = np.random.default_rng(5)
    x = vectors.unit(draw.normal(size=(500, 12)))
    near = vectors.unit(x + draw.normal(size=x.shape) * 0.03)
    book = vectors.Codebook(x, 9, 0.04, 1.0)
    close = ((x - near) ** 2).sum(axis=1) <= 0.04
    seen = set(zip(*(a.tolist() for a in book.visits(x))))
    assert close.sum() > 300 and all((i, c) in seen for i, c in enumerate(book.cells(near).tolist()) if close[i])
    rows, cells = book.visits(x)
    assert len(set(zip(rows.tolist(), cells.tolist()))) == len(rows)  # a cell is visited once


def test_edges(corpus):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1),
        (8, [inf, 1.0], 1), (9, [1.0, None], 1), (10, [], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1e-30, 0.0], 1), (13, [1e30, 1e28], 1), (14, [-1.0, 0.0], 1),
    ]
    frame = corpus.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "size", "digest", "cell", "n", "low", "query", "copies")})
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(frame).collect()}
    want = {i: (0, i) for i, _, _ in rows} | {i: (3, 1) for i in (1, 2, 12, 13)}
    assert got == want
    assert vectors.near_vectors(corpus.createDataFrame([], SCHEMA)).count() == 0


def test_equal_vectors_and_null_ids(corpus):
    rows = [(i, [1.0, 2.0], 0) for i in range(50)] + [(None, [1.0, 2.0], 0), (7, [1.0, 2.0], 0), (100, [2.0, -1.0], 0)]
    got = vectors.near_vectors(corpus.createDataFrame(rows, SCHEMA), block=8).collect()
    assert len(got) == 53 and {(r.n_links, r.component_id) for r in got if r.vec_id is not None and r.vec_id < 50} == {(50, 0)}
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
