"""Near duplicates and components against brute force."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorweave.llm import neardup
from sensorweave.llm.components import components

_FOLD = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def shingle_set(text, n):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(_FOLD))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, n, percent=80):
    """id -> (set size, component)."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = find(a), find(b)
            up[max(p, q)] = min(p, q)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def corpus_rows(seed=5, families=12):
    """Families of near copies with similarities all around the threshold, exact copies, and shared passages."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = draw.choices(words, k=40)
    rows, at = [], 0
    for _ in range(families):
        base = draw.choices(words, k=draw.choice([8, 30, 120, 400]))
        for _ in range(draw.choice([1, 3, 8])):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, len(base) // 40, len(base) // 20])):
                text[draw.randrange(len(text))] = draw.choice(words)
            if draw.random() < 0.3:
                text += passage
            rows.append((at, (" " if draw.random() < 0.5 else "  \n").join(text)))
            at += 1
    rows += [(at, ""), (at + 1, None), (at + 2, "one"), (at + 3, "ONE"), (at + 4, "two words"), (at + 5, "words two"), (at + 6, " \t ")]
    return rows


@pytest.mark.parametrize("words", [4, 5])
def test_against_brute_force(docs, words):
    rows = corpus_rows()
    got = {r.doc_id: r for r in neardup.near_duplicates(docs(rows), words=words).collect()}
    want = brute(rows, words)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == r.doc_id) for r in got.values())
    assert sum(not r.kept for r in got.values()) > 10


def test_chain_of_near_copies(docs):
    """Neighbours are alike, the ends are not: one component through many steps."""
    draw = random.Random(1)
    text = [f"t{i}" for i in range(200)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(text)))
        text[draw.randrange(200)] = f"n{i}"
        text[draw.randrange(200)] = f"m{i}"
    want = brute(rows, 4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs(rows), words=4).collect()}
    assert got == want and len({c for _, c in want.values()}) < 5


def test_edges(docs):
    long = " ".join(f"x{i % 977}y{i}" for i in range(30000))
    rows = [(1, long), (2, long + " z"), (None, long), (4, "a b c"), (4, "a b c"), (9, "A b C")]
    frame = docs(rows).withColumn("digest", F.lit(1)).withColumn("id", F.lit(2)).withColumn("component", F.lit("x"))
    got = [(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(frame, words=4).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, True), (2, 1, False), (None, None, True), (4, 4, True), (4, 4, True), (9, 4, False)], key=str)
    assert neardup.near_duplicates(docs([])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 2 * neardup.CHUNKS - 1))
def test_pigeonhole_guarantee(seed, distance):
    """Signatures within the guaranteed distance share a key."""
    draw = np.random.default_rng(seed)
    a = draw.integers(0, 1 << 16, neardup.SYMBOLS).astype(np.uint16)
    b = a.copy()
    at = draw.choice(neardup.SYMBOLS, distance, replace=False)
    b[at] ^= draw.integers(1, 1 << 16, distance).astype(np.uint16)
    x, y = neardup.keys(a, 1)[0], neardup.keys(b, 1)[0]
    assert (x == y).any()


def test_signature_distance_follows_similarity():
    draw = np.random.default_rng(3)
    x = np.unique(draw.integers(0, 1 << 63, 4000, dtype=np.uint64))
    share = 0.8  # similarity s of sets of size n with k in common: k = 2 n s / (1 + s)
    k = int(2 * 1500 * share / (1 + share))
    far = [
        (neardup.signature(draw.permutation(x)[:1500]) != neardup.signature(draw.permutation(x)[:1500])).mean() for _ in range(3)
    ]
    near = []
    for _ in range(20):
        p = draw.permutation(x)
        near.append((neardup.signature(p[:1500]) != neardup.signature(np.r_[p[:k], p[1500 : 3000 - k]])).mean())
    assert abs(np.mean(near) - 0.2) < 0.03 and max(near) * neardup.SYMBOLS < neardup.FAR and min(far) > 0.5


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, links):
    up = {i: i for i in range(31)}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert got == {i: find(i) for i in up if find(i) != i}
