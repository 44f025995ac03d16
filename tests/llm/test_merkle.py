"""Fingerprints: edits located, edited texts as defined, order across partitions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorweave.llm import merkle


def brute(rows):
    """doc_id -> (n_chars, sha256 of the edited text) with unique ids."""
    line = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (key, text) in enumerate(line):
        text, after = text or "", line[(i + 1) % len(line)][1] or ""
        n = len(text)
        out[key] = (n, hashlib.sha256((text[: n - n // 3] + after[: n // 3]).encode()).hexdigest())
    return out


def _rows(n, seed=1):
    draw = random.Random(seed)
    words = [f"w{i}é" for i in range(500)]
    return [(i * 7 % 1009, "\n".join(" ".join(draw.choices(words, k=12)) for _ in range(draw.randrange(0, 9)))) for i in range(n)]


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_against_brute_force(docs, partitions):
    rows = _rows(60)
    got = merkle.fingerprints(docs(rows), partitions=partitions).collect()
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == brute(rows)
    texts = dict(rows)
    assert all(r.fingerprint == merkle.tree(texts[r.doc_id])[0] for r in got)
    for r in got:
        a, b = merkle.leaves(r.fingerprint), merkle.leaves(r.edited_fingerprint)
        assert r.near_edited == pytest.approx(merkle.likeness(a, b, r.fingerprint == r.edited_fingerprint))
    long = [r for r in got if r.n_chars > 300]
    assert np.mean([r.near_edited for r in long]) > 0.3 > 0.05 > np.mean([r.near_next for r in long])


def test_alone_null_empty_repeats_ties(docs):
    one = merkle.fingerprints(docs([(1, "abcdef")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one.near_next == 1.0
    rows = [(5, "same text"), (5, "same text"), (4, None), (3, ""), (None, "last"), (2, "x" * 200000)]
    got = merkle.fingerprints(docs(rows).withColumns({c: F.lit(1) for c in ("key", "part", "seam", "after", "top")}), partitions=3).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and by[4].n_chars == by[3].n_chars == 0 and by[4].fingerprint == by[3].fingerprint
    assert by[3].near_edited == 1.0 and len({r.fingerprint for r in got if r.doc_id == 5}) == 1
    assert merkle.fingerprints(docs([])).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n.é", max_size=80), st.text(alphabet="ab \n.é", max_size=80))
def test_equal_roots_mean_equal_texts(a, b):
    assert (merkle.tree(a)[0] == merkle.tree(b)[0]) == (a == b)
    assert (merkle.changed(merkle.tree(a)[0], merkle.tree(b)[0]) == []) or a != b


def test_edit_is_located():
    draw = random.Random(4)
    lines = [" ".join(f"w{draw.randrange(9999)}" for _ in range(15)) for _ in range(40)]
    before = merkle.tree("\n".join(lines))[0]
    paragraphs = [p for s in before.split(":", 1)[1].split("/") for p in s.split("=")[1].split(".")]
    lines[23] = lines[23].replace("w", "v", 1)
    after = merkle.tree("\n".join(lines))[0]
    found = merkle.changed(before, after)
    assert len(found) == 1
    flat = [(i, j) for i, s in enumerate(before.split(":", 1)[1].split("/")) for j in range(len(s.split("=")[1].split(".")))]
    assert flat.index(found[0]) == 23 and len(paragraphs) == 40
