"""Piece encoding: the library's ids without dropout, exact round trips with it."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorweave.llm import pieces
from sensorweave.llm.common import public_tokenizer

PATH = public_tokenizer("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    return pieces.Coder(PATH)


@pytest.fixture(scope="module")
def dropped():
    return pieces.Coder(PATH, dropout=0.3, seed=9)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdefgh theTHE éü\n\t€日😀0123"), st.characters(codec="utf-8")), max_size=60))
def test_same_as_library_and_lossless(plain, dropped, text):
    if pieces.MARK not in text and text:
        library = sentencepiece.SentencePieceProcessor(model_file=PATH)
        assert plain.encode(text).tolist() == library.encode(text)
    assert plain.decode(plain.encode(text)) == text
    assert dropped.decode(dropped.encode(text)) == text


def test_literal_marks(dropped):
    for text in ("▁", "a▁b", "▁▁ x ▁", " ▁"):
        assert dropped.decode(dropped.encode(text)) == text


def test_seeds_vary_and_repeat():
    text = "international communication " * 40
    a, b, c = (pieces.Coder(PATH, 0.3, seed=s).encode(text) for s in (1, 1, 2))
    assert np.array_equal(a, b) and not np.array_equal(a, c)
    assert len(a) > len(pieces.Coder(PATH).encode(text))
    words = {tuple(w) for w in np.split(a, np.flatnonzero(a == a[0]))}
    assert len(words) > 1  # occurrences of a word differ
    letters = pieces.Coder(PATH, 1.0).encode("hello")
    assert len(letters) == 6  # every merge skipped: the mark and five letters


def test_every_occurrence_is_drawn():
    """Occurrences of one word are segmented as often in each way as free draws would; texts differ."""
    coder, n, draw = pieces.Coder(PATH, 0.1, seed=3), 10_000, np.random.default_rng(8)
    ids = coder.encode("international " * n)[:-1]  # without the last mark
    first = [i for p, i in coder.vocabulary.ids.items() if p.startswith(pieces.MARK)]
    got = Counter(tuple(w) for w in np.split(ids, np.flatnonzero(np.isin(ids, first))[1:]))
    spans = coder.vocabulary.spans("▁international")
    want = Counter()
    for _ in range(n):
        off = {s for s in spans if draw.random() < 0.1}
        want[tuple(coder.vocabulary.segment("▁international", off.__contains__))] += 1
    assert sum(got.values()) == n and len(got) > 20
    assert sum(abs(got[k] - want[k]) for k in got | want) / n < 0.1
    assert len({tuple(coder.encode(f"{i} international")[-9:]) for i in range(200)}) > 20


def test_memory_does_not_draw(monkeypatch):
    """Remembered words and words encoded alone give the same ids."""
    texts = ["international communication of words " * 30, "a▁b international▁international", "x" * 70 + " the"]
    want = [pieces.Coder(PATH, 0.2, seed=5).encode(t).tolist() for t in texts]
    monkeypatch.setattr(pieces, "LONGEST", 0)
    assert [pieces.Coder(PATH, 0.2, seed=5).encode(t).tolist() for t in texts] == want
    monkeypatch.setattr(pieces, "LONGEST", 64)
    monkeypatch.setattr(pieces, "REMEMBERED", 2)
    assert [pieces.Coder(PATH, 0.2, seed=5).encode(t).tolist() for t in texts] == want


def test_frames(corpus, docs):
    rows = [(1, "the cat"), (1, "the cat"), (2, None), (3, ""), (None, "x" * 5000), (4, "é " * 20000)]
    frame = docs(rows).withColumn("decoded", F.lit(7)).withColumn("pieces", F.lit("p"))
    coded = pieces.encode(frame, PATH, dropout=0.2, seed=4)
    assert coded.columns == frame.columns
    back = pieces.decode(coded, PATH).collect()
    assert all(r.decoded == r.text for r in back) and len(back) == 6
    got = pieces.round_trip(frame, PATH).collect()
    assert all(r.lossless for r in got) and len({r.pieces_crc32 for r in got if r.doc_id == 1}) == 1
    assert pieces.encode(docs([]), PATH).count() == 0 and pieces.round_trip(docs([]), PATH).count() == 0
