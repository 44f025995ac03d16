"""Merging of many words at once: the same as one merge after another."""

from __future__ import annotations

import random

import numpy as np
import pytest

from sensorweave.llm import merging, pieces
from sensorweave.llm.common import public_tokenizer


@pytest.mark.parametrize("seed", range(4))
def test_same_as_one_by_one(seed):
    draw = random.Random(seed)
    chosen = draw.sample([(a, b) for a in range(30) for b in range(30)], 300)
    table = {pair: (draw.randrange(40), draw.randrange(30)) for pair in chosen}  # many of equal rank
    left, right = np.array(chosen).T
    rank, made = np.array([table[p] for p in chosen]).T
    off = {(i, j, k) for i in range(200) for j in range(64) for k in range(65) if draw.random() < 0.1}
    words = [[draw.randrange(30) for _ in range(draw.choice([0, 1, 2, 3, 7, 18, 33, 64]))] for _ in range(200)]
    symbols = np.array(sum(words, []), np.int32)
    sizes = np.array([len(w) for w in words])
    skips = lambda word, place, length: np.array([t in off for t in zip(word.tolist(), place.tolist(), length.tolist())], bool)
    merging.Merges(left, right, rank, made, 30).merge(symbols, np.cumsum(sizes) - sizes, sizes, skips, words=50)
    want = []
    for i, word in enumerate(words):
        parts = [(j, 1, s) for j, s in enumerate(word)]  # place, length, symbol
        while True:
            able = [(table[x[2], y[2]][0], j) for j, (x, y) in enumerate(zip(parts, parts[1:])) if (x[2], y[2]) in table and (i, x[0], x[1] + y[1]) not in off]
            if not able:
                break
            j = min(able)[1]
            x, y = parts[j : j + 2]
            parts[j : j + 2] = [(x[0], x[1] + y[1], table[x[2], y[2]][1])]
        line = [-1] * len(word)
        for place, _, s in parts:
            line[place] = s
        want += line
    assert symbols.tolist() == want


def test_pieces_of_many_words_take_no_heap(monkeypatch):
    """F op3: words met for the first time, and drawn anew, were merged one by one, which took most of the time."""
    coder = pieces.Coder(public_tokenizer("piece_bpe_32k.model"), 0.1, seed=1)
    texts = ["international communication " * 30, "", "a▁b  ▁▁é日本 " * 5]
    want = [coder.encode(t).tolist() for t in texts]
    monkeypatch.setattr(pieces.Vocabulary, "merged", lambda *_: pytest.fail("a short word was merged alone"), raising=False)
    monkeypatch.setattr(pieces.Vocabulary, "segment", lambda *_: pytest.fail("a short word was merged alone"))
    assert [c.tolist() for c in coder.encode_all(texts)] == want
    monkeypatch.setattr(pieces, "CHARACTERS", 10)
    assert [c.tolist() for c in coder.encode_all(texts)] == want
