"""Packing: every id in exactly one piece, no gaps, neighbours on the curve."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sensorweave.llm import packing
from sensorweave.llm.common import public_tokenizer

PATH = public_tokenizer("word_bpe_49k.json")


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_is_a_walk(dims, bits):
    """All cells are visited once, and consecutive ones are neighbours."""
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    index = packing.hilbert(grid, bits)
    assert sorted(index.tolist()) == list(range(len(grid)))
    walk = grid[np.argsort(index)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_ids_are_those_of_the_whole_text():
    tokenizer = Tokenizer.from_file(PATH)
    draw = random.Random(3)
    alphabet = ["a", "É", "ß", " ", " ", "\n", "\t", "'s", "don't", "...", "1a2", "日本", "́", " ", "\x1c", " ", "<|endoftext|>", "İ", "😀"]
    texts = ["".join(draw.choices(alphabet, k=draw.randrange(0, 60))) for _ in range(400)]
    for text, got in zip(texts, packing.encode(texts, PATH, end=1)):
        assert got.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_plain_texts_are_not_taken_word_by_word(monkeypatch):
    """F op8: words met for the first time were split, looked up and joined one by one."""
    coder, tokenizer = packing.WordCoder(PATH), Tokenizer.from_file(PATH)
    texts = ["", " ", "'s's 're'x ''s don't 'll", "x" * 90 + "!" * 70, "Été 1a22 日本 ½² ’s\t😀\r\n", "It's — \"fine\"…", "a'", "'l", "'"]
    monkeypatch.setattr(packing.WordCoder, "_by_words", lambda *_: pytest.fail("word by word"), raising=False)
    monkeypatch.setattr(packing.WordCoder, "split", lambda *_: pytest.fail("word by word"))
    for size in (packing.CHARACTERS, 5):
        monkeypatch.setattr(packing, "CHARACTERS", size)
        for text, got in zip(texts, coder.encode(texts, 1)):
            assert got.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def _check(rows, texts, length):
    tokenizer = Tokenizer.from_file(PATH)
    by: dict = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for key, text in texts.items():
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(by[key], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes()) and bytes(r.ids) == ids[at : at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    spans = sorted((r.sequence_id * length + r.offset, r.length, r.offset) for r in rows)
    at = 0
    for start, size, offset in spans:  # one line without gaps, cut at the sequence length
        assert start == at and offset + size <= length
        at += size


def test_pieces(docs):
    draw = random.Random(1)
    texts = {i: " ".join(draw.choices(["sun", "moon", "Haus", "été", "x1"], k=draw.choice([0, 3, 50, 700]))) for i in range(80)}
    texts |= {100: None, 101: "", 102: "long word " * 5000}
    frame = docs(list(texts.items())).withColumns({c: F.lit(1) for c in ("row", "ids", "key", "n", "start", "curve", "at")})
    got = packing.pack(frame, PATH, length=256).collect()
    _check(got, texts, 256)
    _check(packing.pack(frame, PATH).collect(), texts, 2048)


def test_neighbours_are_alike(docs):
    """Documents of one kind end up together."""
    kinds = ["sun moon star sky night", "haus garten baum blume wiese", "un deux trois quatre cinq"]
    draw = random.Random(2)
    texts = {i: " ".join(draw.choices(kinds[i % 3].split(), k=60)) for i in range(90)}
    got = packing.pack(docs(list(texts.items())), PATH, length=256).collect()
    line = [r.doc_id % 3 for r in sorted(got, key=lambda r: (r.sequence_id, r.offset))]
    changes = sum(a != b for a, b in zip(line, line[1:]))
    assert changes < len(line) / 4


def test_repeats_null_keys_and_empty(docs):
    got = packing.pack(docs([(1, "a b"), (1, "a b"), (None, "c"), (None, None)]), PATH).collect()
    assert sum(r.length for r in got) == 3 + 3 + 2 + 1 and len(got) == 4
    assert packing.pack(docs([]), PATH).count() == 0
