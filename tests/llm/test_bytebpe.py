"""Byte-level BPE: ids of the library, whole texts back, linear work."""

from __future__ import annotations

import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from sensorweave.llm import bytebpe
from sensorweave.llm.common import public_tokenizer
from sensorweave.llm.queries import op12_bytes

NAMES = ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"]


@pytest.fixture(scope="module", params=NAMES)
def both(request):
    path = public_tokenizer(request.param)
    ranks = bytebpe.read_ranks(path)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return bytebpe.coder(path, public_tokenizers.PATTERN), library


def flat(coder, text):
    return [i for part in coder.encode(text) for i in part]


def samples() -> list[str]:
    draw = random.Random(12)
    alphabet = list("abcdeinorst  ") + ["the", " and", "ing", "é", "ß", "日本", "😀", "\n", "\n\n", "\t", "'s", "'LL", "'ll", "123", "...", "\x00", "\x1c", " ", "　", "́", "<|endoftext|>", "²", "Ⅷ", "​", "�"]
    return ["".join(draw.choices(alphabet, k=draw.randrange(0, 90))) for _ in range(1500)]


def test_ids_are_those_of_the_library(both):
    own, library = both
    for text in samples():
        ids = flat(own, text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_every_character_is_split_like_the_library(both):
    own, library = both
    for start in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}b {chr(c)}1 {chr(c)}{chr(c)} x" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert flat(own, text) == library.encode_ordinary(text)


def test_single_pieces_by_definition(both):
    """Backtracking against merging the lowest rank first, with no memory of pieces."""
    own, _ = both
    draw = random.Random(3)
    for _ in range(800):
        raw = bytes(draw.choices(b"abehinrst\x00\xc3\xa9\xff", k=draw.randrange(1, 24)))
        assert own.backtracked(raw.decode("latin-1")) == own.merged(raw)


def test_longest_match_and_shorter_tokens(both):
    own, _ = both
    draw = random.Random(4)
    for _ in range(500):
        raw = bytes(draw.choices(b" abcdehinorstu", k=20))
        want = next(own.whole[raw[:n]] for n in range(20, 0, -1) if raw[:n] in own.whole)
        assert own.match(raw.decode("latin-1"), 0) == want


@pytest.mark.parametrize("unit", ["a", "ab", " ", "=", "wörld", "7"])
def test_one_long_piece(both, unit):
    own, library = both
    text = unit * 20_000
    assert flat(own, text) == library.encode_ordinary(text)


def test_work_is_linear(both):
    own, _ = both
    draw = random.Random(8)
    word = "".join(draw.choices("abcdefghij", k=400_000))

    def took(n):
        start = time.process_time()
        flat(own, word[:n])
        return time.process_time() - start

    took(50_000)
    assert took(400_000) < 40 * max(took(50_000), 0.02)


def test_rows(docs, corpus):
    path = public_tokenizer(NAMES[0])
    table = docs([(1, None), (2, ""), (3, "Straße 12\n"), (3, "Straße 12\n"), (None, " x"), (4, "ein Wort " * 40_000)])
    table = table.withColumns({"ids": F.lit(1), "n_tokens": F.lit("clash"), "_text": F.lit("clash")})
    ids = bytebpe.encode(table, path, public_tokenizers.PATTERN)
    back = bytebpe.decode(ids, path, public_tokenizers.PATTERN)
    assert sorted((r.doc_id or 0, bytes(r.text)) for r in back.collect()) == sorted((r.doc_id or 0, (r.text or "").encode()) for r in table.collect())
    assert bytebpe.round_trip(docs([]), path, public_tokenizers.PATTERN).collect() == []


def test_query_against_library(corpus, docs, tmp_path):
    rows = [(i, t) for i, t in enumerate(samples()[:300])] + [(900, None), (901, ""), (901, "")]
    docs(rows).write.parquet(str(tmp_path / "documents.parquet"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.read_ranks(public_tokenizer(NAMES[0])), special_tokens={})
    want = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = op12_bytes(corpus, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_round_trips_are_remembered(both, monkeypatch):
    """Ids, decimals and bytes of a piece are made once, also where memory turns over or a text is read in parts."""
    own, library = both
    texts = samples()[:200]

    def want(text):
        ids = library.encode_ordinary(text)
        return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    assert [own.round_trip(t) for t in texts] == [want(t) for t in texts]
    with monkeypatch.context() as m:
        m.setattr(own, "made", None)
        assert [own.round_trip(t) for t in texts] == [want(t) for t in texts]
    monkeypatch.setattr(bytebpe, "REMEMBERED", 3)
    monkeypatch.setattr(bytebpe, "AT_ONCE", 10)
    monkeypatch.setattr(bytebpe, "PIECES", 4)
    assert [own.round_trip(t) for t in [*texts, None, ""]] == [want(t or "") for t in [*texts, None, ""]]
