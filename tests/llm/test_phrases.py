"""Phrase mining against a plain count and against SQL."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorweave.llm import phrases
from sensorweave.llm.queries import op13_phrases


def plain(rows, least, longest=5, top=2000, percent=100):
    """Everything by dictionaries."""
    counts: dict = {}
    words: Counter = Counter()
    for text, lang in rows:
        f = counts.setdefault(lang or "und", Counter())
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            words[lang or "und"] += len(w)
            for k in range(1, longest + 1):
                f.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = words[lang], []
        often = {p: a for p, a in f.items() if a >= least}
        for p, a in often.items():
            if len(p) < 2:
                continue
            wider = [q for q in often if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) and 100 * often[q] >= percent * a]
            if wider:
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -score))
    return sorted(out)


def texts(seed: int, n: int):
    draw = random.Random(seed)
    units = ["New York", "new york city", "a", "b", "c", "der", "Über", "ÜBER", "x.y", "\x0b", ",", "!?", "\t", "co\x85op", "日本", "\r\n", "a a a", " ", "ß-ü"]
    return [(" ".join(draw.choices(units, k=draw.randrange(0, 40))), draw.choice(["en", "de", "en", None, "und"])) for _ in range(n)]


@pytest.mark.parametrize("chunk", [60, 2_000_000])
@pytest.mark.parametrize("percent", [100, 90])
def test_against_plain_count(docs, corpus, monkeypatch, chunk, percent):
    """Chunks of few documents and of many, counted in many slices and in one: no size changes a thing."""
    monkeypatch.setattr(phrases, "CHUNK", chunk)
    monkeypatch.setattr(phrases, "HELD", 3 * chunk)
    monkeypatch.setattr(phrases, "SLICE", 700 if chunk < 1000 else phrases.SLICE)
    rows = [*texts(1, 250), (None, "en"), ("", "de"), ("same same", "en"), ("same same", "en")]
    table = docs([(i % 50, t, lang) for i, (t, lang) in enumerate(rows)]).withColumns({c: F.lit("clash") for c in ("chunk", "word", "n", "phrase")})
    got = phrases.collocations(table, least=4, percent=percent)
    assert sorted(map(tuple, got.collect())) == plain(rows, 4, percent=percent)


def test_top_and_ties(docs, corpus):
    rows = [("b c! a d! é z! Z y", "en")] * 3
    table = docs([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    assert [r.phrase for r in phrases.collocations(table, least=3, top=3).orderBy("rank").collect()] == ["a d", "b c", "z y"]
    assert sorted(map(tuple, phrases.collocations(table, least=3, top=3).collect())) == plain(rows, 3, top=3)


def test_one_long_piece(docs, corpus):
    rows = [("ab cd " * 60_000, "en"), ("x" * 300_000 + " y", "en")]
    got = phrases.collocations(docs([(1, *rows[0]), (2, *rows[1])]), least=100)
    assert sorted(map(tuple, got.collect())) == plain(rows, 100)


def test_large_counts_stay_exact(corpus):
    """Products beyond 64 bits, and a score that only exact division gives."""
    n, a, left, right = 9 * 10**17 + 7, 10**15 + 3, 10**16 + 9, 10**16 + 61
    row = corpus.sql(f"SELECT (1000 * CAST({a} AS decimal(19,0)) * CAST({n} AS decimal(19,0))) div (CAST({left} AS decimal(19,0)) * CAST({right} AS decimal(19,0))) AS s").first()
    assert row.s == 1000 * a * n // (left * right)


def test_packing():
    columns = [np.array([0, 1, 5, 1 << 40]), np.array([3, 0, -2, 1 << 33]), np.array([7, -8, 9, 0])]
    for got, want in zip(phrases._unpacked(phrases._packed(*columns)), columns, strict=True):
        assert got.tolist() == want.tolist()
    assert [c.tolist() for c in phrases._unpacked(phrases._packed(np.zeros(0, np.int64), np.zeros(0, np.int64)))] == [[], []]


def test_nothing_frequent_and_empty(docs, corpus):
    assert phrases.collocations(docs([(1, "a b c", "en")])).collect() == []
    assert phrases.collocations(docs([])).collect() == []


def test_query_against_sql(docs, corpus, tmp_path):
    rows = texts(5, 900)
    docs([(i, t, lang) for i, (t, lang) in enumerate(rows)]).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(phrases.sql()).fetchall()
    got = sorted(map(tuple, op13_phrases(corpus, str(tmp_path)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))
    assert got == sorted(want) == plain(rows, 100) and len(got) > 10
