"""PPM and unigram scores against a plain implementation."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorweave.llm import ppm

_FOLD = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


class Trie:
    """Byte contexts with counts, escape method C, and exclusion, one symbol at a time."""

    def __init__(self, texts, order, keep=lambda context, total: True):
        self.order = order
        self.seen = [defaultdict(Counter) for _ in range(order + 1)]
        for t in texts:
            line = self.line(t)
            for i in range(order, len(line)):
                for j in range(order + 1):
                    self.seen[j][tuple(line[i - j : i])][line[i]] += 1
        for level in self.seen:
            for context in [c for c, n in level.items() if not keep(c, sum(n.values()))]:
                del level[context]

    def line(self, text):
        return [ppm.START] * self.order + list((text or "").encode()) + [ppm.END]

    def score(self, text):
        line, total = self.line(text), 0.0
        for i in range(self.order, len(line)):
            left_out: set = set()
            for j in range(self.order, -1, -1):
                counts = self.seen[j].get(tuple(line[i - j : i]))
                if not counts:
                    continue
                fresh = {s: n for s, n in counts.items() if s not in left_out}
                if not fresh:
                    continue
                weight = sum(fresh.values()) + len(fresh)
                if line[i] in fresh:
                    total += math.log10(fresh[line[i]] / weight)
                    break
                total += math.log10(len(fresh) / weight)
                left_out |= set(counts)
            else:
                total -= math.log10(ppm.SYMBOLS - len(left_out))
        return total


def base(texts, train):
    split = lambda t: re.findall("[^\x20\x09-\x0d]+", (t or "").translate(_FOLD)) + [" "]
    seen = Counter(w for t in train for w in split(t))
    n, v = sum(seen.values()), len(seen)
    return [(len(split(t)), sum(seen[w] > 0 for w in split(t)), n, sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in split(t))) for t in texts]


TEXTS = ["the cat sat", "The cat ran away", "a dog and a cat", "été où là", "", None, "the the the", "zzz qqq", "x" * 300, "the cat sat", "sat\non\tthe mat"]


@pytest.fixture(scope="module")
def frame(docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    return docs([*rows, (0, TEXTS[0]), (None, "the cat")])


@pytest.mark.parametrize(("order", "frequent"), [(3, 100), (5, 1), (0, 100)])
def test_against_plain(frame, order, frequent):
    train = [t for i, t in enumerate(TEXTS) if i % 3 != 1] + [TEXTS[0]]
    got = ppm.score(frame, train="doc_id % 3 <> 1", order=order, frequent=frequent).collect()
    trie = Trie(train, order)
    assert len(got) == len(TEXTS) + 2
    for row in got:
        text = TEXTS[row.doc_id] if row.doc_id is not None else "the cat"
        n, known, total, value = base([text], train)[0]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n, known, total)
        assert row.base_score == pytest.approx(value, abs=1e-9)
        assert row.score == pytest.approx(trie.score(text), abs=1e-9)


def test_bounded_trie(docs):
    """With a small bound, contexts below the count threshold are unknown, at every order alike."""
    texts = ["abcabcabd", "abcabcabe", "xyz", "abcxyz"]
    frame = docs(list(enumerate(texts)))
    counts = ppm.count(frame, "text", 3)
    model = ppm.fit(counts, order=3, entries=8)
    sizes = [len(level[0]) for level in model.levels]
    assert max(sizes) <= 8 and min(sizes[1:]) < 8
    least = [int(level[4].min()) if len(level[4]) else 1 << 62 for level in model.levels]
    kept = [set(level[3].tolist()) for level in model.levels]

    def code(context):
        value = 0
        for s in context:
            value = value * ppm.RADIX + s
        return value

    trie = Trie(texts, 3, keep=lambda c, n: code(c) in kept[len(c)])
    want = [trie.score(t) for t in [*texts, "new"]]
    assert np.allclose(model.score([*texts, "new"]), want) and least[0] >= 1


@pytest.mark.parametrize("entries", [0, 4, 20, 60])
def test_scores_of_the_whole_trie(frame, entries):
    """What a worker does not hold is looked up: the bound does not change a score."""
    train = [t for i, t in enumerate(TEXTS) if i % 3 != 1] + [TEXTS[0]]
    got = ppm.score(frame, train="doc_id % 3 <> 1", order=3, entries=entries).collect()
    trie = Trie(train, 3)
    assert len(got) == len(TEXTS) + 2
    for row in got:
        text = TEXTS[row.doc_id] if row.doc_id is not None else "the cat"
        assert row.score == pytest.approx(trie.score(text), abs=1e-9)


def test_threshold_of_large_counts(corpus):
    """The most frequent are kept, however often all were seen."""
    sizes = corpus.createDataFrame([(10**12, 4), (3 * 10**6, 3), (200_000, 3), (150_000, 5), (7, 2), (1, 9)], "n long, entries long")
    assert [ppm._threshold(sizes, most) for most in (3, 4, 9, 10, 15, 17, 25, 26)] == [1 << 62, 10**12, 3 * 10**6, 200_000, 150_000, 7, 7, 1]


def test_probabilities_sum_to_one(docs):
    model = ppm.fit(ppm.count(docs([(1, "abracadabra"), (2, "abrab")]), "text", 2), order=2)
    for context in [(ppm.START, ppm.START), (97, 98), (98, 114), (120, 97), (120, 121)]:
        codes = np.array([(context[0] * ppm.RADIX + context[1]) * ppm.RADIX + s for s in range(ppm.SYMBOLS)])
        assert (10 ** model.logs(codes)).sum() == pytest.approx(1.0)


def test_empty_and_untrained(docs):
    assert ppm.score(docs([])).count() == 0
    row = ppm.score(docs([(1, "ab")]), train="false").first()
    assert row.train_tokens == 0 and row.n_known == 0 and row.base_score == 0.0
    assert row.score == pytest.approx(-3 * math.log10(ppm.SYMBOLS))


def test_clashing_names(docs):
    frame = docs([(1, "a b"), (2, "b")]).withColumns({c: F.lit(1) for c in ("h1", "h2", "key", "word", "n", "score", "tf", "code")})
    assert ppm.score(frame, order=2).count() == 2


def test_windows_do_not_matter(docs, monkeypatch):
    """Long texts are read in windows; counts and scores are those of one piece."""
    texts = ["abracadabra " * 40, "", None, "x", "abra é" * 9]
    frame = docs(list(enumerate(texts)))
    whole = ppm.fit(ppm.count(frame, "text", 3), order=3)
    want = whole.score(texts)
    monkeypatch.setattr(ppm, "CHUNK", 7)
    seen = Counter()
    for code, _ in ppm.grams(texts, 3):
        seen.update(code.tolist())
    assert np.allclose(whole.score(texts), want)
    assert dict(zip(whole.levels[3][0].tolist(), whole.levels[3][1].astype(int).tolist())) == dict(seen)
