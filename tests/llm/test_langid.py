"""Language by compression: unseen texts, tiny texts, rejection, edge cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sensorweave.llm import langid

WORDS = {
    "en": "the and of that with from this which there would about people because through little house water where",
    "de": "der und nicht mit auch eine über werden zwischen haben diese wasser häuser können schön straße welche",
    "fr": "les des une dans pour pas sur avec être cette leurs maison fenêtre où garçon après plusieurs quelque",
}


def _text(lang, seed, n):
    words = WORDS[lang].split()
    return " ".join(words[(seed * 7 + i * i + 3 * i) % len(words)] for i in range(n))


@pytest.fixture(scope="module")
def content(docs):
    return langid.fit(docs([(100 * k + i, _text(lang, i, 60), lang) for k, lang in enumerate(WORDS) for i in range(30)]))


def test_unseen_and_tiny_texts(docs, content):
    rows = [(10 * i + j, _text(lang, 50 + j, n), lang) for i, lang in enumerate(WORDS) for j, n in enumerate((2, 4, 40, 3000))]
    got = langid.predict(docs(rows), content, keep=("doc_id", "lang")).collect()
    assert [r.lang_pred for r in got] == [r.lang for r in got]
    assert all(0 <= r.score <= 1 for r in got)


def test_whole_text_counts(docs, content):
    """A short English head does not decide a long German text."""
    text = _text("en", 1, 80) + " " + _text("de", 2, 3000)
    assert langid.predict(docs([(1, text)]), content).first().lang_pred == "de"


def test_nulls_letters_repeats(docs, content):
    rows = [(1, None), (2, ""), (3, "12 345 !!"), (None, "und nicht über"), (5, "_ _"), (6, "the"), (6, "the")]
    got = langid.predict(docs(rows), content).collect()
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert len(got) == 7 and by[1] == by[2] == by[3] == by[5] == ("und", 0.0) and by[None][0] == "de"


def test_accept(docs, content):
    rows = docs([(1, _text("en", 3, 50)), (2, "123"), (3, _text("fr", 3, 50))]).withColumn("lang_pred", F.lit(1)).withColumn("_text", F.lit(None))
    kept = langid.accept(rows, content, margin=0.01)
    assert kept.columns == rows.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]
    assert langid.accept(rows, content, margin=0.999).count() == 0


def test_empty_and_unlabelled(docs):
    assert langid.fit(docs([])) == {}
    assert langid.fit(docs([(1, None, "en"), (2, "a", None)])) == {}
    assert langid.predict(docs([(1, "abc")]), {}).first().lang_pred == "und"
    assert langid.predict(docs([]), {"en": b"abc"}).count() == 0


def test_single_language_and_bound(docs):
    content = langid.fit(docs([(i, _text("en", i, 5000), "en") for i in range(6)]), sample_per_language=3, dictionary_bytes=3000)
    assert set(content) == {"en"} and len(content["en"]) <= 3000
    row = langid.predict(docs([(1, "the")]), content).first()
    assert row.lang_pred == "en" and row.score == 1.0


@pytest.mark.parametrize(("text", "letter"), [("½", False), ("² Ⅷ 12", False), ("☃", False), ("", False), (None, False), ("ª", True), ("日", True), ("1a", True)])
def test_letters_are_those_of_unicode(text, letter):
    assert langid.has_letter(text) == letter
