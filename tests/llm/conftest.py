from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

from sensorweave.llm.common import prepare  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs(corpus):
    """docs([(id, text[, lang[, source]]), ...]) -> frame with the columns of `documents`."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return corpus.createDataFrame(full, DOCS)

    return build
