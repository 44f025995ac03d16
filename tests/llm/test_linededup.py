"""Line dedup against its SQL and on edge cases."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from sensorweave.llm import linededup


def _rows():
    rows = []
    for i in range(40):
        host = ["a", "b", None][i % 3]
        lines = [f"own line {i}", "menu of all"] + (["often"] if i % 2 else []) + (["rare"] if i == 3 else [])
        if i % 5 == 0:
            lines += ["", "  menu of all  ", "own twice", "own twice"]
        rows.append((i, "\n".join(lines), "en", host))
    return [*rows, (100, None, "en", "a"), (101, "", "en", "b"), (None, "menu of all", "en", "b"), (7, rows[7][1], "en", rows[7][3])]


@pytest.mark.parametrize("split", ["4000000", "3"])
def test_against_sql(corpus, docs, split):
    corpus.conf.set("spark.sensorweave.splitRows", split)
    try:
        frame = docs(_rows())
        got = linededup.drop_boilerplate(frame, ratio=0.3, min_pages=3, counts=("n_lines", "n_dropped")).toPandas()
    finally:
        corpus.conf.unset("spark.sensorweave.splitRows")
    con = duckdb.connect()
    con.register("documents", frame.toPandas())
    want = con.execute(linededup.sql(ratio=0.3, min_pages=3)).df()
    key = lambda f: sorted((str(r.doc_id), r.text, r.n_lines, r.n_dropped) for r in f.fillna({"doc_id": -1}).astype({"doc_id": int}).itertuples())
    assert str(key(got)) == str(key(want)) and got.n_dropped.sum() > 40


def test_ratio_is_of_the_host(docs):
    rows = [(i, f"x{i}\nshared", "en", "big") for i in range(100)] + [(200 + i, f"y{i}\nhalf", "en", "big") for i in range(2)]
    rows += [(300 + i, "half\nz", "en", "small") for i in range(4)]
    got = {r.doc_id: r.text for r in linededup.drop_boilerplate(docs(rows), ratio=0.5, min_pages=3).collect()}
    assert got[0] == "x0" and got[200] == "y0\nhalf" and got[300] == ""


def test_clashing_names_and_empty(docs):
    clash = {c: F.lit(1) for c in ("_host", "_salt", "_lines", "_kept", "_row", "_pages", "line", "n", "lines")}
    frame = docs([(i, f"m\n{i}", "en", "h") for i in range(9)]).withColumns(clash)
    got = linededup.drop_boilerplate(frame)
    assert got.columns == frame.columns and sorted(r.text for r in got.collect()) == [str(i) for i in range(9)]
    assert linededup.drop_boilerplate(docs([])).count() == 0
    assert linededup.drop_boilerplate(docs([(1, None, "en", None)])).first().text is None
