"""Run queries next to their SQL and compare: `python -m contract.compare [folder] [name ...] [key=value ...]`."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

from contract import QUERIES, SQL
from sensorweave.session import local_session


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return round(float(value), 9) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return str(value)


def _sorted_rows(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def _close(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) <= 1e-7 + 1e-12 * abs(a)  # results are rounded to 1e-6: another digit is another value
    return a == b


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def difference(spark, con, folder: str, name: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    got = [tuple(_plain(v) for v in row) for row in df.select(*[f"`{c}`" for c in columns]).collect()]
    if name not in SQL:
        return None
    result = con.execute(SQL[name])
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} vs {sorted(names)}"
    order = [names.index(c) for c in columns]
    want = [tuple(_plain(row[i]) for i in order) for row in result.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    got, want = _sorted_rows(got), _sorted_rows(want)
    wrong = [(a, b) for a, b in zip(got, want) if not all(map(_close, a, b))]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ; columns {columns}; first {wrong[0]}"
    return None if got else "no rows"


def main(argv: list[str]) -> int:
    settings = [a for a in argv if "=" in a]
    argv = [a for a in argv if "=" not in a]
    folder = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark, con = local_session(8), connect(folder)
    for pair in settings:
        spark.conf.set(*pair.split("=", 1))
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(spark, con, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        kind = "O" if name in SQL else "R"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
