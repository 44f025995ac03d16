"""Line dedup by site-relative frequency.

A line is boilerplate of a host when the share of the host's pages that contain it exceeds
`ratio` (and at least `min_pages` pages do, so that small hosts keep their text). Boilerplate
lines are dropped from the host's pages, all other lines stay in place.

Only line hashes are counted, combined before the shuffle. What returns to the pages is one row
per host with its boilerplate hashes; a host cannot have more of them than (mean distinct lines
of a page) / `ratio`. That table is written, so that its size is known: Spark broadcasts it below
its threshold, otherwise pages of large hosts are dealt out over salts.

Defined results: a NULL text stays NULL and an empty one empty; blank lines are never counted nor
dropped; a line repeated in a page counts once; a NULL host is a host of its own; repeated rows
are separate pages; an empty table gives an empty table; all columns of the input pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.skew import SALT, spread_hot_keys
from sensorweave.llm.common import cut

RATIO = 0.01
MIN_PAGES = 5


def _host(host: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit(""))


def boilerplate(pages: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """One row per host: `_host`, `_pages`, `_lines` (hashes of its boilerplate lines, maybe empty)."""
    cells = pages.select(_host(host).alias("_host"), F.split(F.col(text), "\n", -1).alias("lines"))
    totals = cells.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    hashes = F.transform(F.filter("lines", lambda x: F.trim(x) != ""), lambda x: F.xxhash64(F.trim(x)))
    seen = cells.select("_host", F.explode(F.array_distinct(hashes)).alias("line"))
    often = seen.groupBy("_host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    found = often.join(totals, "_host").where(F.col("n") > F.lit(ratio) * F.col("_pages"))
    lists = found.groupBy("_host").agg(F.collect_set("line").alias("_lines"))
    return totals.join(lists, "_host", "left")


def drop_boilerplate(
    pages: DataFrame,
    text: str = "text",
    host: str = "source",
    key: str = "doc_id",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
    counts: tuple[str, str] | None = None,
) -> DataFrame:
    """`pages` with boilerplate lines taken out of `text`.

    `counts` names two more columns, lines of the page and lines dropped; they replace columns of
    those names.
    """
    hosts = cut(boilerplate(pages, text, host, ratio, min_pages), "boilerplate")
    # the input's columns travel in a struct, so that none can clash with the helpers
    marked = pages.select(F.struct("*").alias("_row"), _host(host).alias("_host"), F.xxhash64(key, text).alias("_by"))
    marked, hosts = spread_hot_keys(marked, hosts, ["_host"], "_by", "_pages")
    joined = marked.join(hosts.drop("_pages"), ["_host", SALT], "left")
    body = F.col("_row")[text]
    lines = F.split(body, "\n", -1)
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains("_lines", F.xxhash64(F.trim(x))), F.lit(False)))
    joined = joined.select("_row", F.when(F.size(F.coalesce("_lines", F.array())) > 0, kept).otherwise(lines).alias("_kept"))
    n = F.when(body.isNull(), 0).otherwise(F.size(lines))
    dropped = F.when(body.isNull(), 0).otherwise(F.size(lines) - F.size("_kept"))
    new = F.when(dropped == 0, body).otherwise(F.array_join("_kept", "\n"))
    names = counts or ()
    columns = [(new if c == text else F.col("_row")[c]).alias(c) for c in pages.columns if c not in names]
    return joined.select(*columns, *[v.cast("int").alias(c) for c, v in zip(names, (n, dropped))])


def sql(table: str = "documents", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> str:
    """The same for DuckDB: doc_id, text, n_lines, n_dropped."""
    return f"""
WITH p AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS parts FROM {table}),
t AS (SELECT source, count(*) AS pages FROM p GROUP BY source),
l AS (SELECT r, source, unnest(parts) AS line, generate_subscripts(parts, 1) AS i FROM p),
b AS (SELECT source, trim(line, ' ') AS line, count(DISTINCT r) AS n FROM l WHERE trim(line, ' ') <> '' GROUP BY ALL),
x AS (SELECT b.source, line FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source WHERE n >= {min_pages} AND n > {ratio} * pages),
k AS (SELECT l.r, l.i, l.line, x.line IS NOT NULL AS gone FROM l LEFT JOIN x ON l.source IS NOT DISTINCT FROM x.source AND trim(l.line, ' ') = x.line),
g AS (SELECT r, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped FROM k GROUP BY r)
SELECT p.doc_id, CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(g.kept, '') END AS text,
  coalesce(n_lines, 0)::INT AS n_lines, coalesce(n_dropped, 0)::INT AS n_dropped
FROM p LEFT JOIN g USING (r)"""
