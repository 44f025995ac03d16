"""Ordered work on series of any length.

`lag`, fills and rolling frames need the rows of one series in order, but one series may
hold a third of all rows, so a window over the whole series is not an option. Every
series is cut into time chunks, and a chunk with too many rows by count, between any two rows:
windows run inside (series, chunk), and what must cross a chunk edge travels through a small table with one row per (series, chunk), joined back
on (series, chunk). Rows are shuffled once, on (series, chunk), and the join, the windows
and any narrower window (say by variable) share that shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.functions.timeline import US, floor_us, micros
from sensorweave.settings import setting

CHUNK = "_chunk"
UPTO = "_upto"
CHUNKING = (CHUNK, UPTO)
BLOCK = "_block"
CORE = "_core"
SAMPLED = 16  # rows that are sampled for a piece, about


def with_chunks(df: DataFrame, keys: Sequence[str], ts: str = "ts_utc", seconds: str = "chunkSeconds") -> DataFrame:
    """Add `_chunk`, which grows with (`ts`, `reading_id`) inside `keys`, and `_upto`.

    A chunk is as wide as the setting `seconds` says. One that holds more than `splitRows` rows is cut by count into
    pieces of about that many rows, also inside a single timestamp: its rows are sampled by a hash,
    and every so manieth sampled (`ts`, `reading_id`) begins a piece. Without a `reading_id` rows of one
    time stay together. `_upto` is the time (epoch us) at which the next piece of the chunk begins,
    NULL in its last piece; the pieces of a chunk are numbered from its start, so `_chunk` is unique.

    The list of such chunks and of their pieces is broadcast: it has (row count / `splitRows`)
    entries by construction, e.g. half a million for 2e12 rows. Rows of other chunks are read once
    for the counts; sampling is skipped by AQE where no chunk is too large.
    """
    width, split_rows = setting(df, seconds) * US, setting(df, "splitRows")
    df = df.withColumn(CHUNK, floor_us(micros(ts), width))
    place = [micros(ts).alias("us")] + ([F.col("reading_id").alias("id")] if "reading_id" in df.columns else [])
    counts = df.groupBy(*keys, CHUNK).agg(F.count(F.lit(1)).alias("_rows"))
    hot = counts.where(F.col("_rows") > split_rows).select(F.struct(*keys, CHUNK).alias("_in"), "_rows")
    drawn = F.pmod(F.xxhash64(*[p.cast("string") for p in place]), F.lit(max(1, split_rows // SAMPLED))) == 0
    sampled = df.select(F.struct(*keys, CHUNK).alias("_in"), F.struct(*place).alias("_at")).where(drawn)
    sampled = sampled.join(F.broadcast(hot), sampled["_in"].eqNullSafe(hot["_in"])).select(hot["_in"], "_rows", "_at")
    begins = sampled.groupBy("_in", "_rows").agg(F.sort_array(F.collect_list("_at")).alias("_sample"))
    every = f"greatest(1, CAST(round(size(_sample) * {split_rows}D / _rows) AS INT))"
    begins = begins.selectExpr("_in AS _hot", f"array_distinct(filter(_sample, (s, i) -> i > 0 AND i % {every} = 0)) AS _begins")
    piece = "coalesce(size(filter(_begins, b -> b <= _at)), 0)"  # -1 for NULL, hence the next line
    rows = df.withColumn("_at", F.struct(*place)).join(F.broadcast(begins), F.struct(*keys, CHUNK).eqNullSafe(F.col("_hot")), "left")
    rows = rows.withColumn("_piece", F.when(F.col("_begins").isNull(), 0).otherwise(F.expr(piece)))
    return rows.withColumns({UPTO: F.expr("get(_begins, _piece).us"), CHUNK: F.col(CHUNK) + F.col("_piece")}).drop("_at", "_hot", "_begins", "_piece")


def attach_edges(df: DataFrame, edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join the one-row-per-(series, chunk) table to the rows.

    Hash join: rows keep the shuffle on (series, chunk) that the windows need and are not
    sorted for the join; each task's share of the edge table is small.
    """
    return df.join(edges.hint("shuffle_hash"), [*keys, CHUNK], "left")


def chunk_window(keys: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*keys, CHUNK).orderBy(*order)


def across_chunks(keys: Sequence[str]):
    """Window over the edge table: one row per chunk of a series."""
    return Window.partitionBy(*keys).orderBy(CHUNK)


def with_neighbour(
    df: DataFrame,
    keys: Sequence[str],
    payload: Sequence[str],
    order: Sequence[str],
    name: str,
    ahead: bool = False,
) -> DataFrame:
    """Add struct `name`: `payload` of the row just before (or after) in the series.

    Needs `_chunk`. NULL for the first (last) row of the series.
    """
    fields = F.struct(*payload)
    pick = F.min_by if ahead else F.max_by
    step = F.lead if ahead else F.lag
    if list(payload) == list(order) and len(order) == 1:
        edge = F.struct((F.min if ahead else F.max)(order[0]).alias(order[0]))  # plain hash aggregate
    else:
        edge = pick(fields, F.struct(*order))
    edges = (
        df.groupBy(*keys, CHUNK)
        .agg(edge.alias("_edge"))
        .select(*keys, CHUNK, step("_edge").over(across_chunks(keys)).alias("_carry"))
    )
    near = step(fields).over(chunk_window(keys, order))
    return attach_edges(df, edges, keys).withColumn(name, F.coalesce(near, "_carry")).drop("_carry")


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "_pos") -> DataFrame:
    """Add the 0-based position of each row in its series. Needs `_chunk`."""
    before = across_chunks(keys).rowsBetween(Window.unboundedPreceding, -1)
    edges = (
        df.groupBy(*keys, CHUNK)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, CHUNK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    rank = F.row_number().over(chunk_window(keys, order))
    return attach_edges(df, edges, keys).withColumn(name, F.col("_offset") + rank - 1).drop("_offset")


def with_blocks(df: DataFrame, pos: Column, back: int = 0, ahead: int = 0) -> DataFrame:
    """Cut a series into blocks of `blockRows` positions, each with copies of its neighbours' edges.

    A row goes to its own block (`_core` true) and, as a copy, to every later block of which a
    row may look back to it and every earlier one of which a row may look ahead to it. Frames
    reaching at most `back`/`ahead` positions are then exact inside (series, `_block`), also
    where they span several blocks; keep only `_core` rows afterwards.
    """
    size = setting(df, "blockRows")
    home = F.floor(pos / size)
    targets = F.sequence(F.floor((pos - ahead) / size), F.floor((pos + back) / size))
    df = df.withColumn("_home", home).withColumn(BLOCK, F.explode(targets))
    return df.withColumn(CORE, F.col(BLOCK) == F.col("_home")).drop("_home")


def core_rows(df: DataFrame) -> DataFrame:
    return df.where(CORE).drop(CORE, BLOCK)


def full_frame(fn, value: Column, frame, rows: int) -> Column:
    """`fn` over the frame, NULL unless the frame holds `rows` non-NULL values."""
    return F.when(F.count(value).over(frame) == rows, fn(value).over(frame))
