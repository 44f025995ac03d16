"""Time structure of a deployment: steps between timestamps, gaps, jitter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions.ordered import (
    CHUNK,
    CHUNKING,
    UPTO,
    across_chunks,
    attach_edges,
    chunk_window,
    with_chunks,
    with_neighbour,
)
from sensorweave.functions.quantiles import exact_quantiles
from sensorweave.functions.timeline import US, micros
from sensorweave.schema import require

DEPLOYMENT = ("deployment_id",)
SERIES = ("deployment_id", "variable")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (micros(later) - micros(earlier)) / US


def time_steps(
    df: DataFrame,
    keys: Sequence[str] = DEPLOYMENT,
    ts: str = "ts_utc",
    expected_s: float = catalog.EXPECTED_S,
    gap_factor: float = catalog.GAP_FACTOR,
) -> DataFrame:
    """Distinct timestamps with the step since the one before (NULL at first) and the gap flag.

    Copies of a timestamp are dropped before the shuffle; chunks and their edges come from
    the rows, so that the distinct runs once.
    """
    require(df, ts)
    rows = with_chunks(df.select(*keys, ts), keys, ts)
    points = attach_edges(rows.distinct(), previous_time_edges(rows, keys, ts), keys)
    us = micros(ts)
    before = F.coalesce(F.lag(us).over(chunk_window(keys, [ts])), F.col("_before_us"))
    return points.select(*keys, ts, ((us - before) / US).alias("delta_s")).withColumn(
        "is_gap", F.coalesce(F.col("delta_s") > expected_s * gap_factor, F.lit(False))
    )


def previous_time_edges(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Per (deployment, chunk): the last timestamp before the chunk's first one, in microseconds.

    A chunk may begin inside a timestamp. Each gives its last timestamp before the one that the next
    begins with; where it holds no other, an earlier chunk has it.
    """
    us, earlier = micros(ts), across_chunks(keys).rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(F.col(UPTO).isNull() | (us < F.col(UPTO)), us))
    return (
        df.groupBy(*keys, CHUNK)
        .agg(last.alias("_last_us"))
        .select(*keys, CHUNK, F.max("_last_us").over(earlier).alias("_before_us"))
    )


def add_time_flags(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    expected_s: float,
    gap_factor: float,
    small_factor: float,
) -> DataFrame:
    """`delta_s`, `is_gap`, `is_small_delta` for rows that carry `_chunk` and `_before_us`.

    The range frame ends one microsecond before the row, so all rows of one timestamp see
    the same earlier timestamp: no distinct, no join back.
    """
    us = micros(ts)
    earlier = (
        Window.partitionBy(*keys, CHUNK).orderBy(us).rangeBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.max(us).over(earlier), F.col("_before_us"))
    delta = F.col("delta_s")
    small = (delta > 0) & (delta < expected_s * small_factor)
    return (
        df.withColumn("delta_s", (us - before) / US)
        .withColumn("is_gap", F.coalesce(delta > expected_s * gap_factor, F.lit(False)))
        .withColumn("is_small_delta", F.coalesce(small, F.lit(False)))
    )


def with_time_flags(
    df: DataFrame,
    keys: Sequence[str] = DEPLOYMENT,
    ts: str = "ts_utc",
    expected_s: float = catalog.EXPECTED_S,
    gap_factor: float = catalog.GAP_FACTOR,
    small_factor: float = catalog.SMALL_DELTA_FACTOR,
) -> DataFrame:
    """Rows with the step since the previous distinct timestamp of the deployment and its flags."""
    rows = with_chunks(df, keys, ts)
    rows = attach_edges(rows, previous_time_edges(rows, keys, ts), keys)
    flagged = add_time_flags(rows, keys, ts, expected_s, gap_factor, small_factor)
    return flagged.drop(*CHUNKING, "_before_us")


def step_summary(
    steps: DataFrame,
    keys: Sequence[str] = DEPLOYMENT,
    expected_s: float = catalog.EXPECTED_S,
    gap_factor: float = catalog.GAP_FACTOR,
) -> DataFrame:
    """Per deployment: step statistics and gap count; all NULL/0 when there is no step."""
    basic = steps.groupBy(*keys).agg(
        F.count("delta_s").alias("count"),
        F.min("delta_s").alias("min"),
        F.max("delta_s").alias("max"),
        F.avg("delta_s").alias("mean"),
        F.stddev_samp("delta_s").alias("std"),
        F.count_if("is_gap").alias("num_gaps"),
    )
    quartiles = exact_quantiles(steps, keys, "delta_s", {"p25": 0.25, "p75": 0.75})
    return (
        basic.join(quartiles, list(keys), "left")
        .withColumn("expected_sec", F.lit(float(expected_s)))
        .withColumn("gap_threshold", F.lit(float(expected_s * gap_factor)))
    )


def small_steps(
    steps: DataFrame,
    expected_s: float = catalog.EXPECTED_S,
    small_factor: float = catalog.SMALL_DELTA_FACTOR,
) -> DataFrame:
    return steps.where((F.col("delta_s") > 0) & (F.col("delta_s") < expected_s * small_factor))


def rows_around_short_steps(
    df: DataFrame, keys: Sequence[str] = DEPLOYMENT, ts: str = "ts_utc", limit_s: float = catalog.EXPECTED_S
) -> DataFrame:
    """Rows at a timestamp reached by a short step, and the row just before such a row."""
    rows = with_chunks(df, keys, ts)
    rows = attach_edges(rows, previous_time_edges(rows, keys, ts), keys)
    rows = add_time_flags(rows, keys, ts, limit_s, 1.0, 1.0)
    rows = rows.withColumn("_short", F.coalesce(F.col("delta_s") < limit_s, F.lit(False)))
    rows = with_neighbour(rows, keys, ["_short"], [ts, "reading_id"], "_after", ahead=True)
    hit = F.col("_short") | F.coalesce(F.col("_after._short"), F.lit(False))
    return rows.where(hit).select(*df.columns, "delta_s")


def row_steps(
    df: DataFrame,
    keys: Sequence[str] = SERIES,
    ts: str = "ts_utc",
    order: Sequence[str] = ("ts_utc", "reading_id"),
) -> DataFrame:
    """Step since the previous *row* of the series (copies give 0), NULL at first."""
    rows = with_neighbour(with_chunks(df, keys, ts), keys, [ts], order, "_before")
    step = seconds_between(F.col(ts), F.col(f"_before.{ts}"))
    return rows.withColumn("delta_s", step).drop("_before", *CHUNKING)


def row_gaps(df: DataFrame, limit_s: float = catalog.EXPECTED_S, **kwargs) -> DataFrame:
    return row_steps(df, **kwargs).where(F.col("delta_s") > limit_s)


DESCRIBE_STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def describe_steps(steps: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The eight describe() numbers of the steps, one row per (deployment, statistic)."""
    basic = steps.groupBy(*keys).agg(
        F.count("delta_s").cast("double").alias("count"),
        F.avg("delta_s").alias("mean"),
        F.stddev_samp("delta_s").alias("std"),
        F.min("delta_s").alias("min"),
        F.max("delta_s").alias("max"),
    )
    quartiles = exact_quantiles(steps, keys, "delta_s", {"25%": 0.25, "50%": 0.5, "75%": 0.75})
    wide = basic.join(quartiles, list(keys), "left")
    return wide.unpivot(list(keys), [f"`{s}`" for s in DESCRIBE_STATS], "stat", name)


def compare_steps(before: DataFrame, after: DataFrame, keys: Sequence[str] = DEPLOYMENT) -> DataFrame:
    """Step statistics of two step tables side by side."""
    left, right = describe_steps(before, keys, "before"), describe_steps(after, keys, "after")
    return left.join(right, [*keys, "stat"], "left")
