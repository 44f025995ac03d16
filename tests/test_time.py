"""Duplicates, time steps, slots."""

from __future__ import annotations

import pytest
from fixtures import at
from pyspark.sql import functions as F

from sensorweave.functions.ordered import with_chunks, with_position
from sensorweave.operators import dedupe, grid, quality, temporal

KEY = ("deployment_id", "ts_utc", "variable")


def _dups(readings):
    return readings([
        ("01 00:00:00", "speed", 1.0),
        ("01 00:00:00", "speed", 2.0),
        ("01 00:00:00", "speed", 3.0),
        ("01 00:00:00", "skin_temp", 9.0),
        ("01 00:15:00", "speed", 4.0),
    ])


def test_keep_last_and_first(readings):
    last = {(r.ts_utc, r.variable): r.value for r in dedupe.keep_one(_dups(readings), KEY).collect()}
    first = {(r.ts_utc, r.variable): r.value for r in dedupe.keep_one(_dups(readings), KEY, keep="first").collect()}
    assert last == {(at("01 00:00:00"), "speed"): 3.0, (at("01 00:00:00"), "skin_temp"): 9.0, (at("01 00:15:00"), "speed"): 4.0}
    assert first[(at("01 00:00:00"), "speed")] == 1.0


def test_keep_one_keeps_columns(readings):
    df = _dups(readings)
    assert dedupe.keep_one(df, KEY).columns == df.columns


def test_duplicate_report(readings):
    row = dedupe.duplicate_report(_dups(readings), KEY).first()
    assert (row.total_rows, row.distinct_keys, row.rows_in_groups, row.rows_removed) == (5, 3, 3, 2)


def test_duplicate_rows_of_a_hot_key(spark, sizes):
    """One key holds most rows; every copy must be listed once, also when it is salted."""
    df = spark.range(100).select(
        F.col("id").alias("reading_id"), F.when(F.col("id") < 80, 0).otherwise(F.col("id")).alias("key")
    )
    found = dedupe.duplicate_rows(df, ("key",)).collect()
    assert sorted(r.reading_id for r in found) == list(range(80))


def test_rounding_ties_go_to_even(readings):
    rows = [("01 00:07:30", "speed", 0.0), ("01 00:22:30", "speed", 0.0), ("01 00:37:30", "speed", 0.0)]
    slots = grid.with_rounded_slot(readings(rows)).orderBy("reading_id").collect()
    assert [r.ts_slot for r in slots] == [at("01 00:00:00"), at("01 00:30:00"), at("01 00:30:00")]


def test_rounding_before_the_epoch(spark):
    df = spark.sql("SELECT timestamp_micros(-450000000) AS ts_utc UNION ALL SELECT timestamp_micros(-460000000)")
    slots = grid.with_rounded_slot(df).select(F.unix_micros("ts_slot").alias("s")).collect()
    assert sorted(r.s for r in slots) == [-900_000_000, 0]


def test_jitter_tolerance_is_inclusive(readings):
    rows = [("01 00:01:00", "speed", 0.0), ("01 00:01:01", "speed", 0.0), ("01 00:14:00", "speed", 0.0)]
    kept = grid.assign_slots(readings(rows)).collect()
    assert sorted(r.reading_id for r in kept) == [0, 2]


def test_steps_use_distinct_times(readings, sizes):
    df = readings([
        ("01 00:00:00", "speed", 1.0),
        ("01 00:00:00", "skin_temp", 1.0),
        ("01 00:15:00", "speed", 1.0),
        ("01 00:20:00", "speed", 1.0),
        ("02 08:00:00", "speed", 1.0),
    ])
    steps = temporal.time_steps(df).orderBy("ts_utc").collect()
    assert [r.delta_s for r in steps] == [None, 900.0, 300.0, 114_000.0]
    assert [r.is_gap for r in steps] == [False, False, False, True]
    flags = temporal.with_time_flags(df).orderBy("reading_id").collect()
    assert [r.delta_s for r in flags] == [None, None, 900.0, 300.0, 114_000.0]
    assert [r.is_small_delta for r in flags] == [False, False, False, True, False]


def test_summary_of_a_single_time(readings):
    row = temporal.step_summary(temporal.time_steps(readings([("01 00:00:00", "speed", 1.0)]))).first()
    assert (row["count"], row["min"], row["p25"], row["num_gaps"]) == (0, None, None, 0)
    assert (row["expected_sec"], row["gap_threshold"]) == (900.0, 1350.0)


def test_rows_around_short_steps(readings, sizes):
    df = readings([
        ("01 00:00:00", "speed", 1.0),
        ("01 00:20:00", "speed", 1.0),
        ("01 00:20:00", "skin_temp", 1.0),
        ("01 00:25:00", "speed", 1.0),
        ("01 00:45:00", "speed", 1.0),
    ])
    hit = temporal.rows_around_short_steps(df).collect()
    assert sorted(r.reading_id for r in hit) == [2, 3]  # the short step and only the row just before it


def test_row_steps_count_copies(readings, sizes):
    df = readings([("01 00:00:00", "speed", 1.0), ("01 00:00:00", "speed", 1.0), ("01 00:30:00", "speed", 1.0)])
    assert [r.delta_s for r in temporal.row_steps(df).orderBy("reading_id").collect()] == [None, 0.0, 1800.0]
    assert [r.reading_id for r in temporal.row_gaps(df).collect()] == [2]


def test_time_grid_covers_floor_to_ceiling(readings, sizes):
    df = readings([("01 00:07:00", "speed", 1.0), ("01 10:01:00", "speed", 1.0)])
    slots = [r.ts_slot for r in grid.time_grid(df).orderBy("ts_slot").collect()]
    assert (slots[0], slots[-1], len(slots)) == (at("01 00:00:00"), at("01 10:15:00"), 42)


def test_survivor_audit(readings):
    df = readings([("01 00:00:30", "speed", 1.0), ("01 00:05:00", "speed", 1.0), ("01 00:15:00", "speed", 1.0)])
    row = grid.survivor_audit(df.withColumn("is_outlier", F.col("reading_id") < 2)).first()
    assert tuple(row)[1:] == (3, 2, 2, 1)


@pytest.fixture(scope="module")
def burst(spark):
    """A deployment with 20,000 rows of one timestamp, in the middle of rows at other times."""
    rows = spark.range(21_000).selectExpr(
        "id AS reading_id",
        "1 AS deployment_id",
        "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, CASE WHEN id < 500 THEN id WHEN id < 20500 THEN 600 ELSE id - 19000 END) AS ts_utc",
        "'total_run_time' AS variable",
        "CAST(CASE WHEN id % 977 = 0 THEN 5 ELSE id END AS DOUBLE) AS value",
    )
    return rows.repartition(6).cache()


def _with(spark, split_rows, build):
    """What `build` gives under a small `splitRows`."""
    spark.conf.set("spark.sensorweave.splitRows", str(split_rows))
    try:
        return build()
    finally:
        spark.conf.unset("spark.sensorweave.splitRows")


def test_a_burst_is_spread_by_count(spark, burst):
    """Pieces of one timestamp hold about `splitRows` rows each, in the order of (time, id)."""
    rows = _with(spark, 1000, lambda: with_chunks(burst, ["deployment_id"]).cache())
    sizes = [r["count"] for r in rows.groupBy("_chunk").count().collect()]
    assert len(sizes) > 15 and max(sizes) < 2500
    edges = rows.groupBy("_chunk").agg(F.min(F.struct("ts_utc", "reading_id")).alias("a"), F.max(F.struct("ts_utc", "reading_id")).alias("b"))
    edges = edges.orderBy("_chunk").collect()
    assert all(x.b < y.a for x, y in zip(edges, edges[1:]))


@pytest.mark.parametrize("split_rows", [3000, 97])
@pytest.mark.parametrize("name", ["flags", "steps", "row_steps", "around", "counter", "detect", "position"])
def test_a_burst_changes_nothing(spark, burst, split_rows, name):
    """Cut inside a timestamp or not: the same rows come out."""
    build = {
        "flags": lambda: temporal.with_time_flags(burst),
        "steps": lambda: temporal.time_steps(burst),
        "row_steps": lambda: temporal.row_steps(burst),
        "around": lambda: temporal.rows_around_short_steps(burst, limit_s=400),
        "counter": lambda: quality.flag_counter_decrease(burst),
        "detect": lambda: quality.detect(burst),
        "position": lambda: with_position(with_chunks(burst, ["deployment_id"]), ["deployment_id"], ["ts_utc", "reading_id"]).drop("_chunk", "_upto"),
    }[name]
    whole, cut = build(), _with(spark, split_rows, build)
    assert sorted(whole.columns) == sorted(cut.columns)
    cut = cut.select(whole.columns)
    assert whole.count() == cut.count() > 0
    assert whole.exceptAll(cut).count() == 0


def test_null_keys_have_pieces_too(spark, burst):
    rows = burst.withColumn("deployment_id", F.when(F.col("reading_id") % 2 == 0, F.col("deployment_id")))
    sizes = _with(spark, 1000, lambda: [r["count"] for r in with_chunks(rows, ["deployment_id"]).groupBy("deployment_id", "_chunk").count().collect()])
    assert max(sizes) < 2500 and sum(sizes) == 21_000
