"""The three end-to-end flows."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.operators import frames, grid, impute, quality, windows
from sensorweave.operators.dedupe import keep_one
from sensorweave.operators.temporal import compare_steps, time_steps, with_time_flags
from sensorweave.session import materialise

READING_KEY = ("deployment_id", "ts_utc", "variable")


class Standard(NamedTuple):
    readings: DataFrame
    completed: DataFrame
    features: DataFrame


def completed_grid(
    flagged: DataFrame,
    step_s: int = catalog.SLOT_S,
    jitter_s: float = catalog.SLOT_S / 2,
    limit: int = catalog.IMPUTE_LIMIT,
) -> DataFrame:
    """Flagged readings to a complete grid: severe values dropped, short runs filled, every cell coded."""
    slots = grid.regular_unfilled(quality.null_severe(flagged), step_s, jitter_s)
    filled = impute.drop_context(impute.fill_short_runs(slots, limit))
    return filled.withColumn("variable_source", catalog.source_of())


def standard(
    raw: DataFrame,
    keys: Sequence[str] = READING_KEY,
    step_s: int = catalog.SLOT_S,
    window_s: int = catalog.FEATURE_WINDOW_S,
    expected_s: float = catalog.EXPECTED_S,
) -> Standard:
    """Dedupe, flag and code readings; snap, complete and fill them; features of the main signal.

    Two tables are written to the shared folder on the way: the deduplicated and the
    flagged readings. Later steps read each of them several times, a few columns at a time,
    and nothing before them is computed again. Features come from the flagged readings,
    not from the filled grid.
    """
    readings = materialise(keep_one(raw, keys), "readings")
    flagged = materialise(quality.detect(readings, expected_s=expected_s), "flagged")
    features = windows.features_long(windows.window_features(flagged, window_s))
    return Standard(flagged, completed_grid(flagged, step_s), features)


class Rounded(NamedTuple):
    quality: DataFrame
    clean: DataFrame
    steps: DataFrame


def rounded(
    raw: DataFrame,
    step_s: int = catalog.SLOT_S,
    limit: int = catalog.IMPUTE_LIMIT,
    expected_s: float = catalog.EXPECTED_S,
) -> Rounded:
    """Flag gaps, round times first, then detect (tolerant counters, outliers dropped); fill partly.

    `clean` marks filled cells and slots that miss any variable before filling; `steps`
    compares the time steps before and after rounding. The snapped and the detected readings
    are written to the shared folder on the way.
    """
    flagged = with_time_flags(raw, expected_s=expected_s)
    snapped = materialise(flagged.withColumn("ts_utc", grid.round_slot(F.col("ts_utc"), step_s)), "snapped")
    detected = quality.detect(snapped, catalog.COUNTER_TOLERANCE, drop_outliers=True, time_flags=False)
    detected = materialise(detected, "detected")
    slots = grid.collapse_max_or_mean(grid.with_floored_slot(detected, step_s), context=("deployment_id",))
    slots = slots.withColumn("variable", catalog.canonical_of())
    completed = grid.flag_incomplete_slots(grid.complete_grid(slots, step_s))
    clean = impute.drop_context(impute.fill_by_group(completed, limit))
    steps = compare_steps(time_steps(raw), time_steps(snapped))
    return Rounded(detected, clean, steps)


def resampled(
    raw: DataFrame,
    step_s: int = catalog.RESAMPLE_S,
    factor: float = catalog.IQR_FACTOR,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Mean per slot, IQR mask, carry forward, smooth: a wide frame of complete rows.

    Long form up to the pivot: mask and fill run per (deployment, variable). A row is
    complete when every variable its deployment has is known, and smoothed where it should be.
    """
    columns = list(columns or catalog.CANONICAL_NAMES)
    named = raw.withColumn("variable", catalog.canonical_of())
    slots = grid.floor_slot(F.col("ts_utc"), step_s)
    means = grid.collapse_mean(named.withColumn("ts_slot", slots), context=("deployment_id",))
    means = materialise(means, "means")
    masked = frames.mask_series_outside_iqr(means, factor)
    filled = impute.with_filled(grid.complete_grid(masked, step_s), impute.carry_forward())
    cells = [F.max(F.when(F.col("variable") == c, F.col("value"))).alias(c) for c in columns]
    known = F.count("value") == F.count(F.lit(1))
    wide = filled.groupBy("deployment_id", "ts_slot").agg(*cells, known.alias("_known"))
    wide = frames.smooth(wide, step_s=step_s)
    smoothed = [c for c in columns if f"{c}_SMOOTH" in wide.columns]
    for c in smoothed:
        wide = wide.where(F.col(c).isNull() | F.col(f"{c}_SMOOTH").isNotNull())
    return wide.where("_known").drop("_known")
