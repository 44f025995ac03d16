"""Tumbling feature windows of the main signal: time-domain and spectral features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions.ordered import with_chunks, with_position
from sensorweave.functions.spectrum import spectrum as transform_windows
from sensorweave.functions.timeline import US, from_micros, micros
from sensorweave.session import materialise

WINDOW = ["deployment_id", "window_no"]
# Feature names.
TIME_FEATURES = ["mean", "std", "min", "max", "rms_window", "count_samples"]
SPECTRAL_FEATURES = ["fft_peak_amp", "fft_peak_bin", "fft_energy_total"]


def window_features(
    df: DataFrame,
    window_s: int = catalog.FEATURE_WINDOW_S,
    min_samples: int = catalog.MIN_SAMPLES,
    signal: str = catalog.MAIN_SIGNAL,
    spectrum: str | None = "native",
) -> DataFrame:
    """One row per window that has enough good samples and no gap row.

    Windows start at the first reading of the signal in the deployment; one that starts at
    or after the last reading does not exist. Good: quality code 0 and a value. The
    reference time and the quality of a window come from all its rows. `spectrum` is
    'native', 'arrow' (fast transforms inside a group) or None. All features are aggregates of
    rows: no window is held in one row or task, whatever its length and sampling rate. For the
    spectrum the good samples are written to the shared folder on the way, each with its position.
    """
    rows = df.where(F.col("variable").isin(catalog.spellings([signal]))).withColumn("_us", micros("ts_utc"))
    span = rows.groupBy("deployment_id").agg(F.min("_us").alias("_start"), F.max("_us").alias("_end"))
    width = window_s * US
    k = F.floor((F.col("_us") - F.col("_start")) / width)
    rows = (
        rows.join(span, "deployment_id")
        .withColumn("window_no", k)
        .where(F.col("_start") + F.col("window_no") * width < F.col("_end"))
    )
    good = F.when((F.col("quality_code") == 0) & F.col("value").isNotNull(), F.col("value"))
    gap = F.col("is_gap") if "is_gap" in df.columns else F.lit(False)
    windows = (
        rows.groupBy(*WINDOW)
        .agg(
            F.avg(good).alias("mean"),
            F.coalesce(F.stddev_samp(good), F.lit(0.0)).alias("std"),
            F.min(good).alias("min"),
            F.max(good).alias("max"),
            F.sqrt(F.avg(good * good)).alias("rms_window"),
            F.count(good).cast("double").alias("count_samples"),
            F.max("_us").alias("_ref"),
            F.max("quality_code").alias("quality_code"),
            F.bool_or(gap).alias("_gap"),
        )
        .where((F.col("count_samples") >= min_samples) & ~F.col("_gap"))
        .withColumn("ts_utc", from_micros("_ref"))
        .withColumn("window_s", F.lit(window_s))
        .withColumn("variable", F.lit(signal))
        .drop("_ref", "_gap")
    )
    if not spectrum:
        return windows
    samples = rows.where(good.isNotNull()).select(*WINDOW, "ts_utc", "reading_id", "value")
    samples = with_position(with_chunks(samples, WINDOW), WINDOW, ["ts_utc", "reading_id"], "pos")
    known = windows.select(*WINDOW, F.col("count_samples").cast("long").alias("_n"), "mean")
    centred = samples.join(known, WINDOW).select(*WINDOW, "_n", "pos", (F.col("value") - F.col("mean")).alias("value"))
    return windows.join(transform_windows(materialise(centred, "samples"), WINDOW, spectrum), WINDOW)


def features_long(windows: DataFrame) -> DataFrame:
    """One row per window and feature."""
    index = ["deployment_id", "ts_utc", "variable", "window_s", "quality_code"]
    names = [c for c in TIME_FEATURES + SPECTRAL_FEATURES if c in windows.columns]
    return windows.unpivot(index, names, "feature", "value").select(
        "deployment_id", "ts_utc", "variable", "feature", "value", "window_s", "quality_code"
    )
