"""Scans: readings by range, by deployment, by listing filters; stored tables; CSV."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave import schema
from sensorweave.functions.skew import SALT, spread_hot_keys
from sensorweave.functions.timeline import US, floor_us, micros
from sensorweave.schema import with_numeric_value

When = dt.datetime | dt.date | str | None


def _instant(value: When) -> Column:
    return F.lit(value).cast("timestamp")


def in_range(ts: str, start: When = None, end: When = None) -> Column:
    """Half-open range test on the bare column, so that it reaches the file scan."""
    test = F.lit(True)
    if start is not None:
        test = test & (F.col(ts) >= _instant(start))
    if end is not None:
        test = test & (F.col(ts) < _instant(end))
    return test


def matching(**values) -> Column:
    """Equality test on every argument that is not None."""
    test = F.lit(True)
    for column, value in values.items():
        if value is not None:
            test = test & (F.col(column) == F.lit(value))
    return test


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, timestamp_format: str | None = None) -> DataFrame:
    """Readings from CSV with a header; the schema is given, nothing is inferred."""
    options = {"header": "true", "enforceSchema": "false"}
    if timestamp_format:
        options["timestampFormat"] = timestamp_format
    return spark.read.options(**options).schema(schema.READINGS).csv(path)


def range_scan(readings: DataFrame, asset_code: str, start: When = None, end: When = None) -> DataFrame:
    """Time, variable and value of one asset, ordered by time."""
    rows = readings.where(matching(asset_code=asset_code) & in_range("ts_utc", start, end))
    return rows.select("ts_utc", "variable", "value").orderBy("ts_utc")


def motor_scan(
    readings: DataFrame, asset_code: str, motor_code: str, start: When = None, end: When = None
) -> DataFrame:
    return readings.where(
        matching(asset_code=asset_code, motor_code=motor_code) & in_range("ts_utc", start, end)
    )


def listing(
    readings: DataFrame,
    asset_code: str | None = None,
    motor_code: str | None = None,
    variable: str | None = None,
    start: When = None,
    end: When = None,
    ts: str = "ts_utc",
) -> DataFrame:
    """Readings under any of the optional filters, ordered by time."""
    keep = matching(asset_code=asset_code, motor_code=motor_code, variable=variable)
    return readings.where(keep & in_range(ts, start, end)).orderBy(ts, "reading_id")


def until_date(readings: DataFrame, variable: str, last_day: dt.date, motor_code: str | None = None) -> DataFrame:
    """One variable up to and including a day; the day test is turned into a range on the bare column."""
    end = last_day + dt.timedelta(days=1)
    rows = readings.where(matching(variable=variable, motor_code=motor_code) & in_range("ts_utc", None, end))
    return rows.select("ts_utc", "variable", "value").orderBy("ts_utc")


# --- deployments -------------------------------------------------------------------

def with_codes(deployments: DataFrame, assets: DataFrame, motors: DataFrame) -> DataFrame:
    """Deployments with the codes of their asset and motor."""
    return deployments.join(assets, "asset_id").join(motors, "motor_id")


def finished(deployments: DataFrame) -> DataFrame:
    """Deployments with an end; running ones cannot be loaded."""
    return deployments.where(F.col("end_ts").isNotNull())


DAY_S = 86_400


def deployment_readings(readings: DataFrame, deployments: DataFrame) -> DataFrame:
    """Readings inside [start, end) of a deployment of their asset and motor, with its id.

    The range test is backed by a day key: a deployment is unfolded to the days it touches
    and joined on (asset, motor, day), so no reading meets a deployment of another day. A
    motor-day with very many readings is dealt out over salts.
    """
    keys = ["asset_code", "motor_code", "_day"]
    width = DAY_S * US
    first = floor_us(micros("start_ts"), width) / width
    last = floor_us(micros("end_ts") - 1, width) / width
    days = F.sequence(first.cast("long"), last.cast("long"))
    spans = (
        finished(deployments)
        .where(F.col("start_ts") < F.col("end_ts"))
        .select("deployment_id", "asset_code", "motor_code", "start_ts", "end_ts", F.explode(days).alias("_day"))
    )
    rows = readings.withColumn("_day", (floor_us(micros("ts_utc"), width) / width).cast("long"))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    rows, counts = spread_hot_keys(rows, counts, keys, "reading_id")
    joined = rows.join(spans.join(counts.drop("n"), keys), [*keys, SALT])
    inside = (F.col("ts_utc") >= F.col("start_ts")) & (F.col("ts_utc") < F.col("end_ts"))
    return joined.where(inside).drop("_day", SALT, "start_ts", "end_ts")


def load_deployment(readings: DataFrame, deployments: DataFrame, deployment_id: int) -> DataFrame:
    """Readings of one deployment, by plain filters; fails when it is unknown or still running."""
    row = deployments.where(F.col("deployment_id") == deployment_id).first()
    if row is None:
        raise ValueError(f"deployment {deployment_id} not found")
    if row["end_ts"] is None:
        raise ValueError(f"deployment {deployment_id} is still running: an end is required")
    rows = motor_scan(readings, row["asset_code"], row["motor_code"], row["start_ts"], row["end_ts"])
    return rows.withColumn("deployment_id", F.lit(deployment_id).cast("long"))


# --- stored tables -----------------------------------------------------------------

def load_measurements(
    measurements: DataFrame,
    deployments: Sequence[int] | None = None,
    variable: str | None = None,
    start: When = None,
    end: When = None,
) -> DataFrame:
    """Stored measurements under optional filters, ordered by deployment and time."""
    keep = matching(variable=variable) & in_range("ts_utc", start, end)
    if deployments is not None:
        keep = keep & F.col("deployment_id").isin(list(deployments))
    return with_numeric_value(measurements.where(keep)).orderBy("deployment_id", "ts_utc")


def load_features(features: DataFrame, window_s: int | None = None, **filters) -> DataFrame:
    return load_measurements(features.where(matching(window_s=window_s)), **filters)
