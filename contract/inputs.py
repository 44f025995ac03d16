"""Sensor tables derived from the given test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READINGS = """
SELECT
  event_id AS reading_id,
  user_id % {k} AS deployment_id,
  concat('asset_', user_id % 4) AS asset_code,
  concat('motor_', user_id % 6) AS motor_code,
  cast(ts AS timestamp) AS ts_utc,
  CASE event_type
    WHEN 'click' THEN 'acc_rms_radial'
    WHEN 'view' THEN 'overall_vibration'
    WHEN 'purchase' THEN 'output_power'
    WHEN 'error' THEN 'bearing_condition'
    WHEN 'signup' THEN 'total_run_time'
  END AS variable,
  CASE
    WHEN event_id % 53 = 0 THEN NULL
    WHEN event_id % 61 = 0 THEN -value
    WHEN event_type = 'error' THEN cast(event_id % 6 AS double)
    WHEN event_type = 'signup' THEN event_id / 10.0D - CASE WHEN event_id % 71 = 0 THEN 50 ELSE 0 END
    WHEN event_type IN ('click', 'view') AND event_id % 67 = 0 THEN value * 10
    ELSE value
  END AS value
FROM {{events}}
"""

VARIABLES = ["acc_rms_radial", "overall_vibration", "output_power", "bearing_condition", "total_run_time"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def readings(spark: SparkSession, folder: str, k: int) -> DataFrame:
    """The event stream as readings of `k` deployments."""
    return spark.sql(READINGS.format(k=k), events=table(spark, folder, "events"))


def hourly_readings(spark: SparkSession, folder: str, k: int = 8) -> DataFrame:
    """Readings with times cut to the hour: many copies per (asset, motor, time, variable)."""
    return readings(spark, folder, k).withColumn("ts_utc", F.date_trunc("hour", "ts_utc"))


def deployments(spark: SparkSession, folder: str) -> DataFrame:
    """Deployments over the events: one per user and half of the month, some still running."""
    events = table(spark, folder, "events").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), (F.dayofmonth("ts") > 15).cast("long").alias("half")
    )
    spans = events.groupBy("user_id", "half").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))
    running = (F.col("user_id") % 7 == 0) & (F.col("half") == 1)
    return spans.select(
        (F.col("user_id") * 2 + F.col("half")).alias("deployment_id"),
        (F.col("user_id") % 40).alias("asset_id"),
        F.col("user_id").alias("motor_id"),
        "start_ts",
        F.when(~running, F.col("end_ts")).alias("end_ts"),
    )


def assets(spark: SparkSession, folder: str) -> DataFrame:
    ids = table(spark, folder, "events").select((F.col("user_id") % 40).alias("asset_id")).distinct()
    return ids.withColumn("asset_code", F.concat(F.lit("asset_"), F.col("asset_id").cast("string")))


def motors(spark: SparkSession, folder: str) -> DataFrame:
    ids = table(spark, folder, "events").select(F.col("user_id").alias("motor_id")).distinct()
    return ids.withColumn("motor_code", F.concat(F.lit("motor_"), F.col("motor_id").cast("string")))


def user_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of one motor per user, without a deployment."""
    events = table(spark, folder, "events")
    return events.select(
        F.col("event_id").alias("reading_id"),
        F.concat(F.lit("asset_"), (F.col("user_id") % 40).cast("string")).alias("asset_code"),
        F.concat(F.lit("motor_"), F.col("user_id").cast("string")).alias("motor_code"),
        F.col("ts").cast("timestamp").alias("ts_utc"),
        F.col("event_type").alias("variable"),
        "value",
    )


def machine_frame(spark: SparkSession, folder: str) -> DataFrame:
    """A wide frame from line items: a deployment per supplier, an (irregular) row per ship date."""
    items = table(spark, folder, "lineitem")
    # one division of two whole numbers, off the grid of six decimals: no ties in rounded results
    cents = F.sum(F.round(F.col("l_extendedprice") * 100).cast("long"))
    radial = F.when(F.dayofmonth("l_shipdate") == 1, 0.0).otherwise(F.avg("l_quantity"))
    return (
        items.groupBy(F.col("l_suppkey").alias("deployment_id"), "l_shipdate")
        .agg(
            (cents / (F.count(F.lit(1)) * 99991.0)).alias("acc_rms_axial"),
            radial.alias("acc_rms_radial"),
            F.min("l_discount").alias("vibration_axial"),
            F.max("l_tax").alias("skin_temp"),
            F.max("l_orderkey").cast("double").alias("total_run_time"),
        )
        .withColumn("ts_slot", F.col("l_shipdate").cast("timestamp"))
        .drop("l_shipdate")
    )


def item_series(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as a long table: two variables per supplier."""
    items = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("deployment_id"),
        F.col("l_quantity").cast("double").alias("output_power"),
        F.col("l_extendedprice").cast("double").alias("overall_vibration"),
    )
    return items.unpivot(["deployment_id"], ["output_power", "overall_vibration"], "variable", "value")
