"""Scans, deployment joins, stored tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from contract.inputs import VARIABLES, assets, deployments, hourly_readings, motors, readings, user_readings
from contract.grid_queries import LAST, _observed
from contract.feature_queries import NAMES, WINDOWS, WINDOW_S, _windows
from contract.registry import query, r6, sql_floor, sql_grid, sql_quality, sql_r6, sql_readings, us
from sensorweave import catalog
from sensorweave.operators import grid, impute, quality, windows
from sensorweave.session import materialise, shared_folder
from sensorweave.sources import readings as scans
from sensorweave.sources import sinks

K = 8
START, END = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 20, 12)
RANGE = "ts_utc >= TIMESTAMP '2024-01-05 00:00:00' AND ts_utc < TIMESTAMP '2024-01-20 12:00:00'"


def _folder(spark, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


@query("range_scan", f"WITH {sql_readings(K)} SELECT us AS ts_us, variable, {sql_r6('value')} AS value FROM r WHERE asset_code = 'asset_1' AND {RANGE} ORDER BY us")
def range_scan(spark, folder):
    rows = scans.range_scan(readings(spark, folder, K), "asset_1", START, END)
    return rows.select(us("ts_utc").alias("ts_us"), "variable", r6("value").alias("value"))


@query("motor_scan", f"WITH {sql_readings(K)} SELECT reading_id, us AS ts_us FROM r WHERE asset_code = 'asset_1' AND motor_code = 'motor_3' AND {RANGE}")
def motor_scan(spark, folder):
    rows = scans.motor_scan(readings(spark, folder, K), "asset_1", "motor_3", START, END)
    return rows.select("reading_id", us("ts_utc").alias("ts_us"))


@query("listing", f"WITH {sql_readings(K)} SELECT reading_id, us AS ts_us, asset_code FROM r WHERE motor_code = 'motor_2' AND variable = 'output_power' AND ts_utc >= TIMESTAMP '2024-01-05 00:00:00' ORDER BY us, reading_id")
def listing(spark, folder):
    rows = scans.listing(readings(spark, folder, K), motor_code="motor_2", variable="output_power", start=START)
    return rows.select("reading_id", us("ts_utc").alias("ts_us"), "asset_code")


@query("until_date", f"WITH {sql_readings(K)} SELECT us AS ts_us, variable, {sql_r6('value')} AS value FROM r WHERE variable = 'acc_rms_radial' AND motor_code = 'motor_1' AND CAST(ts_utc AS DATE) <= DATE '2024-01-21' ORDER BY us")
def until_date(spark, folder):
    rows = scans.until_date(readings(spark, folder, K), "acc_rms_radial", dt.date(2024, 1, 21), "motor_1")
    return rows.select(us("ts_utc").alias("ts_us"), "variable", r6("value").alias("value"))


@query("deployment_range_join", """WITH e AS (SELECT event_id AS reading_id, user_id, epoch_us(ts) AS us, CASE WHEN day(ts) > 15 THEN 1 ELSE 0 END AS half FROM events),
dp AS (SELECT user_id * 2 + half AS deployment_id, user_id, min(us) AS lo, CASE WHEN NOT (user_id % 7 = 0 AND half = 1) THEN max(us) END AS hi FROM e GROUP BY user_id, half)
SELECT e.reading_id, dp.deployment_id, 'asset_' || (e.user_id % 40) AS asset_code, 'motor_' || e.user_id AS motor_code, e.us AS ts_us
FROM e JOIN dp ON e.user_id = dp.user_id AND e.us >= dp.lo AND e.us < dp.hi""")
def deployment_range_join(spark, folder):
    known = scans.with_codes(deployments(spark, folder), assets(spark, folder), motors(spark, folder))
    rows = scans.deployment_readings(user_readings(spark, folder), known)
    return rows.select("reading_id", "deployment_id", "asset_code", "motor_code", us("ts_utc").alias("ts_us"))


@query("deployment_codes", """SELECT user_id * 2 + half AS deployment_id, 'asset_' || (user_id % 40) AS asset_code, 'motor_' || user_id AS motor_code
FROM (SELECT DISTINCT user_id, CASE WHEN day(ts) > 15 THEN 1 ELSE 0 END AS half FROM events)""")
def deployment_codes(spark, folder):
    known = scans.with_codes(deployments(spark, folder), assets(spark, folder), motors(spark, folder))
    return known.select("deployment_id", "asset_code", "motor_code")


def _measured(spark, folder):
    return quality.detect(readings(spark, folder, K))


@query("write_measurements", f"""WITH {sql_quality(K)} SELECT deployment_id, us AS ts_us, variable, {sql_r6('value')} AS value, quality_code FROM q WHERE quality_code IN (0, 3)""")
def write_measurements(spark, folder):
    """Two overlapping writes; the stored table must hold every row once."""
    rows = _measured(spark, folder)
    path = _folder(spark, "measurements")
    sinks.write_measurements(rows.where(F.dayofmonth("ts_utc") < 20), path, {0, 3})
    sinks.write_measurements(rows, path, {0, 3})
    stored = scans.load_measurements(spark.read.parquet(path))
    return stored.select("deployment_id", us("ts_utc").alias("ts_us"), "variable", r6("value").alias("value"), "quality_code")


@query("write_counts", f"""WITH {sql_quality(K)}, t AS (SELECT DISTINCT deployment_id, {sql_floor('us', 3600)} AS us, variable FROM r)
SELECT (SELECT count(*) FROM t) AS inserted, (SELECT count(*) FROM r) - (SELECT count(*) FROM t) AS skipped, 0::BIGINT AS failed, 1 AS run
UNION ALL SELECT 0, (SELECT count(*) FROM r), 0, 2""")
def write_counts(spark, folder):
    """Counts of a first write and of the same write again."""
    rows = hourly_readings(spark, folder, K).withColumn("quality_code", F.lit(0))
    path = _folder(spark, "hourly")
    counts = [sinks.write_measurements(rows, path), sinks.write_measurements(rows, path)]
    return spark.createDataFrame(
        [(*c, i + 1) for i, c in enumerate(counts)], "inserted long, skipped long, failed long, run int"
    )


@query("write_after_failure", f"""WITH {sql_quality(K)}, t AS (SELECT DISTINCT deployment_id, {sql_floor('us', 3600)} AS us, variable FROM r)
SELECT (SELECT count(*) FROM t) AS inserted, (SELECT count(*) FROM r) - (SELECT count(*) FROM t) AS skipped, 0::BIGINT AS failed, (SELECT count(*) FROM t) AS stored""")
def write_after_failure(spark, folder):
    """A write that dies half-way stores nothing; the same write again stores every row once."""
    rows = hourly_readings(spark, folder, K).withColumn("quality_code", F.lit(0))
    path = _folder(spark, "hourly")
    dies = F.when(F.col("reading_id") % 997 == 5, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("value"))
    try:
        sinks.write_measurements(rows.withColumn("value", dies), path)
    except Exception as error:  # the error that was put in, and no other
        if "lost" not in str(error):
            raise
    done = sinks.write_measurements(rows, path)
    stored = spark.read.parquet(path).count()
    return spark.createDataFrame([(*done, stored)], "inserted long, skipped long, failed long, stored long")


@query("load_measurements", f"""WITH {sql_quality(K)} SELECT deployment_id, us AS ts_us, {sql_r6('value')} AS value, quality_code FROM q
WHERE variable = 'output_power' AND deployment_id IN (1, 3) AND {RANGE} ORDER BY deployment_id, us""")
def load_measurements(spark, folder):
    path = _folder(spark, "measurements")
    sinks.write_measurements(_measured(spark, folder), path)
    rows = scans.load_measurements(spark.read.parquet(path), [1, 3], "output_power", START, END)
    return rows.select("deployment_id", us("ts_utc").alias("ts_us"), r6("value").alias("value"), "quality_code")


@query("write_features", f"WITH {WINDOWS} " + " UNION ALL ".join(
    f"SELECT deployment_id, ts_us, 'acc_rms_radial' AS variable, '{n}' AS feature, {sql_r6(n)} AS value, {WINDOW_S} AS window_s, quality_code FROM ft" for n in NAMES))
def write_features(spark, folder):
    rows = materialise(windows.features_long(_windows(spark, folder)), "features")  # written twice
    path = _folder(spark, "features")
    sinks.write_features(rows, path)
    sinks.write_features(rows, path)
    stored = scans.load_features(spark.read.parquet(path), WINDOW_S)
    return stored.select("deployment_id", us("ts_utc").alias("ts_us"), "variable", "feature", r6("value").alias("value"), "window_s", "quality_code")


NAMED = " ".join(f"WHEN '{v}' THEN '{catalog.TO_SOURCE[v]}'" for v in VARIABLES)


@query("append_clean_rows", f"""WITH {LAST} SELECT deployment_id, slot AS ts_us, CASE variable {NAMED} END AS variable, {sql_r6('value')} AS value, 'basic_cleaning' AS source_tag
FROM o WHERE value IS NOT NULL""")
def append_clean_rows(spark, folder):
    wide = grid.pivot_wide(_observed(spark, folder), columns=VARIABLES)
    path = _folder(spark, "clean")
    sinks.append_wide(wide, path, "basic_cleaning")
    rows = spark.read.parquet(path)
    return rows.select("deployment_id", us("ts_utc").alias("ts_us"), "variable", r6("value").alias("value"), "source_tag")


@query("csv_round_trip", f"WITH {sql_readings(K)} SELECT reading_id, us AS ts_us, variable, {sql_r6('value')} AS value FROM r")
def csv_round_trip(spark, folder):
    """Write readings as CSV and scan them with the given schema."""
    rows = readings(spark, folder, K)
    path = _folder(spark, "csv")
    layout = rows.select(
        "reading_id", "asset_code", "motor_code", "ts_utc", F.col("ts_utc").alias("ts_local"), "variable", "value"
    )
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    layout.write.option("header", True).option("timestampFormat", stamp).csv(path)
    read = scans.with_numeric_value(scans.read_csv(spark, path, stamp))
    return read.select("reading_id", us("ts_utc").alias("ts_us"), "variable", r6("value").alias("value"))


@query("csv_export", f"""WITH {LAST} SELECT deployment_id::INT AS deployment_id, count(*) AS slots, {', '.join(f"count(*) FILTER (variable = '{v}' AND value IS NOT NULL)::BIGINT AS {v}" for v in VARIABLES)}
FROM o GROUP BY deployment_id""".replace("count(*) AS slots", "count(DISTINCT slot) AS slots"))
def csv_export(spark, folder):
    """Wide CSV export per deployment, read back and counted."""
    wide = grid.pivot_wide(_observed(spark, folder), columns=VARIABLES)
    path = _folder(spark, "wide")
    sinks.export_csv(wide, path)
    read = spark.read.option("header", True).csv(path)
    return read.groupBy("deployment_id").agg(F.count(F.lit(1)).alias("slots"), *[F.count(v).alias(v) for v in VARIABLES])


# --- exports: both halves, read back ---------------------------------------------

CODES = f"""{LAST}, {sql_grid('o', 900)}, e AS (SELECT *, variable IN ('bearing_condition', 'total_run_time') AS carried,
  value IS NULL AND pslot IS NOT NULL AND ((coalesce(nslot, hi + 900000000) - pslot) // 900000000 - 1) <= 2 AS fillable FROM n),
pc AS (SELECT *, CASE WHEN value IS NOT NULL THEN 0 WHEN fillable AND carried THEN 2 WHEN fillable THEN 1 ELSE 3 END AS code FROM e)"""


def _csv(spark, path):
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


@query("csv_export_wide", f"""WITH {CODES} SELECT deployment_id::INT AS deployment_id, variable, count(*) AS slots,
  count(*) FILTER (code < 3) AS filled, sum(code)::BIGINT AS codes FROM pc GROUP BY deployment_id, variable""")
def csv_export_wide(spark, folder):
    """Filled values and their processing codes as two wide CSV exports, read back and put together."""
    cells = impute.fill_short_runs(grid.complete_grid(_observed(spark, folder)))
    path = _folder(spark, "export")
    values = grid.pivot_wide(cells, columns=VARIABLES)
    codes = grid.pivot_wide(cells, columns=VARIABLES, value="processing_code")
    sinks.export_wide(values, codes, path)
    both = []
    for half, name in (("values", "value"), ("codes", "code")):
        index = ["deployment_id", "ts_slot"]
        both.append(_csv(spark, f"{path}/{half}").unpivot(index, VARIABLES, "variable", name))
    rows = both[0].join(both[1], ["deployment_id", "ts_slot", "variable"], "full").where("code IS NOT NULL")
    return rows.groupBy("deployment_id", "variable").agg(
        F.count(F.lit(1)).alias("slots"), F.count("value").alias("filled"), F.sum(F.col("code").cast("long")).alias("codes")
    )


@query("csv_export_long", f"""WITH {sql_quality(K)} SELECT 'quality' AS half, deployment_id::INT AS deployment_id, variable, count(*) AS n, sum(quality_code)::BIGINT AS codes FROM q GROUP BY ALL
UNION ALL SELECT 'clean', deployment_id::INT, variable, count(*), 0 FROM q WHERE quality_code = 0 GROUP BY ALL""")
def csv_export_long(spark, folder):
    """The flagged readings and the clean ones as two long CSV exports, read back and counted."""
    rows = materialise(_measured(spark, folder).select("reading_id", "deployment_id", "ts_utc", "variable", "value", "quality_code"), "measured")
    path = _folder(spark, "long")
    sinks.export_long(rows, rows.where("quality_code = 0").drop("quality_code"), path)
    quality_half = _csv(spark, f"{path}/quality").withColumnRenamed("variable_original", "variable").withColumn("half", F.lit("quality"))
    clean_half = _csv(spark, f"{path}/clean").withColumns({"half": F.lit("clean"), "quality_code": F.lit("0")})
    both = quality_half.unionByName(clean_half).groupBy("half", F.col("deployment_id").cast("int").alias("deployment_id"), "variable")
    return both.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("quality_code").cast("long")).alias("codes"))


@query("single_deployment", """WITH e AS (SELECT event_id AS reading_id, user_id, epoch_us(ts) AS us, CASE WHEN day(ts) > 15 THEN 1 ELSE 0 END AS half FROM events),
dp AS (SELECT user_id * 2 + half AS deployment_id, user_id, min(us) AS lo, CASE WHEN NOT (user_id % 7 = 0 AND half = 1) THEN max(us) END AS hi FROM e GROUP BY user_id, half),
one AS (SELECT * FROM dp WHERE deployment_id = (SELECT min(deployment_id) FROM dp WHERE hi IS NOT NULL))
SELECT e.reading_id, one.deployment_id, e.us AS ts_us, NULL::VARCHAR AS problem FROM e JOIN one ON e.user_id = one.user_id AND e.us >= one.lo AND e.us < one.hi
UNION ALL SELECT NULL, -1, NULL, 'not found'
UNION ALL SELECT NULL, (SELECT min(deployment_id) FROM dp WHERE hi IS NULL), NULL, 'still running' WHERE EXISTS (FROM dp WHERE hi IS NULL)""")
def single_deployment(spark, folder):
    """Readings of one deployment, and the two reasons for which a deployment cannot be loaded."""
    known = materialise(scans.with_codes(deployments(spark, folder), assets(spark, folder), motors(spark, folder)), "deployments")
    rows = user_readings(spark, folder)
    ended = F.col("end_ts").isNotNull()
    ids = known.agg(F.min(F.when(ended, F.col("deployment_id"))).alias("one"), F.min(F.when(~ended, F.col("deployment_id"))).alias("open")).first()
    found = scans.load_deployment(rows, known, ids["one"]).select("reading_id", "deployment_id", us("ts_utc").alias("ts_us"), F.lit(None).cast("string").alias("problem"))
    problems = []
    for wanted in [-1] + ([ids["open"]] if ids["open"] is not None else []):
        try:
            scans.load_deployment(rows, known, wanted)
        except ValueError as error:
            problems.append((None, wanted, None, "still running" if "running" in str(error) else "not found"))
    return found.unionByName(spark.createDataFrame(problems, found.schema))
