"""Rules, codes, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.inputs import item_series, readings
from contract.registry import VIB, query, r6, sql_quality, sql_r6, sql_readings, us
from sensorweave import catalog
from sensorweave.operators import frames, grid, quality
from sensorweave.schema import to_number

K = 8
FLAGS = ["is_missing", "is_invalid_physical", "is_high", "is_outlier", "is_invalid_category", "is_invalid_monotonic", "is_gap", "is_small_delta"]
LABELS = " ".join(f"WHEN {code} THEN '{label}'" for code, label in catalog.QUALITY_LABELS.items())


@query("quality_code_counts", f"""WITH {sql_quality(K)}
SELECT quality_code, CASE quality_code {LABELS} END AS label, count(*) AS n,
  {sql_r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS percent FROM q GROUP BY quality_code""")
def quality_code_counts(spark, folder):
    return quality.code_counts(quality.detect(readings(spark, folder, K))).withColumn("percent", r6("percent"))


@query("quality_codes", f"""WITH {sql_quality(K)}
SELECT reading_id, quality_code, {sql_r6('delta_s')} AS delta_s, {', '.join(FLAGS)} FROM q""")
def quality_codes(spark, folder):
    return quality.detect(readings(spark, folder, K)).select("reading_id", "quality_code", r6("delta_s").alias("delta_s"), *FLAGS)


@query("quality_codes_tolerant", f"""WITH {sql_quality(K, tolerant=True)}
SELECT reading_id, {sql_r6('CASE WHEN NOT is_outlier THEN value END')} AS value, quality_code, is_invalid_monotonic, is_missing FROM q""")
def quality_codes_tolerant(spark, folder):
    rows = quality.detect(readings(spark, folder, K), catalog.COUNTER_TOLERANCE, drop_outliers=True)
    return rows.select("reading_id", r6("value").alias("value"), "quality_code", "is_invalid_monotonic", "is_missing")


@query("flag_counts", f"""WITH {sql_quality(K)} """ + " UNION ALL ".join(
    f"SELECT '{f}' AS flag, count(*) FILTER ({f}) AS n, {sql_r6(f'count(*) FILTER ({f}) * 100.0 / count(*)')} AS percent FROM q" for f in FLAGS))
def flag_counts(spark, folder):
    return quality.flag_counts(quality.detect(readings(spark, folder, K))).withColumn("percent", r6("percent"))


@query("invalid_physical", f"""WITH {sql_readings(K)}
SELECT reading_id, variable, {sql_r6('value')} AS value FROM r WHERE variable <> 'bearing_condition' AND value < 0""")
def invalid_physical(spark, folder):
    rows = readings(spark, folder, K).where(quality.is_invalid_physical())
    return rows.select("reading_id", "variable", r6("value").alias("value"))


@query("missing_values", f"WITH {sql_readings(K)} SELECT reading_id, variable FROM r WHERE value IS NULL")
def missing_values(spark, folder):
    return readings(spark, folder, K).where(quality.is_missing()).select("reading_id", "variable")


@query("category_invalid", f"""WITH {sql_readings(K)}
SELECT reading_id, {sql_r6('value')} AS value FROM r WHERE variable = 'bearing_condition' AND trunc(value) NOT IN (0, 1, 2, 3, 4)""")
def category_invalid(spark, folder):
    rows = readings(spark, folder, K).where(quality.is_invalid_category())
    return rows.select("reading_id", r6("value").alias("value"))


def _spread(source: str, keys: str) -> str:
    return f"""SELECT {keys}, count(value) AS count, {sql_r6('avg(value)')} AS mean, {sql_r6('min(value)')} AS min, {sql_r6('max(value)')} AS max,
  {sql_r6('quantile_cont(value, 0.25)')} AS q1, {sql_r6('quantile_cont(value, 0.75)')} AS q3,
  {sql_r6('quantile_cont(value, 0.75) - quantile_cont(value, 0.25)')} AS iqr
FROM {source} WHERE value IS NOT NULL GROUP BY {keys}"""


SPREAD = ["mean", "min", "max", "q1", "q3", "iqr"]


@query("vibration_stats", f"WITH {sql_readings(K)}, v AS (SELECT * FROM r WHERE variable IN {VIB}) {_spread('v', 'deployment_id, variable')}")
def vibration_stats(spark, folder):
    return quality.vibration_stats(readings(spark, folder, K)).withColumns({c: r6(c) for c in SPREAD})


@query("vibration_stats_global", f"WITH {sql_readings(K)}, v AS (SELECT * FROM r WHERE variable IN {VIB}) {_spread('v', 'variable')}")
def vibration_stats_global(spark, folder):
    return quality.vibration_stats(readings(spark, folder, K), ("variable",)).withColumns({c: r6(c) for c in SPREAD})


@query("outlier_flags", f"WITH {sql_quality(K)} SELECT reading_id, is_outlier, is_high FROM q WHERE variable IN {VIB}")
def outlier_flags(spark, folder):
    rows = readings(spark, folder, K).where(catalog.in_group(catalog.VIBRATION))
    return quality.flag_outliers(rows, quality.vibration_stats(rows)).select("reading_id", "is_outlier", "is_high")


COUNTER = f"""{sql_readings(K)}, t AS (SELECT *, lag(value) OVER (PARTITION BY deployment_id, variable ORDER BY us, reading_id) AS prev FROM r)
SELECT reading_id, {sql_r6('value')} AS value FROM t WHERE variable = 'total_run_time' AND """


@query("counter_strict", f"WITH {COUNTER} value < prev")
def counter_strict(spark, folder):
    rows = quality.flag_counter_decrease(readings(spark, folder, K)).where("is_invalid_monotonic")
    return rows.select("reading_id", r6("value").alias("value"))


@query("counter_tolerant", f"WITH {COUNTER} value - prev < -1e-6")
def counter_tolerant(spark, folder):
    rows = quality.flag_counter_decrease(readings(spark, folder, K), catalog.COUNTER_TOLERANCE)
    return rows.where("is_invalid_monotonic").select("reading_id", r6("value").alias("value"))


# coarse values, so that flat stretches and jumps occur in the test data
COARSE = f"""{sql_readings(K)}, z AS (SELECT * REPLACE (CASE WHEN value < 200 THEN floor(value / 100) ELSE value END AS value) FROM r),
a AS (SELECT *, value - lag(value) OVER o AS step, stddev_samp(value) OVER s AS std8, count(value) OVER s AS n8,
    stddev_samp(value) OVER t AS std4, count(value) OVER t AS n4, count(*) OVER s AS rows8,
    CASE variable WHEN 'output_power' THEN 260 WHEN 'acc_rms_radial' THEN 2 WHEN 'overall_vibration' THEN 2 END AS jump
  FROM z WINDOW o AS (PARTITION BY deployment_id, variable ORDER BY us, reading_id),
    s AS (PARTITION BY deployment_id, variable ORDER BY us, reading_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW),
    t AS (PARTITION BY deployment_id, variable ORDER BY us, reading_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
sq AS (SELECT reading_id, coalesce(abs(step) > jump, false) AS is_excessive_jump,
  jump IS NOT NULL AND rows8 = 8 AND max((n8 = 8 AND std8 < 1e-6)::INT) OVER s = 1 AS is_stuck_value,
  jump IS NOT NULL AND n4 = 4 AND std4 > 1.5 AS is_excessive_noise
  FROM a WINDOW s AS (PARTITION BY deployment_id, variable ORDER BY us, reading_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))"""


def _coarse(df):
    return df.withColumn("value", F.when(F.col("value") < 200, F.floor(F.col("value") / 100).cast("double")).otherwise(F.col("value")))


@query("sequence_anomalies", f"WITH {COARSE} SELECT reading_id, is_excessive_jump, is_stuck_value, is_excessive_noise FROM sq")
def sequence_anomalies(spark, folder):
    rows = quality.flag_sequence_anomalies(_coarse(readings(spark, folder, K)))
    return rows.select("reading_id", "is_excessive_jump", "is_stuck_value", "is_excessive_noise")


@query("final_quality", f"""WITH {sql_quality(K)}, z AS (SELECT * FROM r),
a AS (SELECT *, value - lag(value) OVER o AS step, stddev_samp(value) OVER s AS std8, count(value) OVER s AS n8,
    stddev_samp(value) OVER t AS std4, count(value) OVER t AS n4, count(*) OVER s AS rows8,
    CASE variable WHEN 'output_power' THEN 260 WHEN 'acc_rms_radial' THEN 2 WHEN 'overall_vibration' THEN 2 END AS jump
  FROM z WINDOW o AS (PARTITION BY deployment_id, variable ORDER BY us, reading_id),
    s AS (PARTITION BY deployment_id, variable ORDER BY us, reading_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW),
    t AS (PARTITION BY deployment_id, variable ORDER BY us, reading_id ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
sq AS (SELECT reading_id, coalesce(abs(step) > jump, false) AS jumped,
  jump IS NOT NULL AND rows8 = 8 AND max((n8 = 8 AND std8 < 1e-6)::INT) OVER s = 1 AS stuck,
  jump IS NOT NULL AND n4 = 4 AND std4 > 1.5 AS noisy
  FROM a WINDOW s AS (PARTITION BY deployment_id, variable ORDER BY us, reading_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW))
SELECT reading_id, CASE WHEN is_invalid_physical THEN 5 WHEN is_invalid_monotonic THEN 6 WHEN jumped THEN 8 WHEN stuck THEN 7
  WHEN is_invalid_category THEN 4 WHEN is_outlier OR is_high THEN 3 WHEN is_gap THEN 2 WHEN is_missing THEN 1 WHEN noisy THEN 10 ELSE 0 END AS quality_code
FROM q JOIN sq USING (reading_id)""")
def final_quality(spark, folder):
    rows = quality.flag_sequence_anomalies(quality.detect(readings(spark, folder, K)))
    return quality.with_extended_quality_code(rows).select("reading_id", "quality_code")


@query("iqr_mask_series", f"""WITH {sql_readings(K)}, s AS (SELECT deployment_id, variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM r WHERE value IS NOT NULL GROUP BY ALL)
SELECT reading_id, {sql_r6("CASE WHEN variable = 'total_run_time' OR value BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1) THEN value END")} AS value
FROM r LEFT JOIN s USING (deployment_id, variable)""")
def iqr_mask_series(spark, folder):
    masked = frames.mask_series_outside_iqr(readings(spark, folder, K))
    return masked.select("reading_id", r6("value").alias("value"))


@query("null_severe", f"""WITH {sql_quality(K)}
SELECT reading_id, {sql_r6('CASE WHEN NOT (is_invalid_physical OR is_invalid_category OR is_invalid_monotonic OR is_outlier OR is_missing) THEN value END')} AS value FROM q""")
def null_severe(spark, folder):
    rows = quality.null_severe(quality.detect(readings(spark, folder, K)))
    return rows.select("reading_id", r6("value").alias("value"))


@query("sample_of_code", f"""WITH {sql_quality(K)}
SELECT reading_id, us AS ts_us, variable, {sql_r6('value')} AS value, quality_code FROM q WHERE quality_code = 3 ORDER BY us, reading_id LIMIT 10""")
def sample_of_code(spark, folder):
    rows = quality.sample_of_code(quality.detect(readings(spark, folder, K)), 3)
    return rows.select("reading_id", us("ts_utc").alias("ts_us"), "variable", r6("value").alias("value"), "quality_code")


@query("quality_filter", f"WITH {sql_quality(K)} SELECT reading_id, quality_code FROM q WHERE quality_code IN (0, 3)")
def quality_filter(spark, folder):
    rows = quality.detect(readings(spark, folder, K)).where(F.col("quality_code").isin(0, 3))
    return rows.select("reading_id", "quality_code")


@query("variable_catalog", f"""WITH {sql_readings(K)}
SELECT reading_id, variable,
  CASE variable WHEN 'acc_rms_radial' THEN 'Acceleration RMS (Radial)' WHEN 'overall_vibration' THEN 'Overall Vibration'
    WHEN 'output_power' THEN 'Output Power' WHEN 'bearing_condition' THEN 'Bearing Condition' ELSE 'Total Running Time' END AS source_name,
  CASE variable WHEN 'output_power' THEN 'physical' WHEN 'bearing_condition' THEN 'categorical' WHEN 'total_run_time' THEN 'accumulative' ELSE 'vibration' END AS variable_group,
  CASE WHEN variable IN ('bearing_condition', 'total_run_time') THEN 'ffill' ELSE 'linear' END AS strategy
FROM r""")
def variable_catalog(spark, folder):
    rows = readings(spark, folder, K).withColumn("source_name", catalog.source_of())
    canonical = rows.withColumn("variable", catalog.canonical_of("source_name"))
    return canonical.select(
        "reading_id", "variable", "source_name",
        catalog.group_of("source_name").alias("variable_group"),
        catalog.strategy_of().alias("strategy"),
    )


@query("numeric_coercion", """SELECT event_id AS reading_id, round(try_cast(CASE event_id % 4 WHEN 0 THEN 'ON' WHEN 1 THEN '' WHEN 2 THEN value::VARCHAR END AS DOUBLE), 6) + 0.0 AS value FROM events""")
def numeric_coercion(spark, folder):
    kind = F.col("event_id") % 4
    events = spark.read.parquet(f"{folder}/events.parquet")
    text = F.when(kind == 0, "ON").when(kind == 1, "").when(kind == 2, F.col("value").cast("string")).otherwise("NaN")
    return events.select(F.col("event_id").alias("reading_id"), r6(to_number(text)).alias("value"))


ITEMS = """it AS (SELECT l_suppkey AS deployment_id, 'output_power' AS variable, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_suppkey, 'overall_vibration', l_extendedprice FROM lineitem)"""


@query("item_spread", f"WITH {ITEMS} {_spread('it', 'deployment_id, variable')}")
def item_spread(spark, folder):
    return quality.spread_stats(item_series(spark, folder)).withColumns({c: r6(c) for c in SPREAD})
