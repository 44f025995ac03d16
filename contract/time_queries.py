"""Duplicates, time steps, slots."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.inputs import hourly_readings, readings
from contract.registry import query, r6, sql_floor, sql_quality, sql_r6, sql_readings, sql_slot, sql_steps, us
from sensorweave.operators import dedupe, grid, quality, temporal

K = 8
HOURLY = f"""{sql_readings(K)},
h AS (SELECT * REPLACE ({sql_floor('us', 3600)} AS us) FROM r)"""


@query("dedupe_latest", f"""WITH {HOURLY}
SELECT asset_code, motor_code, us AS ts_us, variable, reading_id, {sql_r6('value')} AS value FROM h
QUALIFY row_number() OVER (PARTITION BY asset_code, motor_code, us, variable ORDER BY reading_id DESC) = 1""")
def dedupe_latest(spark, folder):
    kept = dedupe.keep_one(hourly_readings(spark, folder, K))
    return kept.select("asset_code", "motor_code", us("ts_utc").alias("ts_us"), "variable", "reading_id", r6("value").alias("value"))


@query("dedupe_first", f"""WITH {HOURLY}
SELECT asset_code, motor_code, us AS ts_us, variable, reading_id FROM h
QUALIFY row_number() OVER (PARTITION BY asset_code, motor_code, us, variable ORDER BY reading_id) = 1""")
def dedupe_first(spark, folder):
    kept = dedupe.keep_one(hourly_readings(spark, folder, K), keep="first")
    return kept.select("asset_code", "motor_code", us("ts_utc").alias("ts_us"), "variable", "reading_id")


@query("duplicate_report", f"""WITH {HOURLY}, c AS (SELECT count(*) AS n FROM h GROUP BY asset_code, motor_code, us, variable)
SELECT sum(n)::BIGINT AS total_rows, count(*) AS distinct_keys,
  coalesce(sum(n) FILTER (n > 1), 0)::BIGINT AS rows_in_groups, sum(n - 1)::BIGINT AS rows_removed FROM c""")
def duplicate_report(spark, folder):
    return dedupe.duplicate_report(hourly_readings(spark, folder, K))


@query("duplicate_rows", f"""WITH {HOURLY}
SELECT reading_id, us AS ts_us, variable FROM h
QUALIFY count(*) OVER (PARTITION BY us, variable) > 1""")
def duplicate_rows(spark, folder):
    rows = dedupe.duplicate_rows(hourly_readings(spark, folder, K), ("ts_utc", "variable"))
    return rows.select("reading_id", us("ts_utc").alias("ts_us"), "variable")


@query("gap_flags", f"""WITH {sql_readings(K)}, {sql_steps()}
SELECT reading_id, {sql_r6('delta_s')} AS delta_s, coalesce(delta_s > 1350, false) AS is_gap,
  coalesce(delta_s > 0 AND delta_s < 450, false) AS is_small_delta
FROM r JOIN d USING (deployment_id, us)""")
def gap_flags(spark, folder):
    rows = temporal.with_time_flags(readings(spark, folder, K))
    return rows.select("reading_id", r6("delta_s").alias("delta_s"), "is_gap", "is_small_delta")


@query("time_steps", f"""WITH {sql_readings(K)}, {sql_steps()}
SELECT deployment_id, us AS ts_us, {sql_r6('delta_s')} AS delta_s, coalesce(delta_s > 1350, false) AS is_gap FROM d""")
def time_steps(spark, folder):
    steps = temporal.time_steps(readings(spark, folder, K))
    return steps.select("deployment_id", us("ts_utc").alias("ts_us"), r6("delta_s").alias("delta_s"), "is_gap")


@query("delta_summary", f"""WITH {sql_readings(K)}, {sql_steps()}
SELECT deployment_id, count(delta_s) AS count, {sql_r6('min(delta_s)')} AS min, {sql_r6('max(delta_s)')} AS max,
  {sql_r6('avg(delta_s)')} AS mean, {sql_r6('stddev_samp(delta_s)')} AS std,
  {sql_r6('quantile_cont(delta_s, 0.25)')} AS p25, {sql_r6('quantile_cont(delta_s, 0.75)')} AS p75,
  count(*) FILTER (delta_s > 1350) AS num_gaps, 900.0::DOUBLE AS expected_sec, 1350.0::DOUBLE AS gap_threshold
FROM d GROUP BY deployment_id""")
def delta_summary(spark, folder):
    summary = temporal.step_summary(temporal.time_steps(readings(spark, folder, K)))
    stats = ["min", "max", "mean", "std", "p25", "p75"]
    return summary.withColumns({c: r6(c) for c in stats})


@query("small_deltas", f"""WITH {sql_readings(K)}, {sql_steps()}
SELECT deployment_id, us AS ts_us, {sql_r6('delta_s')} AS delta_s FROM d WHERE delta_s > 0 AND delta_s < 450""")
def small_deltas(spark, folder):
    steps = temporal.small_steps(temporal.time_steps(readings(spark, folder, K)))
    return steps.select("deployment_id", us("ts_utc").alias("ts_us"), r6("delta_s").alias("delta_s"))


@query("short_neighbours", f"""WITH {HOURLY},
hd AS (SELECT deployment_id, us, (us - lag(us) OVER (PARTITION BY deployment_id ORDER BY us)) / 1e6 AS delta_s
  FROM (SELECT DISTINCT deployment_id, us FROM h)),
m AS (SELECT h.reading_id, h.deployment_id, h.us, hd.delta_s, coalesce(hd.delta_s < 7200, false) AS short
  FROM h JOIN hd USING (deployment_id, us)),
w AS (SELECT *, lead(short) OVER (PARTITION BY deployment_id ORDER BY us, reading_id) AS next_short FROM m)
SELECT reading_id, us AS ts_us, {sql_r6('delta_s')} AS delta_s FROM w WHERE short OR coalesce(next_short, false)""")
def short_neighbours(spark, folder):
    rows = temporal.rows_around_short_steps(hourly_readings(spark, folder, K), limit_s=7200)
    return rows.select("reading_id", us("ts_utc").alias("ts_us"), r6("delta_s").alias("delta_s"))


@query("row_gaps", f"""WITH {sql_readings(K)},
t AS (SELECT reading_id, deployment_id, variable,
  (us - lag(us) OVER (PARTITION BY deployment_id, variable ORDER BY us, reading_id)) / 1e6 AS delta_s FROM r)
SELECT reading_id, deployment_id, variable, {sql_r6('delta_s')} AS delta_s FROM t WHERE delta_s > 900""")
def row_gaps(spark, folder):
    rows = temporal.row_gaps(readings(spark, folder, K))
    return rows.select("reading_id", "deployment_id", "variable", r6("delta_s").alias("delta_s"))


def _describe(name: str, source: str) -> str:
    parts = {
        "count": "count(delta_s)::DOUBLE", "mean": "avg(delta_s)", "std": "stddev_samp(delta_s)", "min": "min(delta_s)",
        "25%": "quantile_cont(delta_s, 0.25)", "50%": "quantile_cont(delta_s, 0.5)",
        "75%": "quantile_cont(delta_s, 0.75)", "max": "max(delta_s)",
    }
    return " UNION ALL ".join(
        f"SELECT deployment_id, '{stat}' AS stat, {expr} AS {name} FROM {source} GROUP BY deployment_id"
        for stat, expr in parts.items()
    )


@query("delta_comparison", f"""WITH {sql_readings(K)}, {sql_steps()},
e AS (SELECT deployment_id, us, (us - lag(us) OVER (PARTITION BY deployment_id ORDER BY us)) / 1e6 AS delta_s
  FROM (SELECT DISTINCT deployment_id, {sql_slot('us', 900)} AS us FROM r)),
x AS ({_describe('before', 'd')}), y AS ({_describe('after', 'e')})
SELECT deployment_id, stat, {sql_r6('before')} AS before, {sql_r6('after')} AS after
FROM x LEFT JOIN y USING (deployment_id, stat)""")
def delta_comparison(spark, folder):
    raw = readings(spark, folder, K)
    snapped = grid.with_rounded_slot(raw, slot="ts_utc")
    both = temporal.compare_steps(temporal.time_steps(raw), temporal.time_steps(snapped))
    return both.select("deployment_id", "stat", r6("before").alias("before"), r6("after").alias("after"))


@query("slot_round", f"""WITH {sql_readings(K)} SELECT reading_id, {sql_slot('us', 900)} AS slot_us FROM r""")
def slot_round(spark, folder):
    return grid.with_rounded_slot(readings(spark, folder, K)).select("reading_id", us("ts_slot").alias("slot_us"))


@query("slot_floor", f"""WITH {sql_readings(K)} SELECT reading_id, {sql_floor('us', 900)} AS slot_us FROM r""")
def slot_floor(spark, folder):
    return grid.with_floored_slot(readings(spark, folder, K)).select("reading_id", us("ts_slot").alias("slot_us"))


@query("slot_jitter", f"""WITH {sql_readings(K)}, t AS (SELECT reading_id, us, {sql_slot('us', 900)} AS slot_us FROM r)
SELECT reading_id, slot_us FROM t WHERE abs(us - slot_us) <= 60000000""")
def slot_jitter(spark, folder):
    return grid.assign_slots(readings(spark, folder, K)).select("reading_id", us("ts_slot").alias("slot_us"))


@query("survivor_audit", f"""WITH {sql_quality(K)}, t AS (SELECT *, abs(us - {sql_slot('us', 900)}) <= 60000000 AS inside FROM q)
SELECT deployment_id, count(*) AS rows_before, count(*) FILTER (inside) AS rows_within_jitter,
  count(*) FILTER (is_outlier) AS outliers, count(*) FILTER (is_outlier AND inside) AS outliers_within_jitter
FROM t GROUP BY deployment_id""")
def survivor_audit(spark, folder):
    return grid.survivor_audit(quality.detect(readings(spark, folder, K)))


@query("time_grid", f"""WITH {sql_readings(K)},
b AS (SELECT deployment_id, {sql_floor('min(us)', 900)} AS lo, -({sql_floor('-max(us)', 900)} - CASE WHEN max(us) % 900000000 = 0 THEN 0 ELSE 900000000 END) AS hi
  FROM r GROUP BY deployment_id)
SELECT deployment_id, unnest(generate_series(lo, hi, 900000000)) AS slot_us FROM b""")
def time_grid(spark, folder):
    slots = grid.time_grid(readings(spark, folder, K))
    return slots.select("deployment_id", us("ts_slot").alias("slot_us"))
