"""The end-to-end flows."""

from __future__ import annotations

from contract.feature_queries import EXPECTED_S, NAMES, WINDOWS, WINDOW_S
from contract.feature_queries import K as FEATURE_K
from contract.inputs import VARIABLES, readings
from contract.registry import SQL, query, r6, sql_floor, sql_grid, sql_quality, sql_r6, sql_readings, sql_slot, sql_steps, us
from contract.time_queries import K as TIME_K
from sensorweave.plans import flows

K = 2
SEVERE = "(is_invalid_physical OR is_invalid_category OR is_invalid_monotonic OR is_outlier OR is_missing)"
STEP = 900
FLAGS = ["is_gap", "is_small_delta", "is_missing", "is_invalid_physical", "is_outlier", "is_high", "is_invalid_category", "is_invalid_monotonic"]
LINE = "pvalue + (nvalue - pvalue) * ((slot - pslot)::DOUBLE / (nslot - pslot))"
RUN = f"((coalesce(nslot, hi + {STEP * 1_000_000}) - pslot) // {STEP * 1_000_000} - 1)"
BACK = f"((slot - pslot) // {STEP * 1_000_000})"
AHEAD = f"((nslot - slot) // {STEP * 1_000_000})"


@query("flow_standard", f"""WITH {sql_quality(K)}, z AS (SELECT *, {sql_slot('us', STEP)} AS slot, CASE WHEN NOT {SEVERE} THEN value END AS kept FROM q),
o AS (SELECT deployment_id, variable, slot, max_by(kept, us) FILTER (kept IS NOT NULL) AS value FROM z GROUP BY ALL), {sql_grid('o', STEP)},
e AS (SELECT *, variable IN ('bearing_condition', 'total_run_time') AS carried, value IS NULL AND pslot IS NOT NULL AND {RUN} <= 2 AS fillable FROM n)
SELECT deployment_id, variable, slot AS slot_us,
  {sql_r6(f'CASE WHEN NOT fillable THEN value WHEN carried OR nslot IS NULL THEN pvalue ELSE {LINE} END')} AS value,
  (CASE WHEN value IS NOT NULL THEN 0 WHEN fillable AND carried THEN 2 WHEN fillable THEN 1 ELSE 3 END)::TINYINT AS processing_code FROM e""")
def flow_standard(spark, folder):
    done = flows.standard(readings(spark, folder, K)).completed
    return done.select("deployment_id", "variable", us("ts_slot").alias("slot_us"), r6("value").alias("value"), "processing_code")


# the second rule set works on rounded times, so several readings share one time
ROUNDED = f"""{sql_readings(K)}, rr AS (SELECT *, {sql_slot('us', STEP)} AS slot FROM r),
s AS (SELECT deployment_id, variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM r WHERE variable IN ('acc_rms_radial', 'overall_vibration') AND value IS NOT NULL GROUP BY ALL),
f AS (SELECT rr.*, coalesce(q3 - q1 > 0 AND (value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1)), false) AS is_outlier FROM rr LEFT JOIN s USING (deployment_id, variable)),
o AS (SELECT deployment_id, variable, slot, CASE WHEN variable = 'total_run_time' THEN max(value) ELSE avg(value) END AS value
  FROM (SELECT * REPLACE (CASE WHEN NOT is_outlier THEN value END AS value) FROM f) GROUP BY deployment_id, variable, slot), {sql_grid('o', STEP)},
c AS (SELECT *, bool_or(value IS NULL) OVER (PARTITION BY deployment_id, slot) AS is_missing_general,
  CASE WHEN value IS NOT NULL THEN value
  WHEN variable IN ('bearing_condition', 'total_run_time') THEN CASE WHEN {BACK} <= 2 THEN pvalue WHEN {AHEAD} <= 2 THEN nvalue END
  WHEN coalesce({BACK} <= 2, false) OR coalesce({AHEAD} <= 2, false)
  THEN CASE WHEN pslot IS NULL THEN nvalue WHEN nslot IS NULL THEN pvalue ELSE {LINE} END END AS filled FROM n)"""


@query("flow_rounded", f"""WITH {ROUNDED} SELECT deployment_id, variable, slot AS slot_us, {sql_r6('filled')} AS value,
  value IS NULL AND filled IS NOT NULL AS is_imputed, is_missing_general FROM c""")
def flow_rounded(spark, folder):
    clean = flows.rounded(readings(spark, folder, K)).clean
    return clean.select("deployment_id", "variable", us("ts_slot").alias("slot_us"), r6("value").alias("value"), "is_imputed", "is_missing_general")


@query("flow_standard_readings", f"""WITH {sql_quality(K)} SELECT reading_id, {sql_r6('delta_s')} AS delta_s, {', '.join(FLAGS)}, quality_code FROM q""")
def flow_standard_readings(spark, folder):
    """The deduplicated readings with their time steps, flags and quality codes."""
    rows = flows.standard(readings(spark, folder, K)).readings
    return rows.select("reading_id", r6("delta_s").alias("delta_s"), *FLAGS, "quality_code")


@query("flow_standard_features", f"WITH {WINDOWS} " + " UNION ALL ".join(
    f"SELECT deployment_id, ts_us, '{n}' AS feature, {sql_r6(n)} AS value, quality_code FROM ft" for n in NAMES))
def flow_standard_features(spark, folder):
    """Time-domain and spectral features of the main signal, as the flow gives them."""
    rows = flows.standard(readings(spark, folder, FEATURE_K), window_s=WINDOW_S, expected_s=EXPECTED_S).features
    return rows.select("deployment_id", us("ts_utc").alias("ts_us"), "feature", r6("value").alias("value"), "quality_code")


# flags of the second rule set: gaps before rounding, counters in the order of rounded times
ROUNDED_QUALITY = f"""{sql_readings(K)}, {sql_steps()}, rr AS (SELECT r.*, {sql_slot('us', STEP)} AS slot FROM r),
s AS (SELECT deployment_id, variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM r WHERE variable IN ('acc_rms_radial', 'overall_vibration') AND value IS NOT NULL GROUP BY ALL),
p AS (SELECT *, lag(value) OVER (PARTITION BY deployment_id, variable ORDER BY slot, reading_id) AS prev FROM rr),
f AS (SELECT p.reading_id, p.slot, p.variable, p.value, coalesce(d.delta_s > 900 * 1.5, false) AS is_gap, p.value IS NULL AS is_missing,
  coalesce(variable <> 'bearing_condition' AND value < 0, false) AS is_invalid_physical,
  coalesce(q3 - q1 > 0 AND (value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1)), false) AS is_outlier,
  coalesce(variable = 'bearing_condition' AND trunc(value) NOT IN (0, 1, 2, 3, 4), false) AS is_invalid_category,
  coalesce(variable = 'total_run_time' AND value - prev < -1e-6, false) AS is_invalid_monotonic
  FROM p JOIN d USING (deployment_id, us) LEFT JOIN s USING (deployment_id, variable))"""


@query("flow_rounded_quality", f"""WITH {ROUNDED_QUALITY} SELECT reading_id, slot AS slot_us, {sql_r6('CASE WHEN NOT is_outlier THEN value END')} AS value, is_gap, is_invalid_monotonic, is_outlier,
  CASE WHEN is_invalid_monotonic THEN 6 WHEN is_invalid_physical THEN 5 WHEN is_invalid_category THEN 4 WHEN is_outlier THEN 3 WHEN is_gap THEN 2 WHEN is_missing THEN 1 ELSE 0 END AS quality_code FROM f""")
def flow_rounded_quality(spark, folder):
    """Readings at rounded times with the flags of the second rule set."""
    rows = flows.rounded(readings(spark, folder, K)).quality
    return rows.select("reading_id", us("ts_utc").alias("slot_us"), r6("value").alias("value"), "is_gap", "is_invalid_monotonic", "is_outlier", "quality_code")


@query("flow_rounded_steps", SQL["delta_comparison"].replace(f"user_id % {TIME_K} AS", f"user_id % {K} AS"))
def flow_rounded_steps(spark, folder):
    """Time steps before and after rounding, as the flow gives them."""
    steps = flows.rounded(readings(spark, folder, K)).steps
    return steps.select("deployment_id", "stat", r6("before").alias("before"), r6("after").alias("after"))


RESAMPLE_S = 3600
WIDE = ", ".join(f"max(value) FILTER (variable = '{v}') AS {v}" for v in VARIABLES)


@query("flow_resampled", f"""WITH {sql_readings(K)},
mm AS (SELECT deployment_id, variable, {sql_floor('us', RESAMPLE_S)} AS slot, avg(value) AS value FROM r GROUP BY ALL),
s AS (SELECT deployment_id, variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM mm WHERE value IS NOT NULL GROUP BY ALL),
o AS (SELECT deployment_id, variable, slot, CASE WHEN variable = 'total_run_time' OR value BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1) THEN value END AS value
  FROM mm JOIN s USING (deployment_id, variable)), {sql_grid('o', RESAMPLE_S)},
w AS (SELECT deployment_id, slot, {WIDE.replace('max(value)', 'max(pvalue)')} FROM n GROUP BY deployment_id, slot),
x AS (SELECT *, CASE WHEN count(acc_rms_radial) OVER k = 3 THEN avg(acc_rms_radial) OVER k END AS acc_rms_radial_SMOOTH
  FROM w WINDOW k AS (PARTITION BY deployment_id ORDER BY slot ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING))
SELECT deployment_id, slot AS slot_us, {', '.join(f'{sql_r6(v)} AS {v}' for v in [*VARIABLES, 'acc_rms_radial_SMOOTH'])} FROM x
WHERE {' AND '.join(f'{v} IS NOT NULL' for v in [*VARIABLES, 'acc_rms_radial_SMOOTH'])}""")
def flow_resampled(spark, folder):
    wide = flows.resampled(readings(spark, folder, K), RESAMPLE_S)
    names = [*VARIABLES, "acc_rms_radial_SMOOTH"]
    return wide.select("deployment_id", us("ts_slot").alias("slot_us"), *[r6(v).alias(v) for v in names])
