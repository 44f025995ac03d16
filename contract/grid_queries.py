"""Collapsing, completing, reshaping, filling."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.inputs import VARIABLES, readings
from contract.registry import query, r6, sql_floor, sql_grid, sql_quality, sql_r6, sql_readings, sql_slot, us
from sensorweave import catalog
from sensorweave.operators import grid, impute, quality

K = 2
STEP = 900
SLOTS = f"""{sql_readings(K)}, t AS (SELECT *, {sql_slot('us', STEP)} AS slot FROM r)"""
LAST = f"""{SLOTS}, o AS (SELECT deployment_id, variable, slot,
  max_by(value, us) FILTER (value IS NOT NULL) AS value FROM t GROUP BY ALL)"""
MAX_MEAN = f"""{sql_readings(K)}, o AS (SELECT deployment_id, variable, {sql_floor('us', STEP)} AS slot,
  CASE WHEN variable = 'total_run_time' THEN max(value) ELSE avg(value) END AS value FROM r GROUP BY deployment_id, variable, slot)"""
GRID = f"{LAST}, {sql_grid('o', STEP)}"
LINE = "pvalue + (nvalue - pvalue) * ((slot - pslot)::DOUBLE / (nslot - pslot))"
RUN = f"((coalesce(nslot, hi + {STEP * 1_000_000}) - pslot) // {STEP * 1_000_000} - 1)"
BACK = f"((slot - pslot) // {STEP * 1_000_000})"
AHEAD = f"((nslot - slot) // {STEP * 1_000_000})"
WIDE = ", ".join(f"{sql_r6(f'max(value) FILTER (variable = {chr(39)}{v}{chr(39)})')} AS {v}" for v in VARIABLES)


def _slots(spark, folder):
    return grid.with_rounded_slot(readings(spark, folder, K), STEP)


def _observed(spark, folder):
    return grid.collapse_last(_slots(spark, folder), context=("deployment_id",))


def _completed(spark, folder):
    return grid.complete_grid(_observed(spark, folder), STEP)


def _long(df, *extra, slot="ts_slot"):
    return df.select("deployment_id", "variable", us(slot).alias("slot_us"), r6("value").alias("value"), *extra)


@query("collapse_last", f"WITH {LAST} SELECT deployment_id, variable, slot AS slot_us, {sql_r6('value')} AS value FROM o")
def collapse_last(spark, folder):
    return _long(_observed(spark, folder))


@query("collapse_max_mean", f"WITH {MAX_MEAN} SELECT deployment_id, variable, slot AS slot_us, {sql_r6('value')} AS value FROM o")
def collapse_max_mean(spark, folder):
    slots = grid.with_floored_slot(readings(spark, folder, K), STEP)
    return _long(grid.collapse_max_or_mean(slots, context=("deployment_id",)))


@query("grid_reindex", f"WITH {GRID} SELECT deployment_id, variable, slot AS slot_us, {sql_r6('value')} AS value FROM g")
def grid_reindex(spark, folder):
    return _long(grid.reindex(_observed(spark, folder), STEP))


@query("regular_unfilled", f"""WITH {SLOTS}, j AS (SELECT * FROM t WHERE abs(us - slot) <= 200000000),
o AS (SELECT deployment_id, variable, slot, max_by(value, us) FILTER (value IS NOT NULL) AS value FROM j GROUP BY ALL),
{sql_grid('o', STEP)}
SELECT deployment_id, variable, slot AS slot_us, {sql_r6('value')} AS value FROM g""")
def regular_unfilled(spark, folder):
    return _long(impute.drop_context(grid.regular_unfilled(readings(spark, folder, K), STEP, jitter_s=200)))


@query("regular_filled", f"""WITH {GRID},
c AS (SELECT *, CASE WHEN value IS NOT NULL THEN value WHEN {BACK} <= 2 THEN pvalue WHEN {AHEAD} <= 2 THEN nvalue END AS filled FROM n)
SELECT deployment_id, variable, slot AS slot_us, {sql_r6('filled')} AS value,
  bool_or(filled IS NULL) OVER (PARTITION BY deployment_id, slot) AS is_missing_general FROM c""")
def regular_filled(spark, folder):
    filled = impute.with_filled(_completed(spark, folder), impute.carry_both_ways(2))
    return _long(grid.flag_incomplete_slots(filled), "is_missing_general")


@query("resample_mean", f"""WITH {sql_readings(K)},
o AS (SELECT deployment_id, variable, {sql_floor('us', 3600)} AS slot, avg(value) AS value FROM r GROUP BY ALL), {sql_grid('o', 3600)}
SELECT deployment_id, variable, slot AS slot_us, {sql_r6('value')} AS value FROM g""")
def resample_mean(spark, folder):
    return _long(impute.drop_context(grid.resample_mean(readings(spark, folder, K), 3600)))


@query("pivot_wide", f"WITH {LAST} SELECT deployment_id, slot AS slot_us, {WIDE} FROM o GROUP BY deployment_id, slot")
def pivot_wide(spark, folder):
    wide = grid.pivot_strict(_observed(spark, folder), columns=VARIABLES)
    return wide.select("deployment_id", us("ts_slot").alias("slot_us"), *[r6(v).alias(v) for v in VARIABLES])


@query("duplicate_cells", f"""WITH {SLOTS} SELECT deployment_id, slot AS slot_us, variable, count(*) AS n FROM t
GROUP BY ALL HAVING count(*) > 1""")
def duplicate_cells(spark, folder):
    return grid.duplicate_cells(_slots(spark, folder)).select("deployment_id", us("ts_slot").alias("slot_us"), "variable", "n")


@query("round_pivot", f"""WITH {SLOTS}, o AS (SELECT asset_code, motor_code, slot, variable,
  min_by(value, us) FILTER (value IS NOT NULL) AS value FROM t GROUP BY ALL)
SELECT asset_code, motor_code, slot AS slot_us, {WIDE} FROM o GROUP BY ALL""")
def round_pivot(spark, folder):
    wide = grid.round_and_pivot(readings(spark, folder, K), STEP, VARIABLES)
    return wide.select("asset_code", "motor_code", us("ts_slot").alias("slot_us"), *[r6(v).alias(v) for v in VARIABLES])


@query("round_pivot_mean", f"""WITH {SLOTS}, o AS (SELECT asset_code, motor_code, slot, variable, avg(value) AS value FROM t GROUP BY ALL)
SELECT asset_code, motor_code, slot AS slot_us, {WIDE} FROM o GROUP BY ALL""")
def round_pivot_mean(spark, folder):
    wide = grid.round_and_pivot(readings(spark, folder, K), STEP, VARIABLES, pick="mean")
    return wide.select("asset_code", "motor_code", us("ts_slot").alias("slot_us"), *[r6(v).alias(v) for v in VARIABLES])


SOURCES = [catalog.TO_SOURCE[v] for v in VARIABLES]


@query("pivot_renamed", f"WITH {MAX_MEAN} SELECT deployment_id, slot AS slot_us, {WIDE} FROM o GROUP BY deployment_id, slot")
def pivot_renamed(spark, folder):
    named = readings(spark, folder, K).withColumn("variable", catalog.source_of())
    slots = grid.collapse_max_or_mean(grid.with_floored_slot(named, STEP), context=("deployment_id",))
    wide = grid.rename_to_canonical(grid.pivot_wide(slots, columns=SOURCES))
    return wide.select("deployment_id", us("ts_slot").alias("slot_us"), *[r6(v).alias(v) for v in VARIABLES])


@query("unpivot_long", f"WITH {LAST} SELECT deployment_id, variable, slot AS slot_us, {sql_r6('value')} AS value FROM o WHERE value IS NOT NULL")
def unpivot_long(spark, folder):
    wide = grid.pivot_wide(_observed(spark, folder), columns=VARIABLES)
    return _long(grid.unpivot_long(wide, VARIABLES, keep_null=False))


@query("unpivot_codes", f"""WITH {LAST}, k AS (SELECT DISTINCT deployment_id, slot FROM o),
c AS (SELECT k.deployment_id, k.slot, v.variable FROM k, (SELECT unnest({VARIABLES}) AS variable) v)
SELECT c.deployment_id, c.variable, c.slot AS slot_us, {sql_r6('o.value')} AS value,
  CASE WHEN o.value IS NULL THEN 3 ELSE 0 END AS processing_code
FROM c LEFT JOIN o USING (deployment_id, slot, variable)""")
def unpivot_codes(spark, folder):
    wide = grid.pivot_wide(_observed(spark, folder), columns=VARIABLES)
    wide = wide.withColumns({f"{v}_code": F.when(F.col(v).isNull(), 3).otherwise(0) for v in VARIABLES})
    return _long(grid.unpivot_pairs(wide, VARIABLES, "_code", "processing_code", default=0), "processing_code")


@query("unpivot_flags", f"""WITH {LAST}, k AS (SELECT DISTINCT deployment_id, slot FROM o),
c AS (SELECT k.deployment_id, k.slot, v.variable FROM k, (SELECT unnest({VARIABLES}) AS variable) v)
SELECT c.deployment_id, c.variable, c.slot AS slot_us, {sql_r6('o.value')} AS value,
  c.variable <> 'output_power' AND coalesce(o.value < 100, false) AS is_imputed
FROM c LEFT JOIN o USING (deployment_id, slot, variable)""")
def unpivot_flags(spark, folder):
    """Values with their imputed flags; a flag that is missing, in one cell or a whole column, is False."""
    wide = grid.pivot_wide(_observed(spark, folder), columns=VARIABLES)
    flags = {f"{v}_is_imputed": F.lit(None).cast("boolean") if v == "output_power" else F.col(v) < 100 for v in VARIABLES}
    return _long(grid.unpivot_pairs(wide.withColumns(flags), VARIABLES, "_is_imputed", "is_imputed", default=False), "is_imputed")


@query("row_any_null", f"""WITH {LAST}, w AS (SELECT deployment_id, slot AS slot_us, {WIDE} FROM o GROUP BY deployment_id, slot)
SELECT deployment_id, slot_us, {' OR '.join(f'{v} IS NULL' for v in VARIABLES)} AS is_missing_general FROM w""")
def row_any_null(spark, folder):
    wide = grid.pivot_wide(_observed(spark, folder), columns=VARIABLES)
    return wide.select("deployment_id", us("ts_slot").alias("slot_us"), grid.any_null(VARIABLES).alias("is_missing_general"))


# --- filling -----------------------------------------------------------------------

RUN_LIMITED = f"""{GRID}, e AS (SELECT *, variable IN ('bearing_condition', 'total_run_time') AS carried,
  value IS NULL AND pslot IS NOT NULL AND {RUN} <= 2 AS fillable FROM n),
c AS (SELECT *, CASE WHEN value IS NOT NULL THEN 0 WHEN fillable AND carried THEN 2 WHEN fillable THEN 1 ELSE 3 END AS processing_code,
  CASE WHEN NOT fillable THEN value WHEN carried OR nslot IS NULL THEN pvalue ELSE {LINE} END AS filled FROM e)"""


@query("impute_run_limited", f"""WITH {RUN_LIMITED}
SELECT deployment_id, variable, slot AS slot_us, {sql_r6('filled')} AS value, processing_code::TINYINT AS processing_code FROM c""")
def impute_run_limited(spark, folder):
    return _long(impute.fill_short_runs(_completed(spark, folder)), "processing_code")


@query("processing_counts", f"""WITH {RUN_LIMITED}
SELECT processing_code::TINYINT AS processing_code,
  CASE processing_code WHEN 0 THEN 'original' WHEN 1 THEN 'imputed_linear' WHEN 2 THEN 'imputed_ffill' ELSE 'missing_not_imputed' END AS label,
  count(*) AS n, {sql_r6('count(*) * 100.0 / sum(count(*)) OVER ()')} AS percent FROM c GROUP BY processing_code""")
def processing_counts(spark, folder):
    filled = impute.fill_short_runs(_completed(spark, folder))
    counts = quality.code_counts(filled, "processing_code", catalog.PROCESSING_LABELS)
    return counts.withColumn("percent", r6("percent"))


@query("impute_limit_both", f"""WITH {GRID}
SELECT deployment_id, variable, slot AS slot_us, {sql_r6(f'''CASE WHEN value IS NOT NULL THEN value
  WHEN coalesce({BACK} <= 2, false) OR coalesce({AHEAD} <= 2, false)
  THEN CASE WHEN pslot IS NULL THEN nvalue WHEN nslot IS NULL THEN pvalue ELSE {LINE} END END''')} AS value FROM n""")
def impute_limit_both(spark, folder):
    return _long(impute.with_filled(_completed(spark, folder), impute.linear_both_ways()))


CARRIED = f"CASE WHEN value IS NOT NULL THEN value WHEN {BACK} <= 2 THEN pvalue WHEN {AHEAD} <= 2 THEN nvalue END"


@query("impute_ffill_bfill", f"""WITH {GRID}, c AS (SELECT *, {CARRIED} AS filled FROM n)
SELECT deployment_id, variable, slot AS slot_us, {sql_r6('filled')} AS value, value IS NULL AND filled IS NOT NULL AS is_imputed FROM c""")
def impute_ffill_bfill(spark, folder):
    return _long(impute.with_filled(_completed(spark, folder), impute.carry_both_ways()), "is_imputed")


BY_GROUP = f"""{GRID}, c AS (SELECT *, CASE WHEN variable IN ('bearing_condition', 'total_run_time') THEN {CARRIED}
  WHEN value IS NOT NULL THEN value
  WHEN coalesce({BACK} <= 2, false) OR coalesce({AHEAD} <= 2, false)
  THEN CASE WHEN pslot IS NULL THEN nvalue WHEN nslot IS NULL THEN pvalue ELSE {LINE} END END AS filled FROM n)"""


@query("impute_by_group", f"""WITH {BY_GROUP}
SELECT deployment_id, variable, slot AS slot_us, {sql_r6('filled')} AS value, value IS NULL AND filled IS NOT NULL AS is_imputed FROM c""")
def impute_by_group(spark, folder):
    return _long(impute.fill_by_group(_completed(spark, folder)), "is_imputed")


@query("imputed_share", f"""WITH {BY_GROUP}
SELECT count(*) AS cells, count(*) FILTER (value IS NULL AND filled IS NOT NULL) AS imputed,
  {sql_r6('count(*) FILTER (value IS NULL AND filled IS NOT NULL) * 100.0 / count(*)')} AS percent FROM c""")
def imputed_share(spark, folder):
    return impute.imputed_share(impute.fill_by_group(_completed(spark, folder))).withColumn("percent", r6("percent"))


@query("ffill_unlimited", f"WITH {GRID} SELECT deployment_id, variable, slot AS slot_us, {sql_r6('pvalue')} AS value FROM n")
def ffill_unlimited(spark, folder):
    return _long(impute.with_filled(_completed(spark, folder), impute.carry_forward()))


@query("null_runs", f"""WITH {GRID},
i AS (SELECT *, row_number() OVER (PARTITION BY deployment_id, variable ORDER BY slot)
  - row_number() OVER (PARTITION BY deployment_id, variable, value IS NULL ORDER BY slot) AS island FROM g)
SELECT deployment_id, variable, count(*) AS length, min(slot) AS start_us, max(slot) AS end_us
FROM i WHERE value IS NULL GROUP BY deployment_id, variable, island HAVING count(*) > 2""")
def null_runs(spark, folder):
    runs = impute.null_runs(_completed(spark, folder))
    return runs.select("deployment_id", "variable", "length", us("run_start").alias("start_us"), us("run_end").alias("end_us"))


@query("null_severe_grid", f"""WITH {sql_quality(K)},
z AS (SELECT *, {sql_slot('us', STEP)} AS slot, CASE WHEN NOT (is_invalid_physical OR is_invalid_category OR is_invalid_monotonic OR is_outlier OR is_missing) THEN value END AS kept FROM q),
o AS (SELECT deployment_id, variable, slot, max_by(kept, us) FILTER (kept IS NOT NULL) AS value FROM z GROUP BY ALL)
SELECT deployment_id, variable, slot AS slot_us, {sql_r6('value')} AS value FROM o""")
def null_severe_grid(spark, folder):
    kept = quality.null_severe(quality.detect(readings(spark, folder, K)))
    return _long(grid.collapse_last(grid.with_rounded_slot(kept, STEP), context=("deployment_id",)))
