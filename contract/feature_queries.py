"""Feature windows and wide-frame features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from contract.inputs import VARIABLES, machine_frame, readings, table
from contract.registry import query, r6, sql_floor, sql_grid, sql_quality, sql_r6, sql_readings, us
from sensorweave import catalog
from sensorweave.operators import frames, grid, impute, quality, windows
from sensorweave.session import materialise, shared_folder

K, WINDOW_S, EXPECTED_S = 4, 28_800, 7_200
WINDOW_US = WINDOW_S * 1_000_000

WINDOWS = f"""{sql_quality(K, EXPECTED_S)},
sig AS (SELECT *, min(us) OVER (PARTITION BY deployment_id) AS t0, max(us) OVER (PARTITION BY deployment_id) AS t1 FROM q WHERE variable = 'acc_rms_radial'),
k AS (SELECT *, (us - t0) // {WINDOW_US} AS window_no, quality_code = 0 AND value IS NOT NULL AS good FROM sig),
wn AS (SELECT deployment_id, window_no, avg(value) FILTER (good) AS mean, coalesce(stddev_samp(value) FILTER (good), 0) AS std,
    min(value) FILTER (good) AS min, max(value) FILTER (good) AS max, sqrt(avg(value * value) FILTER (good)) AS rms_window,
    (count(*) FILTER (good))::DOUBLE AS count_samples, max(us) AS ts_us, max(quality_code) AS quality_code,
    list(value ORDER BY us, reading_id) FILTER (good) AS vals
  FROM k WHERE t0 + window_no * {WINDOW_US} < t1
  GROUP BY deployment_id, window_no HAVING count(*) FILTER (good) >= 4 AND NOT bool_or(is_gap)),
ce AS (SELECT *, list_transform(vals, lambda v: v - mean) AS c, len(vals) AS n FROM wn),
sp AS (SELECT *, list_transform(range(0, n // 2 + 1), lambda b:
    pow(list_sum(list_transform(c, lambda v, i: v * cos(2 * pi() * b * (i - 1) / n))), 2)
    + pow(list_sum(list_transform(c, lambda v, i: v * sin(2 * pi() * b * (i - 1) / n))), 2)) AS power FROM ce),
ft AS (SELECT *, sqrt(list_max(power[2:])) AS fft_peak_amp, list_position(power[2:], list_max(power[2:]))::DOUBLE AS fft_peak_bin,
    list_sum(power) AS fft_energy_total FROM sp)"""
NAMES = windows.TIME_FEATURES + windows.SPECTRAL_FEATURES


def flagged(spark, folder):
    """The flagged readings as a written table: features and data sets read it several times."""
    return materialise(quality.detect(readings(spark, folder, K), expected_s=EXPECTED_S), "flagged")


def _windows(spark, folder, spectrum="native"):
    return windows.window_features(flagged(spark, folder), WINDOW_S, spectrum=spectrum)


@query("window_features", f"WITH {WINDOWS} " + " UNION ALL ".join(
    f"SELECT deployment_id, ts_us, 'acc_rms_radial' AS variable, '{n}' AS feature, {sql_r6(n)} AS value, {WINDOW_S} AS window_s, quality_code FROM ft" for n in NAMES))
def window_features(spark, folder):
    long = windows.features_long(_windows(spark, folder))
    return long.select("deployment_id", us("ts_utc").alias("ts_us"), "variable", "feature", r6("value").alias("value"), "window_s", "quality_code")


@query("window_spectrum", f"""WITH {WINDOWS} SELECT deployment_id, window_no, {', '.join(f'{sql_r6(n)} AS {n}' for n in windows.SPECTRAL_FEATURES)} FROM ft""")
def window_spectrum(spark, folder):
    return _windows(spark, folder).select("deployment_id", "window_no", *[r6(n).alias(n) for n in windows.SPECTRAL_FEATURES])


@query("window_spectrum_arrow", f"""WITH {WINDOWS} SELECT deployment_id, window_no, {', '.join(f'{sql_r6(n)} AS {n}' for n in windows.SPECTRAL_FEATURES)} FROM ft""")
def window_spectrum_arrow(spark, folder):
    found = _windows(spark, folder, "arrow")
    return found.select("deployment_id", "window_no", *[r6(n).alias(n) for n in windows.SPECTRAL_FEATURES])


# --- wide frame --------------------------------------------------------------------

MACHINE = """m AS (SELECT l_suppkey AS deployment_id, epoch_us(l_shipdate) AS slot_us, sum(round(l_extendedprice * 100)::BIGINT)::DOUBLE / (count(*) * 99991::DOUBLE) AS acc_rms_axial,
  CASE WHEN day(l_shipdate) = 1 THEN 0.0::DOUBLE ELSE avg(l_quantity) END AS acc_rms_radial, min(l_discount) AS vibration_axial,
  max(l_tax) AS skin_temp, max(l_orderkey)::DOUBLE AS total_run_time FROM lineitem GROUP BY l_suppkey, l_shipdate)"""
VIB_COLUMNS = ["acc_rms_axial", "acc_rms_radial", "vibration_axial"]
ROLLED = ", ".join(
    f"CASE WHEN count({c}) OVER w = 12 THEN {fn}({c}) OVER w END AS {c}_{name}_W12"
    for c in VIB_COLUMNS for name, fn in (("MEAN", "avg"), ("STD", "stddev_samp"), ("MAX", "max"))
)
ROLLED_NAMES = [f"{c}_{name}_W12" for c in VIB_COLUMNS for name in ("MEAN", "STD", "MAX")]
FRAME = "WINDOW w AS (PARTITION BY deployment_id ORDER BY slot_us ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"


def _show(df, names):
    return df.select("deployment_id", us("ts_slot").alias("slot_us"), *[r6(c).alias(c) for c in names])


def _rounded(names):
    return ", ".join(f"{sql_r6(n)} AS {n}" for n in names)


@query("rolling_features", f"WITH {MACHINE}, x AS (SELECT *, {ROLLED} FROM m {FRAME}) SELECT deployment_id, slot_us, {_rounded(ROLLED_NAMES)} FROM x")
def rolling_features(spark, folder):
    return _show(frames.rolling_features(machine_frame(spark, folder)), ROLLED_NAMES)


@query("ratio_energy", f"""WITH {MACHINE} SELECT deployment_id, slot_us, {sql_r6('CASE WHEN acc_rms_radial <> 0 THEN acc_rms_axial / acc_rms_radial END')} AS Ratio_Axial_Radial,
  {sql_r6('(acc_rms_axial + acc_rms_radial + vibration_axial) / 3')} AS Vib_Energy_Total FROM m""")
def ratio_energy(spark, folder):
    return _show(frames.with_ratios(machine_frame(spark, folder)), ["Ratio_Axial_Radial", "Vib_Energy_Total"])


@query("delta_rul", f"""WITH {MACHINE} SELECT deployment_id, slot_us, {sql_r6('skin_temp - lag(skin_temp) OVER (PARTITION BY deployment_id ORDER BY slot_us)')} AS skin_temp_DELTA,
  {sql_r6('total_run_time / max(total_run_time) OVER (PARTITION BY deployment_id)')} AS RUL_Proxy FROM m""")
def delta_rul(spark, folder):
    df = frames.with_life_proxy(frames.difference(machine_frame(spark, folder)))
    return _show(df, ["skin_temp_DELTA", "RUL_Proxy"])


ENGINEERED = ROLLED_NAMES + ["Ratio_Axial_Radial", "Vib_Energy_Total", "skin_temp_DELTA", "RUL_Proxy"]


@query("engineered_features", f"""WITH {MACHINE}, x AS (SELECT *, {ROLLED},
  skin_temp - lag(skin_temp) OVER (PARTITION BY deployment_id ORDER BY slot_us) AS skin_temp_DELTA,
  total_run_time / max(total_run_time) OVER (PARTITION BY deployment_id) AS RUL_Proxy,
  CASE WHEN acc_rms_radial <> 0 THEN acc_rms_axial / acc_rms_radial END AS Ratio_Axial_Radial FROM m {FRAME}),
y AS (SELECT *, ({' + '.join(VIB_COLUMNS + ROLLED_NAMES)}) / {len(VIB_COLUMNS + ROLLED_NAMES)} AS Vib_Energy_Total FROM x)
SELECT deployment_id, slot_us, {_rounded(ENGINEERED)} FROM y WHERE {' AND '.join(f'{c} IS NOT NULL' for c in ENGINEERED)}""")
def engineered_features(spark, folder):
    return _show(frames.engineer(machine_frame(spark, folder)), ENGINEERED)


@query("iqr_mask", f"""WITH {MACHINE}, s AS (SELECT deployment_id, {', '.join(f'quantile_cont({c}, 0.25) AS {c}_1, quantile_cont({c}, 0.75) AS {c}_3' for c in VIB_COLUMNS)} FROM m GROUP BY deployment_id)
SELECT deployment_id, slot_us, {', '.join(f"{sql_r6(f'CASE WHEN {c} BETWEEN {c}_1 - 0.5 * ({c}_3 - {c}_1) AND {c}_3 + 0.5 * ({c}_3 - {c}_1) THEN {c} END')} AS {c}" for c in VIB_COLUMNS)},
  {sql_r6('total_run_time')} AS total_run_time FROM m JOIN s USING (deployment_id)""")
def iqr_mask(spark, folder):
    masked = frames.mask_outside_iqr(machine_frame(spark, folder), factor=0.5)
    return _show(masked, [*VIB_COLUMNS, "total_run_time"])


SMOOTH_STEP = 3600
SMOOTH = f"""{sql_readings(2)}, o AS (SELECT deployment_id, variable, {sql_floor('us', SMOOTH_STEP)} AS slot, avg(value) AS value FROM r GROUP BY ALL),
{sql_grid('o', SMOOTH_STEP)},
x AS (SELECT deployment_id, variable, slot, pvalue AS value FROM n WHERE variable = 'acc_rms_radial')"""


@query("smooth", f"""WITH {SMOOTH} SELECT deployment_id, slot AS slot_us, {sql_r6('value')} AS acc_rms_radial,
  {sql_r6('CASE WHEN count(value) OVER w = 3 THEN avg(value) OVER w END')} AS acc_rms_radial_SMOOTH
FROM x WINDOW w AS (PARTITION BY deployment_id ORDER BY slot ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING)""")
def smooth(spark, folder):
    filled = impute.with_filled(grid.resample_mean(readings(spark, folder, 2), SMOOTH_STEP), impute.carry_forward())
    wide = grid.pivot_wide(filled, columns=VARIABLES)
    return _show(frames.smooth(wide, step_s=SMOOTH_STEP), ["acc_rms_radial", "acc_rms_radial_SMOOTH"])


@query("standardise", f"""WITH s AS (SELECT avg(l_quantity) AS am, stddev_pop(l_quantity) AS asd, avg(l_extendedprice) AS bm, stddev_pop(l_extendedprice) AS bsd FROM lineitem)
SELECT l_orderkey, l_linenumber, {sql_r6('(l_quantity - am) / asd')} AS l_quantity, {sql_r6('(l_extendedprice - bm) / bsd')} AS l_extendedprice, 0.0::DOUBLE AS constant
FROM lineitem, s""")
def standardise(spark, folder):
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.lit(7.0).alias("constant"))
    columns = ["l_quantity", "l_extendedprice", "constant"]
    scaled = frames.apply_scaler(items, frames.fit_scaler(items, columns))
    return scaled.withColumns({c: r6(c) for c in columns})


@query("standardise_reused", f"""WITH s AS (SELECT avg(l_quantity) AS am, stddev_pop(l_quantity) AS asd, avg(l_extendedprice) AS bm, stddev_pop(l_extendedprice) AS bsd FROM lineitem WHERE l_orderkey % 2 = 0)
SELECT l_orderkey, l_linenumber, {sql_r6('(l_quantity - am) / asd')} AS l_quantity, {sql_r6('(l_extendedprice - bm) / bsd')} AS l_extendedprice FROM lineitem, s WHERE l_orderkey % 2 = 1""")
def standardise_reused(spark, folder):
    """A scaler fitted to half of the orders, stored, loaded and applied to the others."""
    columns = ["l_quantity", "l_extendedprice"]
    items = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    path = f"{shared_folder(spark)}/scaler-{uuid.uuid4().hex}"
    frames.save_scaler(spark, frames.fit_scaler(items.where("l_orderkey % 2 = 0"), columns), path)
    scaled = frames.apply_scaler(items.where("l_orderkey % 2 = 1"), frames.load_scaler(spark, path))
    return scaled.withColumns({c: r6(c) for c in columns})


def _average(column: str, rows: int) -> str:
    frame = f"(PARTITION BY deployment_id ORDER BY slot_us ROWS BETWEEN {rows // 2} PRECEDING AND {rows - 1 - rows // 2} FOLLOWING)"
    return f"CASE WHEN count({column}) OVER {frame} = {rows} THEN avg({column}) OVER {frame} END"


WIDTHS = {c: w for c, w in catalog.SMOOTH_ROWS.items() if c in (*VIB_COLUMNS, "skin_temp")}


@query("smooth_widths", f"""WITH {MACHINE}, x AS (SELECT deployment_id, slot_us, {', '.join(f'{_average(c, w)} AS {c}_SMOOTH' for c, w in WIDTHS.items())} FROM m)
SELECT deployment_id, slot_us, {_rounded([f'{c}_SMOOTH' for c in WIDTHS])} FROM x""")
def smooth_widths(spark, folder):
    """Centred averages of the widths that the catalogue gives each column."""
    return _show(frames.smooth(machine_frame(spark, folder), width=None), [f"{c}_SMOOTH" for c in WIDTHS])
