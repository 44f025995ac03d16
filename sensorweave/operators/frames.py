"""Operators on the wide frame: masks, rolling features, smoothing, ratios, scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave import catalog
from sensorweave.functions.ordered import (
    BLOCK,
    CHUNKING,
    core_rows,
    full_frame,
    with_blocks,
    with_chunks,
    with_position,
)
from sensorweave.functions.lookup import with_group_columns
from sensorweave.functions.quantiles import exact_quantiles
from sensorweave.functions.timeline import US, micros

KEYS = ("deployment_id",)
TIME = "ts_slot"


def numeric_columns(df: DataFrame, exclude: Sequence[str] = KEYS) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def vibration_columns(df: DataFrame) -> list[str]:
    """Columns named after a vibration signal, derived ones included."""
    return [c for c in df.columns if "vibration" in c or "acc_rms" in c]


def _blocks(df: DataFrame, back: int, ahead: int, step_s: int | None) -> DataFrame:
    """Blocks of rows with `back`/`ahead` rows of their neighbours; adds `_pos`, `_block`, `_core`.

    With `step_s` the frame must have every slot between its first and last: the position
    is the slot number and costs nothing. Without, it is the rank of the row.
    """
    if step_s is None:
        ranked = with_position(with_chunks(df, KEYS, TIME, "frameSeconds"), KEYS, [TIME]).drop(*CHUNKING)
    else:
        ranked = df.withColumn("_pos", (micros(TIME) / (step_s * US)).cast("long"))
    return with_blocks(ranked, F.col("_pos"), back, ahead)


def _series():
    return Window.partitionBy(*KEYS, BLOCK).orderBy("_pos")


def _finish(df: DataFrame) -> DataFrame:
    return core_rows(df).drop("_pos")


# --- masks -------------------------------------------------------------------------

def mask_outside_iqr(df: DataFrame, columns: Sequence[str] | None = None, factor: float = catalog.IQR_FACTOR) -> DataFrame:
    """NULL wide values further than `factor` x IQR from the quartiles of their column.

    Counters are left alone unless named. All columns go through one quantile pass.
    """
    counters = catalog.canonical_names(catalog.ACCUMULATIVE)
    columns = [c for c in (columns or numeric_columns(df)) if columns or c not in counters]
    cells = df.unpivot(list(KEYS), columns, "variable", "value")
    quartiles = exact_quantiles(cells, [*KEYS, "variable"], "value", {"q1": 0.25, "q3": 0.75}, "_rows")
    # one row per deployment, one map entry per column
    limits = quartiles.groupBy(*KEYS).agg(
        F.map_from_entries(F.collect_list(F.struct("variable", F.struct("q1", "q3")))).alias("_limits"), F.max("_rows").alias("_rows")
    )

    def masked(name: str) -> Column:
        quartile = F.col("_limits")[name]
        reach = (quartile["q3"] - quartile["q1"]) * factor
        inside = (F.col(name) >= quartile["q1"] - reach) & (F.col(name) <= quartile["q3"] + reach)
        return F.when(inside, F.col(name))

    return with_group_columns(df, limits, KEYS, ["_limits"], "_rows", "left").withColumns({c: masked(c) for c in columns}).drop("_limits")


def mask_series_outside_iqr(df: DataFrame, factor: float = catalog.IQR_FACTOR, skip: Column | None = None) -> DataFrame:
    """Long form of the IQR mask: per (deployment, variable), counters skipped by default."""
    keys = ["deployment_id", "variable"]
    skip = catalog.in_group(catalog.ACCUMULATIVE) if skip is None else skip
    quartiles = exact_quantiles(df.where(~skip), keys, "value", {"q1": 0.25, "q3": 0.75}, "_rows")
    reach = (F.col("q3") - F.col("q1")) * factor
    value = F.col("value")
    beyond = (value < F.col("q1") - reach) | (value > F.col("q3") + reach)
    joined = with_group_columns(df, quartiles, keys, ["q1", "q3"], "_rows", "left")
    return joined.withColumn("value", F.when(~F.coalesce(beyond, F.lit(False)), value)).drop("q1", "q3")


# --- frames of rows ----------------------------------------------------------------

def _rolled(columns: Sequence[str], rows: int) -> dict[str, Column]:
    frame = _series().rowsBetween(1 - rows, 0)
    stats = {"MEAN": F.avg, "STD": F.stddev_samp, "MAX": F.max}
    return {f"{c}_{name}_W{rows}": full_frame(fn, F.col(c), frame, rows) for c in columns for name, fn in stats.items()}


def _step(column: str) -> Column:
    return F.col(column) - F.lag(column).over(_series())


def rolling_features(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    rows: int = catalog.ROLLING_ROWS,
    step_s: int | None = None,
) -> DataFrame:
    """Rolling mean, std and max of the vibration columns over full frames of `rows` values."""
    columns = list(columns or vibration_columns(df))
    return _finish(_blocks(df, rows - 1, 0, step_s).withColumns(_rolled(columns, rows)))


def smooth(
    df: DataFrame, widths: Mapping[str, int] | None = None, step_s: int | None = None, width: int | None = 3
) -> DataFrame:
    """Centred moving average `<column>_SMOOTH`, NULL at the edges; `width=None` uses per-column widths."""
    widths = {c: width or w for c, w in (widths or catalog.SMOOTH_ROWS).items() if c in df.columns}
    half = max(widths.values()) // 2

    def average(column: str, rows: int) -> Column:
        frame = _series().rowsBetween(-(rows // 2), rows - 1 - rows // 2)
        return full_frame(F.avg, F.col(column), frame, rows)

    smoothed = {f"{c}_SMOOTH": average(c, rows) for c, rows in widths.items()}
    return _finish(_blocks(df, half, half, step_s).withColumns(smoothed))


def difference(df: DataFrame, column: str = "skin_temp", step_s: int | None = None) -> DataFrame:
    """`<column>_DELTA`: change since the previous row."""
    return _finish(_blocks(df, 1, 0, step_s).withColumn(f"{column}_DELTA", _step(column)))


# --- expressions on one row --------------------------------------------------------

def axial_radial_ratio() -> Column:
    """NULL where the radial value is 0."""
    return F.try_divide(F.col("acc_rms_axial"), F.col("acc_rms_radial"))


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of the non-NULL cells of the row."""
    zero = F.lit(0.0)
    total = sum((F.coalesce(F.col(c), zero) for c in columns), zero)
    present = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return F.try_divide(total, present)


def with_ratios(df: DataFrame) -> DataFrame:
    columns = vibration_columns(df)
    if {"acc_rms_axial", "acc_rms_radial"} <= set(df.columns):
        df = df.withColumn("Ratio_Axial_Radial", axial_radial_ratio())
    return df.withColumn("Vib_Energy_Total", row_mean(columns)) if columns else df


def with_top(df: DataFrame, column: str = "total_run_time") -> DataFrame:
    """`_top`: the largest value of the column in the deployment."""
    return with_group_columns(df, df.groupBy(*KEYS).agg(F.max(column).alias("_top"), F.count(F.lit(1)).alias("_rows")), KEYS, ["_top"], "_rows", "left")


def with_life_proxy(df: DataFrame, column: str = "total_run_time") -> DataFrame:
    """Running time relative to the largest of the deployment."""
    return with_top(df, column).withColumn("RUL_Proxy", F.try_divide(F.col(column), F.col("_top"))).drop("_top")


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna(how="any")


def engineer(df: DataFrame, rows: int = catalog.ROLLING_ROWS, step_s: int | None = None) -> DataFrame:
    """Rolling features, ratios, temperature change, life proxy; complete rows only.

    All features that look at earlier rows share one cut into blocks.
    """
    top = "total_run_time" in df.columns
    blocks = _blocks(with_top(df) if top else df, rows - 1, 0, step_s)
    derived = _rolled(vibration_columns(df), rows)
    if "skin_temp" in df.columns:
        derived["skin_temp_DELTA"] = _step("skin_temp")
    if top:
        derived["RUL_Proxy"] = F.try_divide(F.col("total_run_time"), F.col("_top"))
    return drop_incomplete(with_ratios(_finish(blocks.withColumns(derived)).drop("_top")))


# --- standardisation ---------------------------------------------------------------

def fit_scaler(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation per column: one aggregate, one row to the driver."""
    columns = list(columns or numeric_columns(df))
    moments = [F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c) for c in columns]
    row = df.agg(*moments).first()
    return {c: (row[c]["mean"], row[c]["std"]) for c in columns}


def apply_scaler(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(value - mean) / std; a constant column is only centred."""
    scaled = {c: (F.col(c) - F.lit(mean)) / F.lit(std or 1.0) for c, (mean, std) in scaler.items()}
    return df.withColumns(scaled)


def save_scaler(spark: SparkSession, scaler: Mapping[str, tuple[float, float]], path: str) -> None:
    rows = [(c, mean, std) for c, (mean, std) in scaler.items()]
    spark.createDataFrame(rows, "column string, mean double, std double").coalesce(1).write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> dict[str, tuple[float, float]]:
    return {r["column"]: (r["mean"], r["std"]) for r in spark.read.parquet(path).collect()}
