"""Filling short gaps on a regular grid, with an audit code per cell.

Every function works on the output of `grid.complete_grid`: each slot already knows the
nearest known value on either side, so a fill is an expression on one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.operators.grid import FILL_CONTEXT


def _value() -> Column:
    return F.col("value")


def _pos() -> Column:
    return F.col("_pos")


def _before(field: str | None = None) -> Column:
    return F.col(f"_before.{field}" if field else "_before")


def _after(field: str | None = None) -> Column:
    return F.col(f"_after.{field}" if field else "_after")


def _empty() -> Column:
    return _value().isNull()


ORIGINAL, LINEAR, FORWARD, UNFILLED = 0, 1, 2, 3


def run_length() -> Column:
    """Length of the NULL run the slot lies in; a leading run counts from before the grid."""
    run_end = F.coalesce(_after("pos"), F.col("_last") + 1)
    return run_end - _before("pos") - 1


def on_line() -> Column:
    """Value on the straight line between the known neighbours."""
    share = (_pos() - _before("pos")) / (_after("pos") - _before("pos"))
    return _before("value") + (_after("value") - _before("value")) * share


def fill_short_runs(df: DataFrame, limit: int = catalog.IMPUTE_LIMIT, strategy: Column | None = None) -> DataFrame:
    """Fill whole NULL runs of at most `limit` slots; leave longer and leading runs alone.

    Linear variables are interpolated (a run at the end takes the last value), the others
    take the last value. `processing_code`: 0 original, 1 linear, 2 carried, 3 still NULL.
    """
    strategy = catalog.strategy_of() if strategy is None else strategy
    fillable = _empty() & (run_length() <= limit)
    linear = strategy == "linear"
    filled = F.when(linear & _after().isNotNull(), on_line()).otherwise(_before("value"))
    code = (
        F.when(~_empty(), ORIGINAL)
        .when(fillable & linear, LINEAR)
        .when(fillable, FORWARD)
        .otherwise(UNFILLED)
    )
    return df.withColumn("processing_code", code.cast("tinyint")).withColumn(
        "value", F.when(fillable, filled).otherwise(_value())
    )


def _near(limit: int) -> tuple[Column, Column]:
    """Is the known value before / after the slot within `limit` slots?"""
    return (
        F.coalesce(_pos() - _before("pos") <= limit, F.lit(False)),
        F.coalesce(_after("pos") - _pos() <= limit, F.lit(False)),
    )


def linear_both_ways(limit: int = catalog.IMPUTE_LIMIT) -> Column:
    """Interpolated value for up to `limit` slots at each end of every run; nearest value outside."""
    near_before, near_after = _near(limit)
    line = F.when(_before().isNull(), _after("value")).when(_after().isNull(), _before("value")).otherwise(on_line())
    return F.when(~_empty(), _value()).when(near_before | near_after, line)


def carry_both_ways(limit: int = catalog.IMPUTE_LIMIT) -> Column:
    """Last value for up to `limit` slots, then the next value for up to `limit` slots."""
    near_before, near_after = _near(limit)
    return F.when(~_empty(), _value()).when(near_before, _before("value")).when(near_after, _after("value"))


def carry_forward() -> Column:
    """Last known value, however old."""
    return F.coalesce(_value(), _before("value"))


def with_filled(df: DataFrame, filled: Column) -> DataFrame:
    """Replace the value and mark the cells that were NULL and now are not."""
    return (
        df.withColumn("_filled", filled)
        .withColumn("is_imputed", _empty() & F.col("_filled").isNotNull())
        .withColumn("value", F.col("_filled"))
        .drop("_filled")
    )


def fill_by_group(df: DataFrame, limit: int = catalog.IMPUTE_LIMIT) -> DataFrame:
    """Interpolate vibration and physical variables, carry categories and counters, leave others."""
    variable = F.col("variable")
    filled = (
        F.when(catalog.in_group(catalog.VIBRATION, catalog.PHYSICAL), linear_both_ways(limit))
        .when(catalog.in_group(catalog.CATEGORICAL, catalog.ACCUMULATIVE), carry_both_ways(limit))
        .otherwise(_value())
    )
    return with_filled(df, filled)


def null_runs(df: DataFrame, longer_than: int = catalog.IMPUTE_LIMIT) -> DataFrame:
    """NULL runs of the unfilled grid longer than the limit: length, first and last slot.

    A run is identified by the known slot before it, so this is a plain aggregate. When the
    frame carries processing codes, their counts inside the run are reported too.
    """
    codes = []
    if "processing_code" in df.columns:
        codes = [
            F.count_if(F.col("processing_code") == c).alias(f"n_{label}")
            for c, label in catalog.PROCESSING_LABELS.items()
        ]
    return (
        df.where(_empty())
        .groupBy("deployment_id", "variable", _before("pos").alias("_run"))
        .agg(
            F.count(F.lit(1)).alias("length"),
            F.min("ts_slot").alias("run_start"),
            F.max("ts_slot").alias("run_end"),
            *codes,
        )
        .where(F.col("length") > longer_than)
        .drop("_run")
    )


def drop_context(df: DataFrame) -> DataFrame:
    return df.drop(*FILL_CONTEXT)


def imputed_share(df: DataFrame) -> DataFrame:
    """One row: cells, imputed cells and their share."""
    totals = df.agg(F.count(F.lit(1)).alias("cells"), F.count_if("is_imputed").alias("imputed"))
    return totals.withColumn("percent", F.try_divide(F.col("imputed") * 100.0, F.col("cells")))
