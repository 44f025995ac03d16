"""Exploratory summaries of readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions.lookup import with_group_columns
from sensorweave.functions.quantiles import exact_quantiles
from sensorweave.operators.quality import spread_stats

BY_VARIABLE = ("variable",)


def describe(df: DataFrame, keys: Sequence[str] = BY_VARIABLE, value: str = "value") -> DataFrame:
    """count, mean, std, min, quartiles, max per group."""
    basic = df.groupBy(*keys).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    return basic.join(exact_quantiles(df, keys, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}), list(keys), "left")


def describe_frame(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`describe` of several columns of a wide frame, one row per column."""
    return describe(df.unpivot([], list(columns), "variable", "value"))


def without_variables(df: DataFrame, excluded: Sequence[str]) -> DataFrame:
    return df.where(F.col("value").isNotNull() & ~F.col("variable").isin(catalog.spellings(list(excluded))))


def outlier_table(
    df: DataFrame,
    keys: Sequence[str] = BY_VARIABLE,
    factor: float = 3.0,
    excluded: Sequence[str] | None = None,
) -> DataFrame:
    """Spread per variable and how many values lie above q3 + `factor` x IQR (0 when none)."""
    excluded = catalog.canonical_names(catalog.CATEGORICAL) if excluded is None else excluded
    values = without_variables(df, excluded)
    stats = spread_stats(values, keys)
    upper = F.col("q3") + factor * F.col("iqr")
    above = (
        with_group_columns(values, stats, keys, ["q3", "iqr"], "count")
        .groupBy(*keys)
        .agg(F.count_if(F.col("value") > upper).alias("outliers_above"))
    )
    return stats.join(above, list(keys), "left").withColumn(
        "outliers_above", F.coalesce(F.col("outliers_above"), F.lit(0))
    )


def missing_ratio(grid: DataFrame, keys: Sequence[str] = BY_VARIABLE) -> DataFrame:
    """Share of NULL cells of a long grid; the same number as the NULL share of a wide column."""
    empty = F.avg(F.col("value").isNull().cast("double"))
    return grid.groupBy(*keys).agg(empty.alias("missing_ratio"))


def categorical_summary(df: DataFrame) -> DataFrame:
    """A row per value of a category variable: `n` rows with it, `count` of the variable, whether it is the
    most frequent one (the smallest on a tie).

    Two aggregates, by value and by variable; the second has a row for each name in the catalogue.
    """
    counted = value_counts(df.where(catalog.in_group(catalog.CATEGORICAL) & F.col("value").isNotNull()))
    whole = counted.groupBy("variable").agg(
        F.sum("n").alias("count"), F.max_by("value", F.struct(F.col("n"), -F.col("value"))).alias("_mode")
    )
    rows = counted.join(F.broadcast(whole), "variable")
    return rows.select("variable", "value", "n", "count", (F.col("value") == F.col("_mode")).alias("is_most_frequent"))


def value_counts(df: DataFrame, keys: Sequence[str] = BY_VARIABLE) -> DataFrame:
    return df.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))


def percentiles(
    df: DataFrame, keys: Sequence[str] = BY_VARIABLE, probs: dict[str, float] | None = None
) -> DataFrame:
    return exact_quantiles(df, keys, "value", probs or {"p50": 0.5, "p95": 0.95, "p99": 0.99})


def split_at_percentile(
    df: DataFrame, above: bool = False, prob: float = 0.99, keys: Sequence[str] = BY_VARIABLE
) -> DataFrame:
    """Rows at or below the percentile of their group, or the rows above it."""
    limit = exact_quantiles(df, keys, "value", {"_limit": prob}, "_rows")
    keep = F.col("value") > F.col("_limit") if above else F.col("value") <= F.col("_limit")
    return with_group_columns(df, limit, keys, ["_limit"], "_rows").where(keep).drop("_limit")


def histogram(df: DataFrame, keys: Sequence[str] = BY_VARIABLE, bins: int = 40) -> DataFrame:
    """Equal-width bins between minimum and maximum of the group; the last bin is closed."""
    values = df.where(F.col("value").isNotNull())
    span = values.groupBy(*keys).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count("value").alias("_rows"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    bin_no = F.least(F.floor(F.coalesce(F.try_divide(F.col("value") - F.col("_lo"), width), F.lit(0.0))), F.lit(bins - 1))
    counted = (
        with_group_columns(values, span, keys, ["_lo", "_hi"], "_rows").groupBy(*keys, "_lo", "_hi", bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    )
    return counted.select(
        *keys,
        "bin",
        (F.col("_lo") + F.col("bin") * width).alias("bin_start"),
        (F.col("_lo") + (F.col("bin") + 1) * width).alias("bin_end"),
        "n",
    )


def _whiskers(factor: float) -> tuple[Column, Column]:
    iqr = F.col("q3") - F.col("q1")
    return F.col("q1") - factor * iqr, F.col("q3") + factor * iqr


def boxplot(df: DataFrame, keys: Sequence[str] = BY_VARIABLE, factor: float = 1.5) -> DataFrame:
    """Quartiles, whiskers (extreme values within `factor` x IQR) and number of points beyond."""
    values = df.where(F.col("value").isNotNull())
    quartiles = exact_quantiles(values, keys, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75}, "_rows")
    low, high = _whiskers(factor)
    value = F.col("value")
    return (
        with_group_columns(values, quartiles, keys, ["q1", "median", "q3"], "_rows")
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(value >= low, value)).alias("whisker_low"),
            F.max(F.when(value <= high, value)).alias("whisker_high"),
            F.count_if((value < low) | (value > high)).alias("outliers"),
        )
    )


def boxplot_outliers(df: DataFrame, keys: Sequence[str] = BY_VARIABLE, factor: float = 1.5) -> DataFrame:
    """The rows beyond the whiskers."""
    quartiles = exact_quantiles(df, keys, "value", {"q1": 0.25, "q3": 0.75}, "_rows")
    low, high = _whiskers(factor)
    beyond = (F.col("value") < low) | (F.col("value") > high)
    return with_group_columns(df, quartiles, keys, ["q1", "q3"], "_rows").where(beyond).drop("q1", "q3")
