"""Table schemas and value coercion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

READINGS = T.StructType([
    T.StructField("reading_id", T.LongType()),
    T.StructField("asset_code", T.StringType()),
    T.StructField("motor_code", T.StringType()),
    T.StructField("ts_utc", T.TimestampType()),
    T.StructField("ts_local", T.TimestampType()),
    T.StructField("variable", T.StringType()),
    T.StructField("value", T.StringType()),
])

MEASUREMENTS = T.StructType([
    T.StructField("deployment_id", T.LongType()),
    T.StructField("ts_utc", T.TimestampType()),
    T.StructField("variable", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("quality_code", T.IntegerType()),
])

FEATURES = T.StructType([
    T.StructField("deployment_id", T.LongType()),
    T.StructField("ts_utc", T.TimestampType()),
    T.StructField("variable", T.StringType()),
    T.StructField("feature", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("window_s", T.IntegerType()),
    T.StructField("quality_code", T.IntegerType()),
])


def to_number(value: Column) -> Column:
    """Double value of a number or a text; NULL for NaN and for text that is no number."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def with_numeric_value(df: DataFrame, column: str = "value") -> DataFrame:
    return df.withColumn(column, to_number(F.col(column)))


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
