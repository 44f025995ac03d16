"""Duplicate readings: keep one per key, count them, list them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.functions.skew import SALT, spread_hot_keys

READING_KEY = ("asset_code", "motor_code", "ts_utc", "variable")
READING_ORDER = ("ts_utc", "reading_id")


def keep_one(
    df: DataFrame,
    keys: Sequence[str] = READING_KEY,
    order: Sequence[str] = READING_ORDER,
    keep: str = "last",
) -> DataFrame:
    """One row per key: the last (or first) by `order`.

    An aggregate, not a ranking window: copies of one key are reduced before the shuffle,
    however many there are.
    """
    pick = {"last": F.max_by, "first": F.min_by}[keep]
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_row"))
    return kept.select(*keys, "_row.*").select(*df.columns)


def copies_per_key(df: DataFrame, keys: Sequence[str] = READING_KEY) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_report(df: DataFrame, keys: Sequence[str] = READING_KEY) -> DataFrame:
    """One row: all rows, keys, rows in duplicate groups, rows a dedupe removes."""
    n = F.col("n")
    return copies_per_key(df, keys).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("rows_in_groups"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("rows_removed"),
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str] = READING_KEY, by: str = "reading_id") -> DataFrame:
    """All members of every key that occurs more than once."""
    # missing values are equal to each other: a key is joined as its text and whether it is missing
    named = [f"_key{i}" for i in range(len(keys))]
    marked = df.withColumns({n: F.coalesce(F.col(k).cast("string"), F.lit("")) for n, k in zip(named, keys)})
    marked = marked.withColumns({f"{n}_missing": F.col(k).isNull() for n, k in zip(named, keys)})
    on = [*named, *[f"{n}_missing" for n in named]]
    repeated = copies_per_key(marked, on).where("n > 1")
    rows, repeated = spread_hot_keys(marked, repeated, on, by)
    return rows.join(repeated, [*on, SALT], "left_semi").select(*df.columns)
