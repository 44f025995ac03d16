"""Giving rows the numbers of their group without moving the rows by a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions.skew import SALT, spread_hot_keys

NAMES = catalog.spellings(catalog.CANONICAL_NAMES)


def with_group_columns(rows: DataFrame, table: DataFrame, keys: Sequence[str], names: Sequence[str], count: str, how: str = "inner") -> DataFrame:
    """`rows` with the columns `names` of `table`, which has one row per `keys` and their number in `count`.

    By variable alone: names of the catalogue are a bounded list, so their numbers are one map, a scalar
    of the plan that every task gets, and no row moves. All other names and keys take a side road: a
    join dealt out over salts, so that a key with any share of the rows is spread. `how` is 'inner'
    or 'left' (rows of groups without numbers are dropped or kept; those with a NULL key have none).
    """
    if list(keys) != ["variable"]:
        return _salted(rows, table, keys, names, count, how)
    known = f"coalesce(variable IN ({catalog.quoted(NAMES)}), false)"
    entries = F.map_from_entries(F.collect_list(F.struct("variable", F.struct(*names))))
    numbers = table.where(known).agg(entries.alias("_numbers")).scalar()
    inside = rows.where(known).withColumn("_found", F.try_element_at(numbers, F.col("variable")))
    inside = inside if how == "left" else inside.where("_found IS NOT NULL")
    inside = inside.withColumns({n: F.col(f"_found.{n}") for n in names}).drop("_found")
    return inside.unionByName(_salted(rows.where(f"NOT {known}"), table.where(f"NOT {known}"), keys, names, count, how))


def _salted(rows: DataFrame, table: DataFrame, keys: Sequence[str], names: Sequence[str], count: str, how: str) -> DataFrame:
    table = table.select(*keys, *names, F.col(count).alias("_rows"))
    by = "reading_id" if "reading_id" in rows.columns else "value" if "value" in rows.columns else rows.columns[0]
    rows, table = spread_hot_keys(rows, table, keys, by, "_rows")
    return rows.join(table.drop("_rows"), [*keys, SALT], how).drop(SALT)
