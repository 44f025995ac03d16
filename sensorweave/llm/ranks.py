"""Positions of rows in a total order, by group, without a task that sees a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.llm.common import cut

PLACE_BITS = 33  # of a monotonically increasing id: the rows of a partition


def ranked(df: DataFrame, group: str, order: Sequence[Column], label: str) -> DataFrame:
    """`df` with `rank` (0-based, by `order` within `group`) and `size` (rows of the group).

    The rows are range-partitioned by (group, order) and written once in that order, so a group of
    any size lies in as many partitions as its share asks for; rows equal in everything are dealt out
    by their place in the input. The table of offsets has one row per partition and one more per
    group that begins inside a partition; it is written, so Spark knows its size before it joins.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(group), *order, F.col("_tie")]
    rows = df.withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
    rows = cut(rows.withColumn("_place", F.monotonically_increasing_id()), label)
    rows = rows.withColumn("_part", F.shiftright("_place", PLACE_BITS))
    tally = rows.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    whole = Window.partitionBy(group)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    tally = cut(tally.select(F.col(group).alias("_group"), F.col("_part").alias("_at"), base.alias("_base"), F.sum("_rows").over(whole).alias("size")), f"{label}-offsets")
    same = rows[group].eqNullSafe(tally["_group"]) & (rows["_part"] == tally["_at"])
    return rows.join(tally, same).withColumn("rank", F.col("_place") + F.col("_base")).drop("_place", "_part", "_group", "_at", "_base")
