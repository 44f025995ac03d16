"""Running totals in a total order, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave.session import materialise

PLACE_BITS = 33  # of a monotonically increasing id: the rows of a partition


def running_totals(df: DataFrame, order: Sequence[Column], sums: Sequence[str]) -> DataFrame:
    """Per entry `x` of `sums`: `_upto<x>`, its sum over all rows up to this one, and `_all<x>`.

    Range partitions follow the row counts; they are written once, so that rows keep their places, and
    summed. The sums of the partitions (a row for each, so `spark.sql.shuffle.partitions` rows at
    most) are added up and broadcast; inside a partition a window adds the rest. Rows of equal order
    come in any order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    rows = materialise(rows.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    rows = rows.withColumn("_part", F.shiftright("_place", PLACE_BITS))
    per = rows.groupBy("_part").agg(*[F.sum(c).alias(f"_part{c}") for c in sums])
    whole = Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.coalesce(F.sum(f"_part{c}").over(earlier), F.lit(0)).alias(f"_before{c}") for c in sums]
    per = per.select("_part", *before, *[F.sum(f"_part{c}").over(whole).alias(f"_all{c}") for c in sums])
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(F.broadcast(per), "_part")
    rows = rows.withColumns({f"_upto{c}": F.col(f"_before{c}") + F.sum(c).over(inside) for c in sums})
    return rows.drop("_place", "_part", *[f"_before{c}" for c in sums])
