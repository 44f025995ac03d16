"""Connected components of link tables that may be far larger than a driver.

Each round hooks every node to its smallest neighbour, follows the hooks to their ends, and keeps
only links between different ends. Stars collapse in one round, chains shrink by a factor each
round. All minima combine on the map side; every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.llm.common import cut


def _followed(hooks: DataFrame) -> DataFrame:
    """`hooks` (node, up) with `up` the end of the chain."""
    while True:
        above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
        step = cut(hooks.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "hooks")
        hooks = step.select("node", "up")
        if step.where("moved").isEmpty():
            return hooks


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that is not the smallest of its component.

    `component` is the smallest node reachable. Nodes without a link, and smallest nodes, have no row.
    """
    pair = (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    links = cut(links.where(F.col(a) != F.col(b)).select(*pair).distinct(), "links")
    labels = None
    while not links.isEmpty():
        hooks = links.select(F.col("b").alias("node"), F.col("a").alias("up")).groupBy("node").agg(F.min("up").alias("up"))
        hooks = _followed(hooks)
        if labels is None:
            labels = hooks.select("node", F.col("up").alias("component"))
        else:
            above = hooks.select(F.col("node").alias("component"), "up")
            moved = labels.join(above, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
            labels = cut(moved.union(hooks), "labels")
        for side in ("a", "b"):
            ends = hooks.select(F.col("node").alias(side), "up")
            links = links.join(ends, side, "left").withColumn(side, F.coalesce("up", side)).drop("up")
        links = cut(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
