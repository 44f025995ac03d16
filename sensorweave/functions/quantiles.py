"""Exact quantiles of groups of any size.

The built-in exact `percentile` keeps every distinct value of a group in one task, and a
sketch of a group that every input task contributes to is merged in one. Here a mergeable
histogram brackets the wanted ranks, and the values inside the brackets are counted exactly:

1. Histogram: rows per (group, bin). A bin is `BINS`-th of a doubling on a signed log scale, the
   same for all data, so the histogram needs no look at the data before it, combines on the map
   side and is summed by (group, bin), not by group. Running counts over the bins of a group (as
   many as its doublings times `BINS` at most) name the bins that hold a wanted rank.
2. Count: equal values are counted (copies and coarse sensors shrink to little) and kept where
   their bin is wanted: two bins per quantile at most, each 1.1 % of its value wide. What is left
   is cut into `cells` equal cells per bin; the cells that hold a wanted rank are ranked value
   by value.

So rows are read twice and moved at most once. A bin is a growing function of the value, so the
ranks are exact whatever the distribution. A bin of at most `rankedRows` rows is one cell; that
only moves where ranking happens, the values and the one interpolation formula stay the same. A
group with a third of all rows is dealt out by value in the count and by cell in the ranking.
Building the plan runs no job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorweave.settings import setting

BINS = 64
# grows with the value over all magnitudes; zero in the middle
SCALE = "IF(_v = 0, 0D, sign(_v) * (log2(abs(_v)) + 1100))"
BIN = f"floor(greatest(-1e8D, least(1e8D, {SCALE} * {BINS})))"  # infinities and NaN at the ends


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float], count: str | None = None) -> DataFrame:
    """One row per group: `keys` and, per entry of `probs`, the linearly interpolated quantile; `count`
    names a column for the number of values.

    NULL values are left out; a group without values gives no row.
    """
    ranked_rows, cells = setting(df, "rankedRows"), setting(df, "cells")
    group = [f"`{k}`" for k in keys] or ["_all"]
    by = ", ".join(group)
    on = list(keys) or ["_all"]
    chosen = [f"`{k}`" for k in keys] or ["0 AS _all"]
    values = df.where(F.col(value).isNotNull()).selectExpr(*chosen, f"CAST(`{value}` AS DOUBLE) AS _v")

    # 0-based ranks wanted, and the test whether rows [_before, _before + _rows) hold one
    rank = {name: f"(_n - 1) * {p!r}D" for name, p in probs.items()}
    ends = {f"_{side}_{name}": f"{fn}({r})" for name, r in rank.items() for side, fn in (("low", "floor"), ("high", "ceil"))}
    held = " OR ".join(f"({r} >= _before AND {r} < _before + _rows)" for r in ends.values())

    counts = [F.expr("count(1) AS _rows"), F.expr("min(_v) AS _least"), F.expr("max(_v) AS _most")]
    bins = values.withColumn("_bin", F.expr(BIN)).groupBy(*on, "_bin").agg(*counts)
    running = f"sum(_rows) OVER (PARTITION BY {by} ORDER BY _bin) - _rows"
    bins = bins.selectExpr("*", f"{running} AS _before", f"sum(_rows) OVER (PARTITION BY {by}) AS _n").where(held)
    bins = bins.selectExpr(*group, "_bin", "_n", "_before AS _start", "_rows AS _in_bin", "_least", "_most")

    tallied = values.groupBy(*on, "_v").agg(F.expr("count(1) AS _rows")).withColumn("_bin", F.expr(BIN))
    share = f"floor(try_divide(_v - _least, _most - _least) * {cells})"
    cell = f"IF(_in_bin <= {ranked_rows}, 0, coalesce(least({cells - 1}, {share}), 0)) AS _cell"
    inside = tallied.join(bins, [*on, "_bin"]).selectExpr(*group, "_bin", "_v", "_rows", "_n", "_start", cell)

    found = inside.groupBy(*on, "_bin", "_cell", "_n", "_start").agg(F.expr("sum(_rows) AS _rows"))
    running = f"_start + sum(_rows) OVER (PARTITION BY {by}, _bin ORDER BY _cell) - _rows"
    found = found.selectExpr("*", f"{running} AS _before").where(held).selectExpr(*group, "_bin", "_cell", "_before AS _first")

    running = f"_first + sum(_rows) OVER (PARTITION BY {by}, _bin, _cell ORDER BY _v) - _rows"
    ranked = inside.join(found, [*on, "_bin", "_cell"]).selectExpr(*group, "_n", "_v", "_rows", f"{running} AS _before")
    picked = ranked.groupBy(*on, "_n").agg(
        *[F.expr(f"min(IF({r} >= _before AND {r} < _before + _rows, _v, NULL)) AS `{end}`") for end, r in ends.items()]
    )
    lines = [
        f"`_low_{name}` + (`_high_{name}` - `_low_{name}`) * ({rank[name]} - floor({rank[name]})) AS `{name}`"
        for name in probs
    ]
    return picked.selectExpr(*[f"`{k}`" for k in keys], *lines, *([f"_n AS `{count}`"] if count else []))
