"""Slots and regular grids: snapping, collapsing, completing, reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions.ordered import BLOCK
from sensorweave.functions.timeline import US, ceil_us, floor_slot, floor_us, from_micros, micros, round_slot
from sensorweave.schema import require, to_number
from sensorweave.settings import setting

SERIES = ("deployment_id", "variable")
CONTEXT = ("deployment_id", "asset_code", "motor_code")


# --- slots -------------------------------------------------------------------------

def with_rounded_slot(df: DataFrame, step_s: int = catalog.SLOT_S, ts: str = "ts_utc", slot: str = "ts_slot"):
    return df.withColumn(slot, round_slot(F.col(ts), step_s))


def with_floored_slot(df: DataFrame, step_s: int = catalog.SLOT_S, ts: str = "ts_utc", slot: str = "ts_slot"):
    return df.withColumn(slot, floor_slot(F.col(ts), step_s))


def within_jitter(step_s: int, jitter_s: float, ts: str = "ts_utc") -> Column:
    """Is the timestamp close enough to its nearest slot?"""
    offset = F.abs(micros(ts) - micros(round_slot(F.col(ts), step_s)))
    return offset <= int(jitter_s * US)


def assign_slots(
    df: DataFrame, step_s: int = catalog.SLOT_S, jitter_s: float = catalog.JITTER_S, ts: str = "ts_utc"
) -> DataFrame:
    """Rows within the jitter tolerance of a slot, with that slot."""
    require(df, ts)
    return with_rounded_slot(df.where(within_jitter(step_s, jitter_s, ts)), step_s, ts)


def survivor_audit(
    df: DataFrame, step_s: int = catalog.SLOT_S, jitter_s: float = catalog.JITTER_S, keys=("deployment_id",)
) -> DataFrame:
    """How many rows, and how many flagged outliers, keep a slot: one conditional aggregate."""
    inside = within_jitter(step_s, jitter_s)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(inside).alias("rows_within_jitter"),
        F.count_if("is_outlier").alias("outliers"),
        F.count_if(F.col("is_outlier") & inside).alias("outliers_within_jitter"),
    )


# --- several readings in one slot --------------------------------------------------

def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def collapse_last(
    df: DataFrame, order: Sequence[str] = ("ts_utc", "reading_id"), context: Sequence[str] = CONTEXT
) -> DataFrame:
    """Last non-NULL value per (context, slot, variable); NULL when all are."""
    value = to_number(F.col("value"))
    last = F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))
    return df.groupBy(*_present(df, context), "ts_slot", "variable").agg(last.alias("value"))


def collapse_first(
    df: DataFrame, order: Sequence[str] = ("ts_utc", "reading_id"), context: Sequence[str] = CONTEXT
) -> DataFrame:
    """First non-NULL value per (context, slot, variable)."""
    value = to_number(F.col("value"))
    first = F.min_by(value, F.when(value.isNotNull(), F.struct(*order)))
    return df.groupBy(*_present(df, context), "ts_slot", "variable").agg(first.alias("value"))


def collapse_mean(df: DataFrame, context: Sequence[str] = CONTEXT) -> DataFrame:
    return df.groupBy(*_present(df, context), "ts_slot", "variable").agg(F.avg("value").alias("value"))


def collapse_max_or_mean(df: DataFrame, context: Sequence[str] = CONTEXT) -> DataFrame:
    """Counters keep their largest value in the slot, everything else its mean."""
    both = df.groupBy(*_present(df, context), "ts_slot", "variable").agg(
        F.max("value").alias("_max"), F.avg("value").alias("_mean")
    )
    counter = catalog.in_group(catalog.ACCUMULATIVE)
    return both.withColumn("value", F.when(counter, F.col("_max")).otherwise(F.col("_mean"))).drop("_max", "_mean")


# --- regular grid, in long form ----------------------------------------------------

def time_grid(
    df: DataFrame, keys: Sequence[str] = ("deployment_id",), ts: str = "ts_utc", step_s: int = catalog.SLOT_S
) -> DataFrame:
    """All slots from the floor of the first to the ceiling of the last timestamp, both included.

    Unfolded in two steps (blocks, then slots of a block), so no row holds a long array.
    """
    step = step_s * US
    bounds = df.groupBy(*keys).agg(F.min(micros(ts)).alias("_lo"), F.max(micros(ts)).alias("_hi"))
    low, high = floor_us(F.col("_lo"), step) / step, ceil_us(F.col("_hi"), step) / step
    spans = bounds.select(*keys, low.cast("long").alias("_first"), high.cast("long").alias("_last"))
    size = setting(df, "blockRows")
    start, end = block_bounds(F.col("_first"), F.col("_last"), size)
    slots = unfold_blocks(spans, size).repartition(*keys, BLOCK).select(
        *keys, F.explode(F.sequence(start, end)).alias("_pos")
    )
    return slots.select(*keys, from_micros(F.col("_pos") * step).alias("ts_slot"))


def unfold_blocks(spans: DataFrame, size: int) -> DataFrame:
    """One row per block of slot positions between `_first` and `_last`."""
    blocks = F.sequence(F.floor(F.col("_first") / size), F.floor(F.col("_last") / size))
    return spans.withColumn(BLOCK, F.explode(blocks))


def block_bounds(first: Column, last: Column, size: int) -> tuple[Column, Column]:
    """First and last position of the block inside [first, last]."""
    start = F.col(BLOCK) * size
    return F.greatest(first, start), F.least(last, start + size - 1)


def complete_grid(observed: DataFrame, step_s: int = catalog.SLOT_S) -> DataFrame:
    """Every slot of every series of a deployment, with the known values around it.

    `observed` has one row per (deployment_id, variable, ts_slot). The grid of a deployment
    runs from its first to its last slot over all variables. Result: `deployment_id,
    variable, ts_slot, value` (NULL where nothing was observed) plus the fill context:
    `_pos` (slot number), `_before`/`_after` (`pos`, `value` of the nearest non-NULL value
    on each side) and `_last` (last slot number of the grid).

    Missing slots are unfolded from the observed row before them, so the grid needs no
    join. Each block of slots gets two border rows that bring in the nearest known values
    from outside the block; observed rows are shuffled once, on (series, block), and no
    task holds more than one block of a series at a time.
    """
    step = step_s * US
    size = setting(observed, "blockRows")
    pos = (micros("ts_slot") / step).cast("long")
    cells = observed.select(*SERIES, "value", pos.alias("_pos")).withColumn(BLOCK, F.floor(F.col("_pos") / size))

    known_pos = F.when(F.col("value").isNotNull(), F.col("_pos"))
    per_block = cells.groupBy(*SERIES, BLOCK).agg(
        F.min("_pos").alias("_lo"),
        F.max("_pos").alias("_hi"),
        F.min(known_pos).alias("_first_pos"),
        F.min_by("value", known_pos).alias("_first_value"),
        F.max(known_pos).alias("_last_pos"),
        F.max_by("value", known_pos).alias("_last_value"),
    )
    bounds = per_block.groupBy("deployment_id").agg(F.min("_lo").alias("_first"), F.max("_hi").alias("_last"))
    blocks = unfold_blocks(per_block.select(*SERIES).distinct().join(bounds, "deployment_id"), size)

    def known(present: Column, pos_col: str, value_col: str) -> Column:
        return F.when(present, F.struct(F.col(pos_col).alias("pos"), F.col(value_col).alias("value")))

    earlier = Window.partitionBy(*SERIES).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*SERIES).orderBy(F.col(BLOCK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        blocks.join(per_block, [*SERIES, BLOCK], "left")
        .withColumn("_before", F.last(known(F.col("_last_pos").isNotNull(), "_last_pos", "_last_value"), ignorenulls=True).over(earlier))
        .withColumn("_after", F.last(known(F.col("_first_pos").isNotNull(), "_first_pos", "_first_value"), ignorenulls=True).over(later))
    )
    start, end = block_bounds(F.col("_first"), F.col("_last"), size)
    borders = blocks.select(
        *SERIES,
        BLOCK,
        F.col("_last").alias("_last"),
        F.explode(
            F.array(
                F.struct((start - 1).alias("_pos"), F.lit(-1).alias("_side"), F.col("_before").alias("_known")),
                F.struct((end + 1).alias("_pos"), F.lit(1).alias("_side"), F.col("_after").alias("_known")),
            )
        ).alias("_border"),
    ).select(*SERIES, BLOCK, "_last", "_border.*", F.lit(None).cast("double").alias("value"))
    inside = cells.select(
        *SERIES,
        BLOCK,
        F.lit(None).cast("long").alias("_last"),
        "_pos",
        F.lit(0).alias("_side"),
        known(F.col("value").isNotNull(), "_pos", "value").alias("_known"),
        "value",
    )

    forward = Window.partitionBy(*SERIES, BLOCK).orderBy("_pos")
    backward = Window.partitionBy(*SERIES, BLOCK).orderBy(F.col("_pos").desc())
    upto = forward.rowsBetween(Window.unboundedPreceding, 0)
    rows = (
        inside.unionByName(borders)
        .withColumn("_after", F.last("_known", ignorenulls=True).over(backward.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_before", F.last("_known", ignorenulls=True).over(upto))
        .withColumn("_last", F.first("_last").over(upto))
        .withColumn("_next", F.lead("_pos").over(forward))
        .where("_side < 1")
    )
    first = F.when(F.col("_side") == 0, F.col("_pos")).otherwise(F.col("_pos") + 1)
    span = F.when(first < F.col("_next"), F.sequence(first, F.col("_next") - 1))
    slots = rows.withColumn("_slot", F.explode(span))
    at_observed = (F.col("_side") == 0) & (F.col("_slot") == F.col("_pos"))
    return slots.select(
        *SERIES,
        from_micros(F.col("_slot") * step).alias("ts_slot"),
        F.when(at_observed, F.col("value")).alias("value"),
        F.col("_slot").alias("_pos"),
        "_before",
        "_after",
        "_last",
    )


FILL_CONTEXT = ["_pos", "_before", "_after", "_last"]


def reindex(observed: DataFrame, step_s: int = catalog.SLOT_S) -> DataFrame:
    """Every slot of every series; NULL value where nothing was observed."""
    return complete_grid(observed, step_s).drop(*FILL_CONTEXT)


def regular_unfilled(
    df: DataFrame, step_s: int = catalog.SLOT_S, jitter_s: float = catalog.JITTER_S
) -> DataFrame:
    """Readings snapped, collapsed to the last value, renamed and completed; nothing filled.

    Long form, with the fill context of `complete_grid`.
    """
    collapsed = collapse_last(assign_slots(df, step_s, jitter_s), context=("deployment_id",))
    return complete_grid(collapsed.withColumn("variable", catalog.canonical_of()), step_s)


def resample_mean(df: DataFrame, step_s: int = catalog.RESAMPLE_S) -> DataFrame:
    """Mean per left-closed slot; empty slots kept as NULL. Carries the fill context."""
    slots = with_floored_slot(df, step_s)
    return complete_grid(collapse_mean(slots, context=("deployment_id",)), step_s)


def flag_incomplete_slots(df: DataFrame, value: str = "value") -> DataFrame:
    """Long form of 'any variable of the slot is NULL'; a slot has one row per variable."""
    slot = Window.partitionBy("deployment_id", "ts_slot")
    return df.withColumn("is_missing_general", F.bool_or(F.col(value).isNull()).over(slot))


# --- long and wide -----------------------------------------------------------------

def duplicate_cells(df: DataFrame, index: Sequence[str] = ("deployment_id", "ts_slot")) -> DataFrame:
    """Cells a strict pivot would reject."""
    return df.groupBy(*index, "variable").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def pivot_wide(
    df: DataFrame,
    index: Sequence[str] = ("deployment_id", "ts_slot"),
    columns: Sequence[str] | None = None,
    names: str = "variable",
    value: str = "value",
    how=F.first,
) -> DataFrame:
    """One row per index, one column per variable. The column list is fixed: no extra scan for it."""
    columns = list(columns or catalog.CANONICAL_NAMES)
    return df.groupBy(*index).pivot(names, columns).agg(how(value))


def pivot_strict(df: DataFrame, index: Sequence[str] = ("deployment_id", "ts_slot"), **kwargs) -> DataFrame:
    """`pivot_wide` that fails the query when a cell occurs twice."""
    def only(value):
        cell = F.max(value)
        return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("duplicate cell in pivot"))).otherwise(cell)

    return pivot_wide(df, index, how=only, **kwargs)


def rename_to_canonical(wide: DataFrame) -> DataFrame:
    return wide.withColumnsRenamed({s: n for s, n in catalog.TO_CANONICAL.items() if s in wide.columns})


def rename_to_source(wide: DataFrame) -> DataFrame:
    return wide.withColumnsRenamed({n: s for n, s in catalog.TO_SOURCE.items() if n in wide.columns})


def round_and_pivot(
    df: DataFrame, step_s: int = catalog.SLOT_S, columns: Sequence[str] | None = None, pick: str = "first"
) -> DataFrame:
    """Round to slots and pivot per (asset, motor): first value of a cell, or its mean."""
    slots = with_rounded_slot(df, step_s)
    keys = ("asset_code", "motor_code")
    collapsed = collapse_first(slots, context=keys) if pick == "first" else collapse_mean(slots, context=keys)
    return pivot_wide(collapsed, (*keys, "ts_slot"), columns)


def unpivot_long(
    wide: DataFrame,
    columns: Sequence[str],
    index: Sequence[str] = ("deployment_id", "ts_slot"),
    keep_null: bool = True,
) -> DataFrame:
    """Wide to long; NULL cells kept or dropped."""
    long = wide.unpivot(list(index), list(columns), "variable", "value")
    return long if keep_null else long.where(F.col("value").isNotNull())


def unpivot_pairs(
    wide: DataFrame,
    columns: Sequence[str],
    suffix: str,
    extra: str,
    index: Sequence[str] = ("deployment_id", "ts_slot"),
    default=None,
) -> DataFrame:
    """Unpivot value columns together with their companion columns (`<name><suffix>`), one pass, no join."""
    cells = [
        F.struct(
            F.lit(c).alias("variable"),
            F.col(c).cast("double").alias("value"),
            F.coalesce(F.col(c + suffix), F.lit(default)).alias(extra),
        )
        for c in columns
    ]
    return wide.select(*index, F.explode(F.array(*cells)).alias("_cell")).select(*index, "_cell.*")


def any_null(columns: Sequence[str]) -> Column:
    """Is any of these columns NULL in the row?"""
    flag = F.lit(False)
    for c in columns:
        flag = flag | F.col(c).isNull()
    return flag
