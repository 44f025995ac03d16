"""Anomaly rules and quality codes for long-form readings."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.functions.ordered import (
    CHUNK,
    CHUNKING,
    across_chunks,
    attach_edges,
    chunk_window,
    core_rows,
    full_frame,
    with_blocks,
    with_chunks,
    with_neighbour,
    with_position,
    BLOCK,
)
from sensorweave.functions.lookup import with_group_columns
from sensorweave.functions.quantiles import exact_quantiles
from sensorweave.operators.temporal import add_time_flags, previous_time_edges
from sensorweave.schema import to_number, with_numeric_value

SERIES = ("deployment_id", "variable")
ORDER = ("ts_utc", "reading_id")
SEVERE_FLAGS = [
    "is_invalid_physical",
    "is_invalid_category",
    "is_invalid_monotonic",
    "is_outlier",
    "is_missing",
]


def _variable() -> Column:
    return F.col("variable")


def _value() -> Column:
    return F.col("value")



# --- rules on one row --------------------------------------------------------------

def is_missing() -> Column:
    return _value().isNull()


def is_invalid_physical() -> Column:
    """Negative vibration, physical quantity or counter."""
    signed = catalog.in_group(catalog.VIBRATION, catalog.PHYSICAL, catalog.ACCUMULATIVE)
    return F.coalesce(signed & (_value() < 0), F.lit(False))


def is_invalid_category() -> Column:
    """A category outside its domain after cutting off the fraction; NULL is exempt, infinity is not."""
    whole = "sign(value) * floor(abs(value))"
    rules = " OR ".join(
        f"(variable IN ({catalog.quoted(catalog.spellings([name]))}) AND "
        f"(abs(value) = double('infinity') OR {whole} NOT IN ({', '.join(map(str, domain))})))"
        for name, domain in catalog.CATEGORY_DOMAINS.items()
    )
    return F.expr(f"coalesce({rules}, false)")


# --- spread of the vibration signals -----------------------------------------------

def spread_stats(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """count, mean, min, max, q1, q3, iqr per group over the non-NULL values."""
    values = df.where(_value().isNotNull())
    basic = values.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(values, keys, "value", {"q1": 0.25, "q3": 0.75})
    return basic.join(quartiles, list(keys)).withColumn("iqr", F.col("q3") - F.col("q1"))


def vibration_stats(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Spread of the vibration variables; `keys=('variable',)` pools all deployments."""
    return spread_stats(df.where(catalog.in_group(catalog.VIBRATION)), keys)


def vibration_quartiles(df: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    return exact_quantiles(
        df.where(catalog.in_group(catalog.VIBRATION)), keys, "value", {"q1": 0.25, "q3": 0.75}
    )


def outside(factor: float, q1: Column | str = "q1", q3: Column | str = "q3") -> Column:
    """Beyond the quartiles by more than `factor` times their distance; False when that is not positive."""
    q1, q3 = (F.col(q) if isinstance(q, str) else q for q in (q1, q3))
    iqr = q3 - q1
    beyond = (_value() < q1 - factor * iqr) | (_value() > q3 + factor * iqr)
    return F.coalesce((iqr > 0) & beyond, F.lit(False))


def flag_outliers(df: DataFrame, stats: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """`is_outlier` (3 x IQR) and `is_high` (1.5 x IQR, not outlier); `stats` needs q1, q3 and count."""
    return (
        with_group_columns(df, stats, keys, ["q1", "q3"], "count", "left")
        .withColumn("is_outlier", outside(3.0))
        .withColumn("is_high", outside(1.5) & ~F.col("is_outlier"))
        .drop("q1", "q3")
    )


# --- rules on consecutive rows -----------------------------------------------------

def _decreased(before: Column, tolerance: float | None) -> Column:
    drop = _value() < before if tolerance is None else _value() - before < -tolerance
    return F.coalesce(drop, F.lit(False))


def flag_counter_decrease(
    df: DataFrame, tolerance: float | None = None, keys: Sequence[str] = SERIES, order: Sequence[str] = ORDER
) -> DataFrame:
    """Counters below the row just before them (a NULL in between hides the drop).

    `tolerance=None` compares strictly; a number ignores drops up to that size.
    """
    rows = with_neighbour(with_chunks(df, keys), keys, ["value"], order, "_prev")
    counter = catalog.in_group(catalog.ACCUMULATIVE)
    flag = counter & _decreased(F.col("_prev.value"), tolerance)
    return rows.withColumn("is_invalid_monotonic", flag).drop("_prev", *CHUNKING)


def flag_sequence_anomalies(
    df: DataFrame,
    keys: Sequence[str] = SERIES,
    order: Sequence[str] = ORDER,
    stuck_rows: int = catalog.STUCK_ROWS,
    stuck_std: float = catalog.STUCK_STD,
    noise_rows: int = catalog.NOISE_ROWS,
    noise_limit: float = catalog.NOISE_STD * catalog.NOISE_FACTOR,
) -> DataFrame:
    """`is_excessive_jump`, `is_stuck_value`, `is_excessive_noise` for variables with a jump limit.

    All three look back at most 2 * `stuck_rows` - 2 rows, so rows are cut into equal blocks by
    their position in the series, each with that many rows of its predecessor.
    """
    limit = catalog.jump_limit_of()
    reach = max(2 * stuck_rows - 2, noise_rows - 1, 1)
    rows = with_blocks(with_position(with_chunks(df, keys), keys, order), F.col("_pos"), back=reach)
    series = Window.partitionBy(*keys, BLOCK).orderBy("_pos")
    stuck_frame = series.rowsBetween(1 - stuck_rows, 0)
    noise_frame = series.rowsBetween(1 - noise_rows, 0)
    step = F.abs(_value() - F.lag("value").over(series))
    flat = F.coalesce(full_frame(F.stddev_samp, _value(), stuck_frame, stuck_rows) < stuck_std, F.lit(False))
    noise = full_frame(F.stddev_samp, _value(), noise_frame, noise_rows) > noise_limit
    # a flat frame marks its last row and the rows after it, once that many rows exist
    trailing = (F.count(F.lit(1)).over(stuck_frame) == stuck_rows) & F.max("_flat").over(stuck_frame)
    flagged = (
        rows.withColumn("is_excessive_jump", F.coalesce(step > limit, F.lit(False)))
        .withColumn("_flat", flat)
        .withColumn("is_stuck_value", limit.isNotNull() & trailing)
        .withColumn("is_excessive_noise", limit.isNotNull() & F.coalesce(noise, F.lit(False)))
    )
    return core_rows(flagged).drop("_flat", "_pos", *CHUNKING)


# --- codes -------------------------------------------------------------------------

def _first_match(df: DataFrame, ranking: Sequence[tuple[str, int]]) -> Column:
    """Code of the first flag that holds; a flag column the frame lacks counts as False."""
    whens = " ".join(f"WHEN {name} THEN {value}" for name, value in ranking if name in df.columns)
    return F.expr(f"CASE {whens} ELSE 0 END" if whens else "0").cast("int")


# Severity order of the quality codes.
SEVERITY = [
    ("is_invalid_monotonic", 6),
    ("is_invalid_physical", 5),
    ("is_invalid_category", 4),
    ("is_outlier", 3),
    ("is_gap", 2),
    ("is_missing", 1),
]

# Severity order of the extended quality codes.
EXTENDED_SEVERITY = [
    ("is_invalid_physical", 5),
    ("is_invalid_monotonic", 6),
    ("is_excessive_jump", 8),
    ("is_stuck_value", 7),
    ("is_invalid_category", 4),
    ("is_outlier", 3),
    ("is_high", 3),
    ("is_gap", 2),
    ("is_missing", 1),
    ("is_excessive_noise", 10),
    ("is_error", 9),
]


def with_quality_code(df: DataFrame) -> DataFrame:
    return df.withColumn("quality_code", _first_match(df, SEVERITY))


def with_extended_quality_code(df: DataFrame) -> DataFrame:
    return df.withColumn("quality_code", _first_match(df, EXTENDED_SEVERITY))


def null_severe(df: DataFrame) -> DataFrame:
    """NULL the value of rows with a severe flag; unchanged when the frame has no flags."""
    flags = [F.col(c) for c in SEVERE_FLAGS if c in df.columns]
    if not flags:
        return df
    return df.withColumn("value", F.when(~reduce(lambda a, b: a | b, flags), _value()))


def null_outliers(df: DataFrame) -> DataFrame:
    return df.withColumn("value", F.when(~F.col("is_outlier"), _value()))


# --- composites --------------------------------------------------------------------

def _counter_edges(df: DataFrame) -> DataFrame:
    """Per (deployment, chunk): the last row of each counter before the chunk, as a map.

    The map has one entry per catalog counter, so its size is fixed.
    """
    counters = catalog.canonical_names(catalog.ACCUMULATIVE)
    latest = {
        c: F.max_by(F.struct("value"), F.when(catalog.named(c), F.struct(*ORDER)))
        for c in counters
    }
    per_chunk = (
        df.where(catalog.in_group(catalog.ACCUMULATIVE))
        .groupBy("deployment_id", CHUNK)
        .agg(*[col.alias(c) for c, col in latest.items()])
    )
    return per_chunk.select("deployment_id", CHUNK, *[F.col(c).alias(f"_{c}") for c in counters])


def _sequence_context(df: DataFrame, stats: DataFrame) -> DataFrame:
    """All a (deployment, chunk) must know from outside: last timestamp, last counters, quartiles."""
    counters = [f"_{c}" for c in catalog.canonical_names(catalog.ACCUMULATIVE)]
    before = across_chunks(["deployment_id"]).rowsBetween(Window.unboundedPreceding, -1)
    edges = previous_time_edges(df, ["deployment_id"], "ts_utc").join(
        _counter_edges(df), ["deployment_id", CHUNK], "left"
    )
    edges = edges.select(
        "deployment_id",
        CHUNK,
        "_before_us",
        *[F.last(c, ignorenulls=True).over(before).alias(c) for c in counters],
    )
    # one entry per vibration variable of the catalog
    quartiles = stats.groupBy("deployment_id").agg(
        F.map_from_entries(F.collect_list(F.struct("variable", F.struct("q1", "q3")))).alias("_quartiles")
    )
    return edges.join(quartiles, "deployment_id", "left")


def detect(
    df: DataFrame,
    tolerance: float | None = None,
    drop_outliers: bool = False,
    time_flags: bool = True,
    expected_s: float = catalog.EXPECTED_S,
    gap_factor: float = catalog.GAP_FACTOR,
    small_factor: float = catalog.SMALL_DELTA_FACTOR,
) -> DataFrame:
    """All row flags and the quality code of raw readings.

    Rows are shuffled once, on (deployment, chunk): the context join, the time window and
    the per-variable window inside a chunk all reuse it. `time_flags=False` keeps flags the
    frame already has. `tolerance` and `drop_outliers` select the tolerant variant that also
    replaces outliers by NULL.
    """
    rows = with_chunks(with_numeric_value(df), ["deployment_id"])
    rows = attach_edges(rows, _sequence_context(rows, vibration_quartiles(rows)), ["deployment_id"])
    if time_flags:
        rows = add_time_flags(rows, ["deployment_id"], "ts_utc", expected_s, gap_factor, small_factor)

    near = F.lag(F.struct("value")).over(chunk_window(SERIES, ORDER))
    counters = catalog.canonical_names(catalog.ACCUMULATIVE)
    carried = reduce(
        lambda rest, c: F.when(catalog.named(c), F.col(f"_{c}")).otherwise(rest),
        counters,
        F.lit(None),
    )
    previous = F.coalesce(near, carried).getField("value")
    counter = catalog.in_group(catalog.ACCUMULATIVE)
    quartile = F.col("_quartiles")[_variable()]
    q1, q3 = quartile["q1"], quartile["q3"]
    rows = rows.withColumns({
        "is_missing": is_missing(),
        "is_invalid_physical": is_invalid_physical(),
        "is_outlier": outside(3.0, q1, q3),
        "is_high": outside(1.5, q1, q3) & ~outside(3.0, q1, q3),
        "is_invalid_category": is_invalid_category(),
        "is_invalid_monotonic": counter & _decreased(previous, tolerance),
    })
    rows = rows.drop(*CHUNKING, "_before_us", "_quartiles", *[f"_{c}" for c in counters])
    if drop_outliers:
        rows = null_outliers(rows)
    return with_quality_code(rows)


# --- reports -----------------------------------------------------------------------

def code_counts(df: DataFrame, code: str = "quality_code", labels: dict[int, str] | None = None) -> DataFrame:
    """Rows and share per code, with its label. The window runs over the few counted codes."""
    counted = df.groupBy(code).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(0)))
    labels = catalog.QUALITY_LABELS if labels is None else labels
    return counted.select(
        code,
        catalog.label_of(code, labels).alias("label"),
        "n",
        (F.col("n") * 100.0 / total).alias("percent"),
    )


def flag_counts(df: DataFrame, flags: Sequence[str] = tuple(catalog.FLAG_COLUMNS)) -> DataFrame:
    """Rows and share per flag; NULL for a flag the frame does not have. One pass."""
    total = F.count(F.lit(1)).alias("_total")
    counts = [
        (F.count_if(F.col(f)) if f in df.columns else F.lit(None).cast("long")).alias(f) for f in flags
    ]
    long = df.agg(total, *counts).unpivot(["_total"], list(flags), "flag", "n")
    return long.select("flag", "n", F.try_divide(F.col("n") * 100.0, F.col("_total")).alias("percent"))


def sample_of_code(df: DataFrame, code: int, rows: int = 10) -> DataFrame:
    """The first rows (by time) with a given quality code."""
    hits = df.where(F.col("quality_code") == code)
    return hits.select("reading_id", "ts_utc", "variable", "value", "quality_code").orderBy(*ORDER).limit(rows)
