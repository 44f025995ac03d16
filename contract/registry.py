"""Registry of driver queries: a Spark callable and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(configure(spark), str(folder))

        run.__name__ = run.__qualname__ = name
        run.__doc__ = fn.__doc__
        assert name not in QUERIES, name
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def r6(col: Column | str) -> Column:
    """Six decimals, no negative zero."""
    col = F.col(col) if isinstance(col, str) else col
    return F.round(col.cast("double"), 6) + F.lit(0.0)


def us(col: Column | str) -> Column:
    return F.unix_micros(col)


# --- SQL building blocks -----------------------------------------------------------

VIB = "('acc_rms_radial', 'overall_vibration')"


def sql_readings(k: int) -> str:
    """CTE `r`: the readings derived from events."""
    return f"""r AS (
SELECT event_id AS reading_id, user_id % {k} AS deployment_id,
  'asset_' || (user_id % 4) AS asset_code, 'motor_' || (user_id % 6) AS motor_code,
  epoch_us(ts) AS us, ts AS ts_utc,
  CASE event_type WHEN 'click' THEN 'acc_rms_radial' WHEN 'view' THEN 'overall_vibration'
    WHEN 'purchase' THEN 'output_power' WHEN 'error' THEN 'bearing_condition'
    WHEN 'signup' THEN 'total_run_time' END AS variable,
  CASE WHEN event_id % 53 = 0 THEN NULL
    WHEN event_id % 61 = 0 THEN -value
    WHEN event_type = 'error' THEN (event_id % 6)::DOUBLE
    WHEN event_type = 'signup' THEN event_id / 10.0::DOUBLE - CASE WHEN event_id % 71 = 0 THEN 50 ELSE 0 END
    WHEN event_type IN ('click', 'view') AND event_id % 67 = 0 THEN value * 10
    ELSE value END AS value
FROM events)"""


def sql_steps(expected: float = 900, source: str = "r") -> str:
    """CTE `d`: distinct times of a deployment with the step before."""
    return f"""d AS (
SELECT deployment_id, us, (us - lag(us) OVER (PARTITION BY deployment_id ORDER BY us)) / 1e6 AS delta_s
FROM (SELECT DISTINCT deployment_id, us FROM {source}))"""


def sql_quality(k: int, expected: float = 900, tolerant: bool = False) -> str:
    """CTEs up to `q`: readings with all flags and the quality code."""
    drop = "value - prev < -1e-6" if tolerant else "value < prev"
    return f"""{sql_readings(k)}, {sql_steps()},
s AS (SELECT deployment_id, variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM r WHERE variable IN {VIB} AND value IS NOT NULL GROUP BY ALL),
p AS (SELECT *, lag(value) OVER (PARTITION BY deployment_id, variable ORDER BY us, reading_id) AS prev FROM r),
f AS (SELECT p.*, d.delta_s,
  coalesce(d.delta_s > {expected} * 1.5, false) AS is_gap,
  coalesce(d.delta_s > 0 AND d.delta_s < {expected} * 0.5, false) AS is_small_delta,
  value IS NULL AS is_missing,
  coalesce(variable <> 'bearing_condition' AND value < 0, false) AS is_invalid_physical,
  coalesce(q3 - q1 > 0 AND (value < q1 - 3 * (q3 - q1) OR value > q3 + 3 * (q3 - q1)), false) AS is_outlier,
  coalesce(q3 - q1 > 0 AND (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)), false) AS beyond,
  coalesce(variable = 'bearing_condition' AND trunc(value) NOT IN (0, 1, 2, 3, 4), false) AS is_invalid_category,
  coalesce(variable = 'total_run_time' AND {drop}, false) AS is_invalid_monotonic
  FROM p JOIN d USING (deployment_id, us) LEFT JOIN s USING (deployment_id, variable)),
q AS (SELECT *, beyond AND NOT is_outlier AS is_high,
  CASE WHEN is_invalid_monotonic THEN 6 WHEN is_invalid_physical THEN 5 WHEN is_invalid_category THEN 4
    WHEN is_outlier THEN 3 WHEN is_gap THEN 2 WHEN is_missing THEN 1 ELSE 0 END AS quality_code
  FROM f)"""


def sql_slot(us: str, step_s: int) -> str:
    """Nearest slot, ties to even."""
    step = step_s * 1_000_000
    return f"(round_even({us} / {step}::DOUBLE, 0)::BIGINT * {step})"


def sql_floor(us: str, step_s: int) -> str:
    step = step_s * 1_000_000
    return f"(({us}) - ({us}) % {step})"


def sql_grid(observed: str, step_s: int) -> str:
    """CTEs `g` and `n`: the complete grid of `observed(deployment_id, variable, slot, value)` and its neighbours."""
    step = step_s * 1_000_000
    return f"""b AS (SELECT deployment_id, min(slot) AS lo, max(slot) AS hi FROM {observed} GROUP BY ALL),
v AS (SELECT DISTINCT deployment_id, variable FROM {observed}),
g AS (SELECT deployment_id, variable, slot, value, hi FROM (
    SELECT v.deployment_id, v.variable, b.hi, unnest(generate_series(b.lo, b.hi, {step})) AS slot
    FROM v JOIN b USING (deployment_id)) LEFT JOIN {observed} USING (deployment_id, variable, slot)),
n AS (SELECT *,
  last_value(CASE WHEN value IS NOT NULL THEN slot END IGNORE NULLS) OVER w AS pslot,
  last_value(value IGNORE NULLS) OVER w AS pvalue,
  first_value(CASE WHEN value IS NOT NULL THEN slot END IGNORE NULLS) OVER x AS nslot,
  first_value(value IGNORE NULLS) OVER x AS nvalue
  FROM g WINDOW w AS (PARTITION BY deployment_id, variable ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    x AS (PARTITION BY deployment_id, variable ORDER BY slot ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def sql_r6(expr: str) -> str:
    return f"round({expr}, 6) + 0.0"
