"""Shape of the physical plans, the flows, and the driver contract."""

from __future__ import annotations

import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from contract import QUERIES, SQL
from contract.compare import connect, difference
from contract.inputs import readings as event_readings
from sensorweave.functions.totals import running_totals
from sensorweave.operators import grid, impute, profile, quality
from sensorweave.plans import flows

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_detection_moves_the_rows_once(spark):
    """Rows keep the shuffle on (deployment, chunk) through the join and both windows."""
    plan = _plan(quality.detect(event_readings(spark, SMALL, 4)))
    assert "Python" not in plan and "ShuffledHashJoin" in plan
    assert len(re.findall(r"Window \[", plan.split("ShuffledHashJoin")[0])) == 2
    top = plan.split("ShuffledHashJoin")[0]
    assert "Exchange" not in top  # nothing is shuffled between the context join and the result


def test_fills_need_no_join_above_the_grid(spark):
    df = event_readings(spark, SMALL, 4)
    observed = grid.collapse_last(grid.with_rounded_slot(df), context=("deployment_id",))
    plan = _plan(impute.fill_short_runs(grid.complete_grid(observed)))
    above = plan.split("Union")[0]
    assert "Join" not in above and above.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["quality_codes", "time_steps", "grid_reindex", "rolling_features", "percentiles", "sequence_anomalies"])
def test_no_python_and_no_single_task_over_rows(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL))
    assert "Python" not in plan and "ArrowEval" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("name", ["outlier_table", "histogram", "boxplot", "boxplot_outliers", "split_at_percentile", "flag_outliers"])
def test_rows_are_not_moved_by_variable(spark, name):
    """Numbers of a variable reach the rows of catalogue names without a join; other names are salted."""
    rows = event_readings(spark, SMALL, 4)
    build = {
        "flag_outliers": lambda: quality.flag_outliers(rows, quality.vibration_stats(rows, ("variable",)), ("variable",)),
    }.get(name, lambda: getattr(profile, name)(rows))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(build())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [re.sub(r"^[\s:+*()\d-]*", "", line) for line in plan.splitlines()]
    moved = [i for i, line in enumerate(lines) if re.match(r"Exchange hashpartitioning\(variable#\d+, \d+\)", line)]
    assert moved  # of aggregates
    for i in moved:
        below = next(line for line in lines[i + 1 :] if not re.match("Project|Filter|Sort |Generate|ColumnarToRow", line))
        assert "Scan" not in below, plan
    assert "CartesianProduct" not in plan


def test_unknown_names_get_their_numbers(spark):
    """Names outside the catalogue and NULL take the side road, with and without a hot key."""
    rows = [(i, name, float(i % 17)) for i in range(200) for name in ("speed", "acc_rms_radial", "own_name", None)]
    df = spark.createDataFrame(rows, "reading_id long, variable string, value double")
    for split in ("4000000", "7"):
        spark.conf.set("spark.sensorweave.splitRows", split)
        box = {r.variable: r for r in profile.boxplot(df).collect()}
        beyond = profile.split_at_percentile(df, above=True, prob=0.5)
        counts = {r.variable: r["count"] for r in beyond.groupBy("variable").count().collect()}
        spark.conf.unset("spark.sensorweave.splitRows")
        assert set(box) == {"speed", "acc_rms_radial", "own_name"}
        assert len({(r.q1, r.median, r.q3) for r in box.values()}) == 1
        assert counts == {name: sum(1 for i in range(200) if i % 17 > np.median([j % 17 for j in range(200)])) for name in box}


def test_running_totals(spark):
    """Sums over all rows before, with ties, over many partitions and on an empty table."""
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    df = spark.range(1000).selectExpr("id % 90 AS k", "id AS n")
    rows = running_totals(df, [F.desc("k")], ["n"]).collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {r._alln for r in rows} == {sum(range(1000))}
    by = sorted(rows, key=lambda r: r._upton)
    assert [r.k for r in by] == sorted((r.k for r in rows), reverse=True)
    assert all(b._upton - a._upton == b.n for a, b in zip(by, by[1:])) and by[0]._upton == by[0].n
    assert running_totals(df.where("false"), [F.asc("k")], ["n"]).count() == 0


def test_flow_invariants(spark):
    done = flows.standard(event_readings(spark, MEDIUM, 2).limit(4000))
    cells = done.completed
    sizes = {r.variable: r["count"] for r in cells.where("deployment_id = 0").groupBy("variable").count().collect()}
    assert len(set(sizes.values())) == 1  # every variable has every slot
    assert cells.where("(processing_code = 3) <> (value IS NULL)").count() == 0
    codes = done.readings.groupBy("quality_code").count().agg(F.sum("count")).first()[0]
    assert codes == 4000


def test_rounded_flow_marks(spark):
    done = flows.rounded(event_readings(spark, MEDIUM, 2).limit(3000))
    assert done.clean.where("is_imputed AND NOT is_missing_general").count() == 0
    assert done.quality.where("is_outlier AND value IS NOT NULL").count() == 0
    assert done.steps.count() == 16


def test_contract_is_consistent(spark):
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert driver.entry(spark).count() > 3


ALL = sorted(SQL)
CHOSEN = ALL if os.environ.get("FULL") else [
    "quality_code_counts", "quality_codes_tolerant", "dedupe_latest", "duplicate_rows", "short_neighbours", "delta_comparison",
    "regular_filled", "impute_run_limited", "impute_by_group", "unpivot_codes", "final_quality", "boxplot", "deployment_range_join",
]


@pytest.mark.parametrize("name", CHOSEN)
def test_against_sql(spark, name):
    """A sample of the queries next to their SQL; FULL=1 runs all of them."""
    assert difference(spark, connect(MEDIUM), MEDIUM, name) is None
