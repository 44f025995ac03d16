"""Grid, fills and reshaping, against independent pandas formulations."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from fixtures import at
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorweave.operators import grid, impute


def _random(n, seed, share=0.45):
    rng = np.random.default_rng(seed)
    values = rng.normal(size=n).round(3)
    return [None if rng.random() < share else float(v) for v in values]


def _column(df, name="value"):
    return [r[name] for r in df.orderBy("ts_slot").collect()]


def _same(got, want):
    want = [None if pd.isna(w) else float(w) for w in want]
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g is None) == (w is None) and (g is None or g == pytest.approx(w, abs=1e-9))


def _frame(series, values, variable):
    """Ends are observed (NULL or not), so the grid spans all values; inner NULLs are left out."""
    keep = [i for i, v in enumerate(values) if v is not None or i in (0, len(values) - 1)]
    df = series(values, variable).withColumn("_i", (F.unix_seconds("ts_slot") - F.unix_seconds(F.lit(at("01 00:00:00")))) / 900)
    return df.where(F.col("_i").isin(keep)).drop("_i")


def _index(values):
    return pd.Series(values, index=pd.date_range("2024-01-01", periods=len(values), freq="15min"), dtype=float)


def _runs(s):
    """Length of the NULL run each position lies in."""
    empty = s.isna()
    return empty.groupby((~empty).cumsum() * 2 + empty).transform("sum").where(empty, 0)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_linear_fill_of_short_runs(series, sizes, seed):
    values = _random(90, seed)
    s = _index(values)
    short = s.isna() & (_runs(s) <= 2)
    want = s.where(~short, s.interpolate("time"))
    got = impute.fill_short_runs(grid.complete_grid(_frame(series, values, "acc_rms_radial")))
    _same(_column(got), want)
    codes = np.where(s.notna(), 0, np.where(short & want.notna(), 1, 3))
    assert _column(got, "processing_code") == list(codes)


def test_carry_fill_of_short_runs(series, sizes):
    values = _random(90, 4)
    s = _index(values)
    short = s.isna() & (_runs(s) <= 2)
    want = s.where(~short, s.ffill())
    got = impute.fill_short_runs(grid.complete_grid(_frame(series, values, "bearing_condition")))
    _same(_column(got), want)
    assert set(_column(got, "processing_code")) == {0, 2, 3}


@pytest.mark.parametrize("seed", [5, 6])
def test_linear_both_ways(series, sizes, seed):
    values = _random(90, seed, 0.7)
    got = impute.with_filled(grid.complete_grid(_frame(series, values, "speed")), impute.linear_both_ways())
    _same(_column(got), _index(values).reset_index(drop=True).interpolate("linear", limit=2, limit_direction="both"))


@pytest.mark.parametrize("seed", [7, 8])
def test_carry_both_ways(series, sizes, seed):
    values = _random(90, seed, 0.7)
    s = _index(values)
    want = s.ffill(limit=2).bfill(limit=2)
    got = impute.with_filled(grid.complete_grid(_frame(series, values, "total_run_time")), impute.carry_both_ways())
    _same(_column(got), want)
    assert _column(got, "is_imputed") == list(s.isna() & want.notna())


def test_carry_forward(series, sizes):
    values = _random(90, 9, 0.8)
    got = impute.with_filled(grid.complete_grid(_frame(series, values, "speed")), impute.carry_forward())
    _same(_column(got), _index(values).ffill())


def test_null_runs(series, sizes):
    values = [None, None, None, 1.0, None, 2.0, None, None, 3.0] + [None] * 40 + [4.0, None, None, None]
    completed = grid.complete_grid(_frame(series, values, "speed"))
    runs = impute.null_runs(impute.fill_short_runs(completed).withColumn("value", F.when(F.col("processing_code") == 0, F.col("value"))))
    found = sorted((r.run_start, r.length) for r in runs.collect())
    assert [n for _, n in found] == [3, 40, 3]
    assert all(r.n_missing_not_imputed == r.length for r in runs.collect())


def test_unknown_variable_is_left_alone(series):
    got = impute.fill_by_group(grid.complete_grid(_frame(series, [1.0, None, 3.0], "mystery")))
    assert _column(got) == [1.0, None, 3.0]


def test_grid_spans_all_variables(series, sizes):
    """A variable seen late or seldom still gets every slot of its deployment."""
    df = series([1.0] + [None] * 48 + [2.0], "speed", keep_null=False).unionByName(
        series([None] * 20 + [5.0], "skin_temp", keep_null=False)
    )
    full = grid.reindex(df)
    counts = {r.variable: r["count"] for r in full.groupBy("variable").count().collect()}
    assert counts == {"speed": 50, "skin_temp": 50}
    assert full.where("value IS NOT NULL").count() == 3
    assert full.select("variable", "ts_slot").distinct().count() == 100


def test_collapse_last_skips_null(readings):
    df = readings([("01 00:01:00", "speed", 1.0), ("01 00:02:00", "speed", None), ("01 00:16:00", "speed", None)])
    got = grid.collapse_last(grid.with_rounded_slot(df)).orderBy("ts_slot").collect()
    assert [r.value for r in got] == [1.0, None]


def test_collapse_max_or_mean(readings):
    df = readings([("01 00:01:00", v, x) for v in ("speed", "total_run_time") for x in (1.0, 4.0, 1.0)])
    got = {r.variable: r.value for r in grid.collapse_max_or_mean(grid.with_floored_slot(df)).collect()}
    assert got == {"speed": 2.0, "total_run_time": 4.0}


def test_strict_pivot_rejects_duplicates(series):
    df = series([1.0, 2.0], "speed")
    assert grid.pivot_strict(df, columns=["speed", "skin_temp"]).count() == 2
    with pytest.raises(PySparkException, match="duplicate cell"):
        grid.pivot_strict(df.unionByName(df), columns=["speed"]).collect()


def test_unpivot_null_handling(series):
    wide = grid.pivot_wide(series([1.0, None], "speed"), columns=["speed", "skin_temp"])
    assert grid.unpivot_long(wide, ["speed", "skin_temp"]).count() == 4
    assert grid.unpivot_long(wide, ["speed", "skin_temp"], keep_null=False).count() == 1


def test_incomplete_slots(series):
    df = series([1.0, None], "speed").unionByName(series([1.0, 2.0], "skin_temp"))
    flags = {(r.variable, r.ts_slot): r.is_missing_general for r in grid.flag_incomplete_slots(df).collect()}
    assert [flags[(v, at(t))] for v in ("speed", "skin_temp") for t in ("01 00:00:00", "01 00:15:00")] == [False, True] * 2
