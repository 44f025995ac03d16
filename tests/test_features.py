"""Feature windows, wide-frame features, quantiles, summaries."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from fixtures import at
from pyspark.sql import functions as F

from sensorweave.functions.ordered import with_chunks
from sensorweave.functions.quantiles import exact_quantiles
from sensorweave.functions.spectrum import _native, divisor, spectrum
from sensorweave.operators import frames, profile, windows


def _signal(readings, times, codes=None, values=None):
    values = values or [float(i) for i in range(len(times))]
    df = readings([(t, "acc_rms_radial", v) for t, v in zip(times, values)])
    codes = codes or [0] * len(times)
    code = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("reading_id") + 1).cast("int"))
    return df.withColumn("quality_code", code).withColumn("is_gap", F.lit(False))


QUARTERS = [f"01 {h:02d}:{m:02d}:00" for h in range(4) for m in (0, 15, 30, 45)]


def test_last_sample_on_the_border_is_dropped(readings):
    found = windows.window_features(_signal(readings, QUARTERS + ["01 04:00:00"])).collect()
    assert sorted(r.window_no for r in found) == [0, 1]
    assert {r.ts_utc for r in found} == {at("01 01:45:00"), at("01 03:45:00")}


def test_single_time_has_no_window(readings):
    assert windows.window_features(_signal(readings, ["01 00:00:00"]), min_samples=1).count() == 0


def test_windows_need_good_samples_and_no_gap(readings):
    codes = [3] * 5 + [0] * 11
    found = windows.window_features(_signal(readings, QUARTERS, codes)).collect()
    assert [r.window_no for r in found] == [1]
    gap = _signal(readings, QUARTERS).withColumn("is_gap", F.col("reading_id") == 9)
    assert [r.window_no for r in windows.window_features(gap).collect()] == [0]
    mixed = windows.window_features(_signal(readings, QUARTERS, [0] * 7 + [6] + [0] * 8)).orderBy("window_no").first()
    assert (mixed.quality_code, mixed.count_samples, mixed.ts_utc) == (6, 7.0, at("01 01:45:00"))


def _windows_of(spark, sizes, seed=7):
    """Samples of windows of given lengths, and the spectra that numpy finds."""
    draw = np.random.default_rng(seed)
    want, rows = {}, []
    for w, n in enumerate(sizes):
        x = draw.normal(size=n) + 3 * np.sin(np.arange(n))
        x -= x.mean()
        rows += [(w, n, i, float(v)) for i, v in enumerate(x)]
        power = np.abs(np.fft.rfft(x)) ** 2
        peak = int(np.argmax(power[1:])) + 1 if n > 1 else 0
        want[w] = (np.sqrt(power[peak]), peak, power.sum())
    return spark.createDataFrame(rows, "w long, _n long, pos long, value double").repartition(7), want


@pytest.mark.parametrize("how", ["native", "arrow"])
@pytest.mark.parametrize("longest", [4, 256])
def test_spectrum(spark, how, longest):
    """Lengths with and without good divisors, primes, one and two samples; cut into groups or not."""
    spark.conf.set("spark.sensorweave.dftLength", str(longest))
    samples, want = _windows_of(spark, [1, 2, 3, 4, 5, 8, 12, 13, 17, 36, 60, 61, 62, 97, 128])
    found = {r.w: tuple(r)[1:] for r in spectrum(samples, ["w"], how).collect()}
    spark.conf.unset("spark.sensorweave.dftLength")
    assert set(found) == set(want)
    for w, numbers in want.items():
        assert found[w] == pytest.approx(numbers, rel=1e-9, abs=1e-9)


def test_spectrum_of_a_constant_and_of_nothing(spark):
    flat = spark.range(9).selectExpr("1 AS w", "9L AS _n", "id AS pos", "0D AS value")
    assert tuple(spectrum(flat, ["w"]).first()) == (1, 0.0, 1.0, 0.0)
    assert spectrum(flat.where("false"), ["w"]).count() == 0


@pytest.mark.parametrize("n", [1 << 16, 65_537])
def test_long_window_in_small_groups(spark, n):
    """A window of many samples, also a prime number of them: no group holds more than a few square roots."""
    draw = np.random.default_rng(n)
    x = draw.normal(size=n)
    x -= x.mean()
    power = np.abs(np.fft.rfft(x)) ** 2
    samples = spark.createDataFrame(pd.DataFrame({"w": 5, "_n": n, "pos": np.arange(n), "value": x}))
    row = spectrum(samples, ["w"], "arrow").first()
    peak = int(np.argmax(power[1:])) + 1
    assert tuple(row) == (5, pytest.approx(np.sqrt(power[peak]), rel=1e-8), peak, pytest.approx(power.sum(), rel=1e-8))


def test_passes_of_a_group(spark):
    """Transforms inside a group, of any length: by definition, in passes, after a chirp; missing samples are zero."""
    lengths = [*range(1, 41), 64, 251, 256, 257, 1000, 4099]
    draw = np.random.default_rng(3)
    values = {n: draw.normal(size=n) + 1j * draw.normal(size=n) for n in lengths}
    rows = spark.createDataFrame([(n, [(float(v.real), float(v.imag)) for v in x]) for n, x in values.items()], "n long, x array<struct<re: double, im: double>>")
    for r in rows.selectExpr("n", f"{_native('x', 'n')} AS y").collect():
        want = np.fft.fft(values[r.n])
        assert np.allclose([complex(e.re, e.im) for e in r.y], want, rtol=0, atol=1e-10 * np.abs(want).max())
    gaps = spark.createDataFrame([(1, 8, 0, 2.0), (1, 8, 5, -2.0)], "w long, _n long, pos long, value double")
    power = np.abs(np.fft.rfft([2, 0, 0, 0, 0, -2, 0, 0])) ** 2
    assert spectrum(gaps, ["w"]).first().fft_energy_total == pytest.approx(power.sum())


def test_groups_are_not_put_together(spark):
    """A few bytes of samples are much arithmetic: windows stay dealt out over all shuffle partitions."""
    samples, want = _windows_of(spark, [64] * 40)
    samples = samples.localCheckpoint()
    found = spectrum(samples, ["w"]).select("w", F.spark_partition_id().alias("part"))
    assert found.count() == 40
    assert "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("n", "p"), [(1, 1), (256, 1), (257, None), (1 << 20, 1 << 10), (1_000_000, 1000), (999_983, None), (360_000, 600), (514, None)])
def test_divisors(spark, n, p):
    assert spark.sql(f"SELECT {divisor('n', 256)} AS p FROM VALUES ({n}L) AS t(n)").first().p == p


def test_long_features(readings):
    long = windows.features_long(windows.window_features(_signal(readings, QUARTERS + ["01 05:00:00"])))
    rows = {r.feature: r.value for r in long.where(F.col("ts_utc") == F.lit(at("01 01:45:00"))).collect()}
    assert len(rows) == 9
    assert rows["mean"] == 3.5 and rows["rms_window"] == pytest.approx(np.sqrt(np.mean(np.arange(8.0) ** 2)))


def _wide(spark, n=60, seed=1, step=900):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame({
        "acc_rms_axial": rng.normal(size=n).round(3),
        "acc_rms_radial": rng.normal(size=n).round(3),
        "skin_temp": rng.normal(size=n).round(3),
        "total_run_time": np.arange(1.0, n + 1),
    })
    frame.loc[frame.index % 17 == 5, "acc_rms_axial"] = np.nan
    rows = [
        (1, at("01 00:00:00") + dt.timedelta(seconds=step * i), *[None if pd.isna(v) else float(v) for v in r])
        for i, r in enumerate(frame.itertuples(index=False))
    ]
    names = ", ".join(f"{c} double" for c in frame.columns)
    return frame, spark.createDataFrame(rows, f"deployment_id long, ts_slot timestamp, {names}")


def _match(df, name, want):
    got = [r[name] for r in df.orderBy("ts_slot").collect()]
    for g, w in zip(got, want, strict=True):
        assert (g is None) == bool(pd.isna(w)) and (g is None or g == pytest.approx(float(w), abs=1e-9))


@pytest.mark.parametrize("step_s", [None, 900])
def test_rolling(spark, sizes, step_s):
    frame, df = _wide(spark)
    got = frames.rolling_features(df, rows=12, step_s=step_s)
    assert got.count() == 60
    rolled = frame["acc_rms_axial"].rolling(12)
    for name, want in (("MEAN", rolled.mean()), ("STD", rolled.std()), ("MAX", rolled.max())):
        _match(got, f"acc_rms_axial_{name}_W12", want)


@pytest.mark.parametrize("step_s", [None, 900])
def test_smooth_and_difference(spark, sizes, step_s):
    frame, df = _wide(spark)
    got = frames.smooth(df, step_s=step_s, width=None)
    _match(got, "acc_rms_axial_SMOOTH", frame["acc_rms_axial"].rolling(3, center=True).mean())
    _match(got, "skin_temp_SMOOTH", frame["skin_temp"].rolling(5, center=True).mean())
    _match(frames.difference(df, step_s=step_s), "skin_temp_DELTA", frame["skin_temp"].diff())


def test_engineered_frame(spark, sizes):
    frame, df = _wide(spark)
    got = frames.engineer(df, rows=3, step_s=900)
    want = frame.copy()
    for c in ("acc_rms_axial", "acc_rms_radial"):
        rolled = frame[c].rolling(3)
        want[f"{c}_MEAN_W3"], want[f"{c}_STD_W3"], want[f"{c}_MAX_W3"] = rolled.mean(), rolled.std(), rolled.max()
    want["Vib_Energy_Total"] = want[[c for c in want if "acc_rms" in c]].mean(axis=1)
    want["skin_temp_DELTA"] = frame["skin_temp"].diff()
    want = want.dropna()
    _match(got, "Vib_Energy_Total", want["Vib_Energy_Total"])
    _match(got, "RUL_Proxy", want["total_run_time"] / 60.0)


def test_ratio_of_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "acc_rms_axial double, acc_rms_radial double")
    assert [r[0] for r in df.select(frames.axial_radial_ratio()).collect()] == [None, 0.5]


def test_scaler(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, b double")
    scaler = frames.fit_scaler(df)
    assert [tuple(r) for r in frames.apply_scaler(df, scaler).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    frames.save_scaler(spark, scaler, str(tmp_path / "scaler"))
    assert frames.load_scaler(spark, str(tmp_path / "scaler")) == scaler


def test_quantiles_do_not_depend_on_settings(spark):
    """Bit for bit the same whatever the sizes, and planning runs no job."""
    draw = np.random.default_rng(8)
    values = np.concatenate([draw.lognormal(3, 2, 400), -draw.lognormal(0, 5, 300), [0.0, -0.0, 1e300, -1e300, 5e-324], np.repeat(7.5, 90)])
    df = spark.createDataFrame([(int(i % 3), float(v)) for i, v in enumerate(values)], "g long, v double")
    probs = {"p1": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "top": 1.0}
    seen = set()
    for sizes in ({}, {"rankedRows": 1, "cells": 4}, {"rankedRows": 5, "cells": 32768, "splitRows": 7}, {"rankedRows": 50, "cells": 16}):
        for name, value in sizes.items():
            spark.conf.set(f"spark.sensorweave.{name}", str(value))
        group = f"plan-{len(sizes)}-{sizes.get('cells')}"
        spark.sparkContext.setJobGroup(group, "planning")
        plan = exact_quantiles(df, ["g"], "v", probs)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
        seen.add(str(sorted(tuple(r) for r in plan.collect())))
        for name in sizes:
            spark.conf.unset(f"spark.sensorweave.{name}")
    assert len(seen) == 1


@pytest.mark.parametrize("kind", ["normal", "ties", "heavy", "constant", "single"])
def test_exact_quantiles(spark, sizes, kind):
    rng = np.random.default_rng(3)
    values = {
        "normal": rng.normal(size=400),
        "ties": rng.integers(0, 4, size=400).astype(float),
        "heavy": np.exp(rng.normal(size=400) * 6),
        "constant": np.full(50, 2.5),
        "single": np.array([4.0]),
    }[kind]
    rows = [(g, float(v)) for g in (1, 2) for v in values * g] + [(1, None), (3, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = {"p0": 0.0, "q1": 0.25, "p50": 0.5, "p99": 0.99}
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    assert set(got) == {1, 2}
    for g in (1, 2):
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(np.quantile(values * g, p), rel=1e-12, abs=1e-12)
    pooled = exact_quantiles(df, [], "v", {"p50": 0.5}).first()
    assert pooled.p50 == pytest.approx(np.quantile(np.concatenate([values, values * 2]), 0.5))


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(41)] + [("b", 5.0)], "variable string, value double")
    rows = profile.histogram(df).collect()
    counts = {(r.variable, r.bin): r.n for r in rows}
    assert counts[("a", 39)] == 2 and counts[("a", 0)] == 1 and counts[("b", 0)] == 1
    assert sum(counts.values()) == 42


def test_categorical_summary_tie(spark):
    rows = [("bearing_condition", v) for v in (3.0, 1.0, 3.0, 1.0, 2.0, None)] + [("speed", 9.0)]
    row = profile.categorical_summary(spark.createDataFrame(rows, "variable string, value double")).collect()
    assert sorted((r.value, r["count"], r.is_most_frequent) for r in row) == [(1.0, 5, True), (2.0, 5, False), (3.0, 5, False)]


def test_daily_rows_share_chunks(spark):
    """A frame with a row a day: its chunks are years, not rows, and frames reach across them."""
    days = spark.range(800).selectExpr("1L AS deployment_id", "timestamp_seconds(id * 86400) AS ts_slot", "CAST(id AS DOUBLE) AS acc_rms_axial")
    ranked = with_chunks(days, ["deployment_id"], "ts_slot", "frameSeconds")
    assert ranked.select("_chunk").distinct().count() == 3
    rolled = frames.rolling_features(days, rows=12).orderBy("ts_slot").collect()
    assert [r.acc_rms_axial_MAX_W12 for r in rolled] == [None] * 11 + [float(i) for i in range(11, 800)]
    plan = frames.rolling_features(days, rows=12)._jdf.queryExecution().optimizedPlan().toString()
    assert str(366 * 86_400 * 1_000_000) in plan
