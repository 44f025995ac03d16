"""Anomaly rules and codes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sensorweave import catalog
from sensorweave.operators import quality
from sensorweave.schema import to_number


def _times(n, minutes=15):
    return [f"{1 + i * minutes // 1440:02d} {i * minutes // 60 % 24:02d}:{i * minutes % 60:02d}:00" for i in range(n)]


def _flags(df, name):
    return [r[name] for r in df.orderBy("reading_id").collect()]


def test_number_coercion(spark):
    df = spark.createDataFrame([("ON",), ("1.0",), ("",), ("NaN",), (None,)], "v string")
    assert [r.n for r in df.select(to_number(F.col("v")).alias("n")).collect()] == [None, 1.0, None, None, None]


def test_physical_rule(readings):
    rows = [("01 00:00:00", v, -1.0) for v in ("speed", "acc_rms_axial", "total_run_time", "bearing_condition", "other")]
    df = readings(rows).withColumn("flag", quality.is_invalid_physical())
    assert _flags(df, "flag") == [True, True, True, False, False]


def test_category_domain(readings):
    values = [1.9, 5.0, None, float("inf"), -0.5, -1.0, 4.99]
    df = readings([("01 00:00:00", "Bearing Condition", v) for v in values])
    assert _flags(df.withColumn("flag", quality.is_invalid_category()), "flag") == [False, True, False, True, False, True, False]


@pytest.mark.parametrize("tolerance, expected", [(None, [4, 5]), (1e-6, [5])])
def test_counter_decrease(readings, sizes, tolerance, expected):
    """A NULL resets the comparison; a tiny drop counts only without tolerance."""
    values = [5.0, None, 4.0, 4.0, 3.9999999, 3.0]
    df = readings([(t, "total_num_starts", v) for t, v in zip(_times(6, 600), values)])
    flagged = quality.flag_counter_decrease(df, tolerance).where("is_invalid_monotonic").collect()
    assert sorted(r.reading_id for r in flagged) == expected
    whole = quality.detect(df, tolerance).where("is_invalid_monotonic").collect()
    assert sorted(r.reading_id for r in whole) == expected


def test_counters_are_compared_within_their_variable(readings, sizes):
    rows = [("01 00:00:00", "total_num_starts", 9.0), ("01 00:15:00", "total_run_time", 1.0), ("03 00:00:00", "total_num_starts", 8.0)]
    assert _flags(quality.detect(readings(rows)), "is_invalid_monotonic") == [False, False, True]


def test_outliers_need_spread(readings, sizes):
    flat = [("01 00:00:00", "speed", 1.0)] + [(t, "acc_rms_radial", 1.0) for t in _times(20)] + [("09 00:00:00", "acc_rms_radial", 99.0)]
    assert not any(_flags(quality.detect(readings(flat)), "is_outlier"))


def test_outlier_and_high(readings, sizes):
    values = list(range(100)) + [180.0, 260.0]  # q1 = 25.25, q3 = 75.75
    rows = quality.detect(readings([(t, "overall_vibration", float(v)) for t, v in zip(_times(102), values)]))
    assert [r.reading_id for r in rows.where("is_high").collect()] == [100]
    assert [r.reading_id for r in rows.where("is_outlier").collect()] == [101]
    kept = quality.detect(readings([(t, "overall_vibration", float(v)) for t, v in zip(_times(102), values)]), 1e-6, True)
    row = kept.where("reading_id = 101").first()
    assert (row.value, row.quality_code, row.is_missing) == (None, 3, False)


def test_severity_orders(spark):
    names = [n for n, _ in quality.EXTENDED_SEVERITY]
    every = spark.range(1).select(*[F.lit(True).alias(n) for n in names])
    assert quality.with_quality_code(every).first().quality_code == 6
    assert quality.with_extended_quality_code(every).first().quality_code == 5
    rest = every.drop("is_invalid_physical", "is_invalid_monotonic")
    assert quality.with_extended_quality_code(rest).first().quality_code == 8
    assert quality.with_quality_code(rest).first().quality_code == 4
    assert quality.with_quality_code(spark.range(1)).first().quality_code == 0


def test_null_severe(readings):
    df = readings([("01 00:00:00", "speed", 1.0), ("01 00:15:00", "speed", -2.0)])
    assert quality.null_severe(df).collect() == df.collect()
    flagged = df.withColumn("is_invalid_physical", quality.is_invalid_physical())
    assert _flags(quality.null_severe(flagged), "value") == [1.0, None]


def test_plateau_marks_trail(readings, sizes):
    """From the eighth equal value until seven rows after the plateau; shorter plateaus never."""
    values = [1.0, 2.0, 1.5] + [7.0] * 10 + [1.0, 2.0] * 8 + [3.0] * 7 + [4.0]
    df = readings([(t, "acc_rms_radial", v) for t, v in zip(_times(len(values)), values)])
    stuck = [r.reading_id for r in quality.flag_sequence_anomalies(df).where("is_stuck_value").orderBy("reading_id").collect()]
    assert stuck == list(range(10, 20))


def test_jump_and_noise(readings, sizes):
    values = [1.0, 1.5, 9.0, None, 9.0, 9.1, 9.2, 9.3]
    df = quality.flag_sequence_anomalies(readings([(t, "acc_rms_radial", v) for t, v in zip(_times(8), values)]))
    assert _flags(df, "is_excessive_jump") == [False, False, True, False, False, False, False, False]
    assert not any(_flags(df, "is_excessive_noise")[:7])
    other = quality.flag_sequence_anomalies(readings([(t, "bearing_condition", 100.0 * i) for i, t in enumerate(_times(8))]))
    assert not any(_flags(other, "is_excessive_jump") + _flags(other, "is_excessive_noise"))


def test_code_and_flag_reports(spark):
    df = spark.createDataFrame([(0, True), (0, False), (7, False), (3, False)], "quality_code int, is_gap boolean")
    counts = {r.quality_code: (r.label, r.n, r.percent) for r in quality.code_counts(df).collect()}
    assert counts == {0: ("OK", 2, 50.0), 7: ("Desconocido", 1, 25.0), 3: ("Valor extremo", 1, 25.0)}
    flags = {r.flag: r.n for r in quality.flag_counts(df, ["is_gap", "is_high"]).collect()}
    assert flags == {"is_gap": 1, "is_high": None}


def test_catalog(spark):
    assert len(catalog.CATALOG) == 22
    groups = {r.group: r["count"] for r in catalog.catalog_frame(spark).groupBy("group").count().collect()}
    assert groups == {"vibration": 11, "physical": 4, "categorical": 5, "accumulative": 2}
    names = spark.createDataFrame([("Skin Temperature",), ("skin_temp",), ("new one",)], "variable string")
    assert [r[0] for r in names.select(catalog.canonical_of()).collect()] == ["skin_temp", "skin_temp", "new one"]
    assert [r[0] for r in names.select(catalog.group_of()).collect()] == ["physical", "physical", "unknown"]
