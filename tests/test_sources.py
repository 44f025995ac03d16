"""Scans, deployment joins and writes."""

from __future__ import annotations

import datetime as dt
import pathlib

import pytest
from fixtures import at
from pyspark.sql import functions as F

from sensorweave import schema, session
from sensorweave.sources import readings as scans
from sensorweave.sources import sinks


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (i, f"a{i % 2}", f"m{i % 3}", at("01 00:00:00") + dt.timedelta(hours=i), "speed" if i % 4 else "skin_temp", float(i))
        for i in range(72)
    ]
    return spark.createDataFrame(
        rows, "reading_id long, asset_code string, motor_code string, ts_utc timestamp, variable string, value double"
    )


def test_range_scan_is_half_open(raw):
    got = scans.range_scan(raw, "a0", at("01 02:00:00"), at("01 06:00:00"))
    assert got.columns == ["ts_utc", "variable", "value"]
    assert [r.value for r in got.collect()] == [2.0, 4.0]
    assert scans.range_scan(raw, "a0").count() == 36


def test_filters_reach_the_file_scan(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "raw"))
    got = scans.range_scan(scans.read_readings(spark, str(tmp_path / "raw")), "a0", at("01 02:00:00"), at("01 06:00:00"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(ts_utc" in pushed and "LessThan(ts_utc" in pushed and "EqualTo(asset_code,a0)" in pushed
    assert "motor_code" not in plan.split("ReadSchema: ")[1]


def test_listing_filters_are_optional(raw):
    assert scans.listing(raw).count() == 72
    assert scans.listing(raw, motor_code="m1", variable="skin_temp").count() == 6


def test_until_date_includes_the_day(raw):
    assert scans.until_date(raw, "speed", dt.date(2024, 1, 1)).count() == 18


def _deployments(spark):
    rows = [
        (1, "a0", "m0", at("01 00:00:00"), at("01 12:00:00")),
        (2, "a0", "m0", at("01 06:00:00"), at("03 00:00:00")),
        (3, "a1", "m1", at("01 00:00:00"), None),
        (4, "a1", "m1", at("02 00:00:00"), at("02 00:00:00")),
    ]
    return spark.createDataFrame(
        rows, "deployment_id long, asset_code string, motor_code string, start_ts timestamp, end_ts timestamp"
    )


def test_deployment_join(spark, raw, sizes):
    got = scans.deployment_readings(raw, _deployments(spark))
    found = sorted((r.deployment_id, r.reading_id) for r in got.collect())
    assert found == [(1, 0), (1, 6)] + [(2, i) for i in range(6, 48, 6)]


def test_load_one_deployment(spark, raw):
    assert scans.load_deployment(raw, _deployments(spark), 1).count() == 2
    with pytest.raises(ValueError, match="still running"):
        scans.load_deployment(raw, _deployments(spark), 3)
    with pytest.raises(ValueError, match="not found"):
        scans.load_deployment(raw, _deployments(spark), 9)


def _measured(raw):
    return raw.select(
        F.lit(1).alias("deployment_id"), "ts_utc", "variable", "value", (F.col("reading_id") % 2).alias("quality_code")
    )


def test_writes_can_be_repeated(spark, raw, tmp_path):
    path, rows = str(tmp_path / "table"), _measured(raw)
    assert sinks.write_measurements(rows.where("value < 40"), path, quality=[0]) == (20, 0, 0)
    untimed = rows.limit(3).withColumn("ts_utc", F.lit(None).cast("timestamp"))
    again = rows.unionByName(rows).unionByName(untimed)
    assert sinks.write_measurements(again, path) == (52, 92, 3)
    assert sinks.write_measurements(rows, path) == (0, 72, 0)
    assert sinks.write_measurements(untimed, path) == (0, 0, 3)
    stored = scans.load_measurements(spark.read.parquet(path), [1], "speed")
    assert stored.count() == 54


def test_feature_write_checks_columns(raw, tmp_path):
    with pytest.raises(ValueError, match="feature"):
        sinks.write_features(_measured(raw), str(tmp_path / "features"))


def test_csv_scan(spark, tmp_path):
    header = "reading_id,asset_code,motor_code,ts_utc,ts_local,variable,value"
    (tmp_path / "r.csv").write_text(f"{header}\n1,a,m,2024-01-01 00:00:00,2024-01-01 00:00:00,Speed,ON\n2,a,m,2024-01-01 00:15:00,,Speed,1.5\n")
    rows = scans.read_csv(spark, str(tmp_path / "r.csv")).orderBy("reading_id").collect()
    assert [(r.ts_utc, r.value) for r in rows] == [(at("01 00:00:00"), "ON"), (at("01 00:15:00"), "1.5")]


def test_clean_rows_from_wide(spark):
    wide = spark.createDataFrame(
        [(1, at("01 00:00:00"), 5.0, None, 1.0)], "deployment_id long, ts_slot timestamp, speed double, skin_temp double, speed_SMOOTH double"
    )
    rows = sinks.clean_rows_from_wide(wide, "tag", local_time=True).collect()
    assert [(r.variable, r.value, r.source_tag, r.ts_local) for r in rows] == [("Speed", 5.0, "tag", at("01 00:00:00"))]


def test_long_export(spark, raw, tmp_path):
    rows = _measured(raw)
    sinks.export_long(rows, rows, str(tmp_path))
    back = spark.read.option("header", True).csv(str(tmp_path / "quality"))
    assert "variable_original" in back.columns and back.count() == 72


def test_foreign_table_is_refused(spark, tmp_path):
    """A folder with another layout is an error, not an empty table."""
    rows = spark.createDataFrame([(1, at("01 00:00:00"), "a", 1.0, 0)], schema.MEASUREMENTS)
    other = f"{tmp_path}/other"
    rows.write.parquet(other)
    with pytest.raises(ValueError, match="day"):
        sinks.write_measurements(rows, other)
    assert sinks.write_measurements(rows, f"{tmp_path}/new") == (1, 0, 0)
    assert sinks.write_measurements(rows, f"{tmp_path}/new") == (0, 1, 0)


def test_batch_is_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("timestamp")
    def counted(ts):
        seen.add(1)
        return ts

    rows = spark.range(50).selectExpr(
        "1L AS deployment_id", "timestamp_seconds(1704067200 + id * 500) AS ts_utc", "'v' AS variable", "1.0D AS value", "0 AS quality_code"
    )
    assert sinks.write_measurements(rows.withColumn("ts_utc", counted("ts_utc")), f"{tmp_path}/t") == (50, 0, 0)
    assert seen.value == 50


def test_few_files_a_day(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = spark.range(4000).selectExpr(
            "id % 5 AS deployment_id", "timestamp_seconds(1704067200 + id * 500) AS ts_utc", "'v' AS variable", "1.0D AS value", "0 AS quality_code"
        )
        assert sinks.write_measurements(rows, f"{tmp_path}/t").inserted == 4000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = list((tmp_path / "t").glob("day=*/part-*.parquet"))
    assert len(files) <= len(list((tmp_path / "t").glob("day=*"))) + 8


def test_one_writer_at_a_time(spark, tmp_path):
    """A second writer is refused; the mark goes with the write, also when it fails, and no reader sees it."""
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, at("01 00:00:00"), "speed", 1.0, 0)], "deployment_id long, ts_utc timestamp, variable string, value double, quality_code int")
    with sinks.only_writer(spark, path), pytest.raises(RuntimeError, match="another writer"):
        sinks.write_measurements(rows, path)
    with pytest.raises(Exception, match="lost"):
        sinks.write_measurements(rows.withColumn("value", F.raise_error(F.lit("lost")).cast("double")), path)
    assert sinks.write_measurements(rows, path) == (1, 0, 0)
    assert sinks.write_measurements(rows, path) == (0, 1, 0)
    assert spark.read.parquet(path).count() == 1 and not (tmp_path / "table" / "_writer").exists()


def test_cuts_are_discarded(spark, monkeypatch):
    monkeypatch.setattr(session, "_written", {})  # not those of other tests
    first, second = (session.materialise(spark.range(3), "cut") for _ in range(2))
    folders = [f.rsplit("/", 1)[0].removeprefix("file://") for f in (*first.inputFiles(), *second.inputFiles())]
    assert all(pathlib.Path(f).exists() for f in folders)
    assert session.discard(spark) == 2 and not any(pathlib.Path(f).exists() for f in folders)
    assert session.discard(spark) == 0
