"""Writes: repeatable appends of measurements and features, long rows from a wide frame, CSV."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave import catalog, schema
from sensorweave.operators.grid import rename_to_source, unpivot_long
from sensorweave.schema import require, to_number
from sensorweave.session import materialise

MEASUREMENT_KEY = ["deployment_id", "ts_utc", "variable"]
FEATURE_KEY = ["deployment_id", "ts_utc", "variable", "feature", "window_s"]
DAY = "day"


class Written(NamedTuple):
    inserted: int
    skipped: int
    failed: int


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds anything but hidden files; asked of the file system itself."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in system.listStatus(folder))


def _stored(spark: SparkSession, path: str, first, last, fields: Sequence[str]) -> DataFrame | None:
    """The stored rows of a range of days, or None when there is no table yet.

    A folder with anything else in it than such a table is refused; errors of reading are not caught.
    """
    if not _has_files(spark, path):
        return None
    stored = spark.read.parquet(path)
    missing = [f for f in [*fields, DAY] if f not in stored.columns]
    if missing:
        raise ValueError(f"{path} holds another table: it has no {', '.join(missing)}")
    return stored.where(F.col(DAY).between(F.lit(first), F.lit(last)))


@contextmanager
def only_writer(spark: SparkSession, path: str):
    """Hold the table's writer mark: a hidden file that the file system creates for one writer alone.

    A second writer is refused, so that two cannot both miss a key in the stored rows and insert it. The
    mark goes when the write ends, also by an error; one that a killed driver left is removed by hand.
    """
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_writer")
    system = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(mark.getParent())
    if not system.createNewFile(mark):
        raise RuntimeError(f"another writer holds {path}; if there is none, remove {path}/_writer")
    try:
        yield
    finally:
        system.delete(mark, False)


def _append_new(df: DataFrame, path: str, keys: Sequence[str], table_schema) -> Written:
    """`_append` as the only writer."""
    with only_writer(df.sparkSession, path):
        return _append(df, path, keys, table_schema)


def _append(df: DataFrame, path: str, keys: Sequence[str], table_schema) -> Written:
    """Append the rows whose key the table does not hold yet.

    Rows without a time fail; of several rows with one key the smallest by content is kept.
    A write that dies half-way commits nothing, and running it again adds what is missing.
    Files are partitioned by day, so only the days of the batch are compared, and sorted
    by deployment, so a deployment is found by row-group statistics however many there
    are; rows go to the writers by ranges of (day, deployment, time), so that the number of
    files is about that of partitions and days together. The counts come from the data (file footers for the table), not from accumulators,
    and stay right when tasks are run again. The batch is read three times (size, ranges, rows), so
    it is evaluated once, into the shared folder.
    """
    spark = df.sparkSession
    batch = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema.fields])
    batch = materialise(batch.withColumn(DAY, F.to_date("ts_utc")), "batch")
    timed = F.col("ts_utc").isNotNull()
    size = batch.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~timed).alias("failed"),
        F.min(DAY).alias("first"),
        F.max(DAY).alias("last"),
    ).first()
    if size["rows"] == size["failed"]:
        return Written(0, 0, size["failed"])
    rest = [f.name for f in table_schema.fields if f.name not in keys]
    new = batch.where(timed).groupBy(DAY, *keys).agg(F.min(F.struct(*rest)).alias("_rest"))
    new = new.select(DAY, *keys, "_rest.*")
    names = [f.name for f in table_schema.fields]
    stored = _stored(spark, path, size["first"], size["last"], names)
    before = 0
    if stored is not None:
        before = stored.count()
        new = new.join(stored.select(DAY, *keys), [DAY, *keys], "left_anti")
    # ranges of (day, deployment, time): a day is in few files, and a day of any size in more than one
    new = new.repartitionByRange(DAY, "deployment_id", "ts_utc").sortWithinPartitions(DAY, "deployment_id", "ts_utc")
    new.write.mode("append").partitionBy(DAY).parquet(path)
    after = _stored(spark, path, size["first"], size["last"], names)
    inserted = (after.count() if after is not None else 0) - before
    return Written(inserted, size["rows"] - size["failed"] - inserted, size["failed"])


def write_measurements(df: DataFrame, path: str, quality: Iterable[int] | None = None) -> Written:
    """Append measurements, optionally only those with one of the given quality codes."""
    require(df, *schema.MEASUREMENTS.names)
    if quality is not None:
        df = df.where(F.col("quality_code").isin(list(quality)))
    return _append_new(df.withColumn("value", to_number(F.col("value"))), path, MEASUREMENT_KEY, schema.MEASUREMENTS)


def write_features(df: DataFrame, path: str) -> Written:
    """Append feature rows; a NULL value is kept."""
    require(df, *schema.FEATURES.names)
    return _append_new(df, path, FEATURE_KEY, schema.FEATURES)


def clean_rows_from_wide(
    wide: DataFrame, source_tag: str, ts: str = "ts_slot", local_time: bool = False
) -> DataFrame:
    """Long rows (source names, no NULL values) of the catalog columns of a wide frame."""
    names = [c for c in catalog.CANONICAL_NAMES if c in wide.columns]
    if not names:
        raise ValueError("no catalog column in the frame")
    renamed = rename_to_source(wide.select("deployment_id", F.col(ts).alias("ts_utc"), *names))
    sources = [catalog.TO_SOURCE[n] for n in names]
    long = unpivot_long(renamed, [f"`{s}`" for s in sources], ("deployment_id", "ts_utc"), keep_null=False)
    long = long.withColumn("source_tag", F.lit(source_tag))
    return long.withColumn("ts_local", F.col("ts_utc")) if local_time else long


def append_wide(wide: DataFrame, path: str, source_tag: str, ts: str = "ts_slot") -> None:
    clean_rows_from_wide(wide, source_tag, ts).write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str, by_deployment: bool = True, mode: str = "errorifexists") -> None:
    """CSV with a header, one folder per deployment; ranges of (deployment, time) go to the writers."""
    if by_deployment:
        df = df.repartitionByRange("deployment_id", *[c for c in ("ts_utc", "ts_slot") if c in df.columns])
    writer = df.write.mode(mode).option("header", True)
    if by_deployment:
        writer = writer.partitionBy("deployment_id")
    writer.csv(path)


def export_wide(values: DataFrame, codes: DataFrame, folder: str) -> None:
    export_csv(values, f"{folder}/values")
    export_csv(codes, f"{folder}/codes")


def export_long(quality: DataFrame, clean: DataFrame, folder: str) -> None:
    export_csv(quality.withColumnRenamed("variable", "variable_original"), f"{folder}/quality")
    export_csv(clean, f"{folder}/clean")
