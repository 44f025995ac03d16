"""Session set-up: the settings every operator relies on, and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators assume. Co-partitioning on *all* join keys must stay
# on: with it off Spark may line a (series, chunk) join up on the series alone, which
# puts a hot series back into one task.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "20g", app: str = "sensorweave") -> SparkSession:
    """A single-machine session for tests and the bench; on a cluster use `configure`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder for lineage cuts: the cluster's own, or (local master only) a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_written: dict[str, list[str]] = {}  # application -> folders of its cuts


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: a lineage cut that outlives executors.

    The folder stays until `discard`, as results may be read from it at any time.
    """
    spark = df.sparkSession
    path = os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> int:
    """Delete the lineage cuts of this application, once its results are stored elsewhere. Their number."""
    folders = _written.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(folders)
