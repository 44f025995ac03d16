"""What the corpus operators share: session set-up, written cuts, keyed hashes of rows."""

from __future__ import annotations

import ctypes
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sensorweave.session import configure, materialise

ROOT = str(Path(__file__).resolve().parents[2])
GOLDEN = 0x9E3779B97F4A7C15

# rows and bytes that one Arrow batch may hold: bounds what a Python worker has in hand;
# samples of up to so many rows a group are cut in every task before they meet
SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings and a worker path on which this package is found."""
    configure(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{known}".rstrip(":")
    return spark


def cut(df: DataFrame, label: str) -> DataFrame:
    """A lineage cut: `df` as a table in the cluster's shared folder."""
    return materialise(df, f"llm-{label}")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def widened(df: DataFrame, more: str) -> StructType:
    """The schema of `df` with the columns `more` (DDL, nullable): at the end, or in place if they exist."""
    new = {f.name: f for f in StructType.fromDDL(more)}
    kept = [new.pop(f.name, f) for f in df.schema]
    return StructType([*kept, *new.values()])


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo `folds`; NULL for a NULL key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64 (splitmix)."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return memory to the system that earlier tasks of this Python worker freed: Spark hands a worker on
    from stage to stage, and what it freed would stay with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim is not None:
        trim(0)


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def public_tokenizer(name: str) -> str:
    """Path of a vocabulary file of the public tokenizers, the same on driver and executors."""
    import public_tokenizers

    return str(public_tokenizers.path(name))
