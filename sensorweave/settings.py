"""Sizes that decide how far a large group is cut. Set `spark.sensorweave.<name>` to change one."""

from __future__ import annotations

from pyspark.sql import DataFrame

DEFAULTS = {
    "chunkSeconds": 86_400,  # width of a time chunk of a series
    "frameSeconds": 366 * 86_400,  # the same for wide frames, where a day may be a single row
    "splitRows": 4_000_000,  # a chunk or key with more rows is cut
    "blockRows": 65_536,  # positions in a block of a series
    "rankedRows": 100_000,  # a bin up to this size is ranked without a further cut
    "cells": 1 << 20,  # cells a larger one is cut into
    "dftLength": 65_536,  # a window up to this many samples is transformed in one group, n log n
}


def setting(df: DataFrame, name: str) -> int:
    return int(df.sparkSession.conf.get(f"spark.sensorweave.{name}", str(DEFAULTS[name])))
