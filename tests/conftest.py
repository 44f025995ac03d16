from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from fixtures import at  # noqa: E402

from sensorweave.session import local_session  # noqa: E402

# sizes small enough that the fixtures are cut into several chunks, blocks and salts
TINY = {"splitRows": 3, "blockRows": 16, "rankedRows": 5, "cells": 8}


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "4g", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    session.conf.set("spark.sql.maxMetadataStringLength", "1000")
    return session


@pytest.fixture(params=["plain", "tiny"])
def sizes(request, spark):
    """Run a test with the default sizes and again with everything cut small."""
    if request.param == "tiny":
        for name, value in TINY.items():
            spark.conf.set(f"spark.sensorweave.{name}", str(value))
    yield request.param
    for name in TINY:
        spark.conf.unset(f"spark.sensorweave.{name}")


@pytest.fixture(scope="session")
def readings(spark):
    """readings([(time, variable, value), ...]) -> frame of one deployment, ids in list order."""

    def build(rows, deployment=1):
        data = [(i, deployment, at(t), v, x) for i, (t, v, x) in enumerate(rows)]
        return spark.createDataFrame(
            data, "reading_id long, deployment_id long, ts_utc timestamp, variable string, value double"
        )

    return build


@pytest.fixture(scope="session")
def series(spark):
    """series(values, step_s) -> observed slots of one variable; None values are not observed."""

    def build(values, variable="acc_rms_radial", step_s=900, deployment=1, keep_null=True):
        start = at("01 00:00:00")
        rows = [
            (deployment, variable, start + dt.timedelta(seconds=step_s * i), None if x is None else float(x))
            for i, x in enumerate(values)
            if keep_null or x is not None
        ]
        return spark.createDataFrame(rows, "deployment_id long, variable string, ts_slot timestamp, value double")

    return build
