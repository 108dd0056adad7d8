from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from clicklens.operators.skew import LARGE_GROUP_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["ordinary", "large"])
def groups(request, spark):
    """Runs a test twice; the second time nearly every group counts as large."""
    if request.param == "large":
        spark.conf.set(LARGE_GROUP_CONF, "3")
    yield request.param
    spark.conf.unset(LARGE_GROUP_CONF)
