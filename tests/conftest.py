from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sluice-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file:{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def put(name: str, value: str) -> None:
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def root(tmp_path):
    return f"file:{tmp_path}"
