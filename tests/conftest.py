from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tallybook-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .config("spark.checkpoint.dir", str(scratch / "checkpoint"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def medium():
    return MEDIUM
