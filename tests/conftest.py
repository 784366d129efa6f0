from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


def make_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("pathproof-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    yield make_session()
