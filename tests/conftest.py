from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.maxMetadataStringLength", "10000")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluates a column built from literal rows of one string column ``x``."""
    def run(values, make, kind="string"):
        from pyspark.sql import functions as F
        df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
        return [r["y"] for r in df.select(make(F.col("x")).alias("y")).collect()]
    return run
