import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("edgeloom-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Settings small enough that the skew paths run on fixtures.
TINY = {"hotRows": 3, "pairRows": 2, "rowsPerPartition": 8, "topRows": 2, "broadcastRows": 0, "unionFrames": 3}


@pytest.fixture(params=["plain", "skewed"])
def mode(request, spark):
    """Every algorithm test runs twice: with default settings and with all groups split."""
    if request.param == "skewed":
        for name, value in TINY.items():
            spark.conf.set(f"spark.edgeloom.{name}", str(value))
    yield request.param
    for name in TINY:
        spark.conf.unset(f"spark.edgeloom.{name}")
