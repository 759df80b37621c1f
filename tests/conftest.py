import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("stationkit-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(autouse=True)
def settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.fixture
def make_readings(spark):
    """Readings from (city, location, pollutant, value, epoch seconds) tuples."""

    def make(rows):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(
            rows, "city string, location string, pollutant string, value double, ts bigint"
        )
        return df.withColumn("last_updated", F.timestamp_seconds("ts"))

    return make
