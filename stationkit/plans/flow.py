"""The whole flow from raw files to stored features and reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.operators import clean, reports
from stationkit.operators.features import build_features
from stationkit.plans.stored import store
from stationkit.schema import SERIES, STATION
from stationkit.sources.files import read_csv_checked, write_table


@dataclass(frozen=True)
class Run:
    """Tables a run leaves behind."""

    readings: DataFrame
    quarantine: DataFrame
    features: DataFrame


def ingest_files(spark: SparkSession, path: str, sep: str = ";") -> tuple[DataFrame, DataFrame]:
    """Clean readings of delimited files, and the lines that could not be read."""
    good, bad = read_csv_checked(spark, path, sep=sep)
    return clean.clean_readings(good), bad


def run(spark: SparkSession, path: str, out: str, min_city_rows: int = 3) -> Run:
    """Clean, derive features and write both tables under ``out``.

    The cleaned readings are stored once; every later step scans that columnar
    table instead of parsing and de-duplicating the text again.
    """
    readings, quarantine = ingest_files(spark, path)
    stored = store(readings, "clean").df
    kept = clean.min_group_rows(stored, "city", min_city_rows)
    write_table(kept, f"{out}/readings")
    cleaned = spark.read.schema(kept.schema).parquet(f"{out}/readings")
    features = build_features(cleaned)
    write_table(features, f"{out}/features")
    return Run(
        cleaned, quarantine, spark.read.schema(features.schema).parquet(f"{out}/features")
    )


_CELL = [*SERIES, "hour", "month", "season", "is_weekend"]


def rollup(features: DataFrame) -> DataFrame:
    """Sums of the readings at the finest grain the reports need, stored once.

    A table of readings shrinks to at most a few hundred cells per series.
    """
    cells = features.groupBy(*_CELL).agg(
        F.sum("value").alias("_sum"),
        F.count("value").alias("_values"),
        F.max("value").alias("_max"),
        F.min("value").alias("_min"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return store(cells, "cells").df


def reports_from_rollup(cells: DataFrame) -> dict[str, DataFrame]:
    """The grouped reports, all derived from the cells instead of the readings."""
    average = F.try_divide(F.sum("_sum"), F.sum("_values")).alias("avg_value")
    high, low = F.max("_max").alias("max_value"), F.min("_min").alias("min_value")
    rows = F.sum("_rows").alias("num_measurements")
    return {
        "station_exposure": cells.groupBy(*STATION).agg(
            average.alias("avg_pollution"), high.alias("peak_pollution"), rows
        ),
        "hourly_peaks": cells.groupBy("hour", "pollutant").agg(average),
        "pollutant_stats": cells.groupBy("pollutant").agg(average, low, high, rows),
        "season_stats": cells.groupBy("season", "pollutant").agg(average, high),
        "month_stats": cells.groupBy("month", "pollutant").agg(average),
        "weekend_stats": cells.groupBy("is_weekend", "pollutant").agg(average),
    }


def reports_from_features(features: DataFrame) -> dict[str, DataFrame]:
    """The same reports, each straight from the readings."""
    return {
        name: getattr(reports, name)(features)
        for name in (
            "station_exposure",
            "hourly_peaks",
            "pollutant_stats",
            "season_stats",
            "month_stats",
            "weekend_stats",
        )
    }
