"""Grouped reports over readings or the feature table.

Each report is one partial-then-final aggregate, so a dominant station or
pollutant is combined inside the map tasks. Sorts carry the group key as a
tie-break, which makes the order repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.schema import HIGH_VALUE, SERIES, STATION


def category_counts(readings: DataFrame) -> DataFrame:
    """Readings per pollutant, most frequent first."""
    counts = readings.groupBy("pollutant").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), "pollutant")


def city_summary(readings: DataFrame) -> DataFrame:
    """Rows and number of locations per city, largest first.

    Rows are first counted per (city, location), so a large city is not
    gathered before its locations are counted.
    """
    per_station = readings.groupBy(*STATION).agg(F.count(F.lit(1)).alias("_n"))
    per_city = per_station.groupBy("city").agg(
        F.sum("_n").alias("num_rows"),
        F.count("location").alias("num_locations"),
    )
    return per_city.orderBy(F.desc("num_rows"), "city")


def station_exposure(readings: DataFrame) -> DataFrame:
    """Average and peak value and number of readings per station, worst first."""
    exposure = readings.groupBy(*STATION).agg(
        F.avg("value").alias("avg_pollution"),
        F.max("value").alias("peak_pollution"),
        F.count(F.lit(1)).alias("num_measurements"),
    )
    return exposure.orderBy(F.desc("avg_pollution"), *STATION)


def hourly_peaks(features: DataFrame) -> DataFrame:
    """Average value per hour of day and pollutant, highest first."""
    peaks = features.groupBy("hour", "pollutant").agg(F.avg("value").alias("avg_value"))
    return peaks.orderBy(F.desc("avg_value"), "hour", "pollutant")


def pollutant_stats(readings: DataFrame) -> DataFrame:
    """Average, extremes and count per pollutant, highest average first."""
    stats = readings.groupBy("pollutant").agg(
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("num_measurements"),
    )
    return stats.orderBy(F.desc("avg_value"), "pollutant")


def season_stats(features: DataFrame) -> DataFrame:
    """Average and highest value per season and pollutant."""
    stats = features.groupBy("season", "pollutant").agg(
        F.avg("value").alias("avg_value"), F.max("value").alias("max_value")
    )
    return stats.orderBy("season", "pollutant")


def month_stats(features: DataFrame) -> DataFrame:
    """Average value per month and pollutant."""
    stats = features.groupBy("month", "pollutant").agg(F.avg("value").alias("avg_value"))
    return stats.orderBy("month", "pollutant")


def weekend_stats(features: DataFrame) -> DataFrame:
    """Average value per pollutant on weekends and weekdays, weekends first."""
    stats = features.groupBy("is_weekend", "pollutant").agg(F.avg("value").alias("avg_value"))
    return stats.orderBy(F.desc("is_weekend"), "pollutant")


def high_events(readings: DataFrame, threshold: float = HIGH_VALUE) -> DataFrame:
    """Readings above the threshold per series, most first."""
    events = (
        readings.where(F.col("value") > threshold)
        .groupBy(*SERIES)
        .agg(F.count(F.lit(1)).alias("high_pollution_count"))
    )
    return events.orderBy(F.desc("high_pollution_count"), *SERIES)


def rolling_summary(features: DataFrame) -> DataFrame:
    """Rolling columns condensed to one row per series, highest mean first."""
    summary = features.groupBy(*SERIES).agg(
        F.avg("rolling_mean_3h").alias("avg_rolling_mean"),
        F.max("rolling_max_3h").alias("max_rolling"),
        F.min("rolling_min_3h").alias("min_rolling"),
    )
    return summary.orderBy(F.desc("avg_rolling_mean"), *SERIES)


def anomaly_3sigma(readings: DataFrame, sigmas: float = 3.0) -> DataFrame:
    """Readings more than ``sigmas`` sample deviations from the global mean.

    The two numbers are a scalar subquery: computed once by Spark, no trip
    through the driver program.
    """
    spread = readings.agg(
        F.struct(F.avg("value").alias("mean"), F.stddev("value").alias("std"))
    ).scalar()
    distance = F.abs(F.col("value") - spread["mean"])
    return readings.where(distance > sigmas * spread["std"])


def daily_trend(readings: DataFrame) -> DataFrame:
    """Average, extremes and count per day and pollutant."""
    trend = readings.groupBy(F.to_date("last_updated").alias("date"), "pollutant").agg(
        F.avg("value").alias("avg_value"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count(F.lit(1)).alias("num_measurements"),
    )
    return trend.orderBy("date", "pollutant")


def variance_patterns(readings: DataFrame) -> DataFrame:
    """Spread of each series: variance, deviation and deviation over mean."""
    spread = readings.groupBy(*SERIES).agg(
        F.variance("value").alias("variance"),
        F.stddev("value").alias("stddev"),
        F.try_divide(F.stddev("value"), F.avg("value")).alias("variation"),
        F.count("value").alias("num_readings"),
    )
    return spread.orderBy(F.desc("variance"), *SERIES)
