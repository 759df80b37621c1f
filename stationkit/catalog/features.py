"""Feature queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.catalog.base import CALENDAR, DATED, FEATURES, Query, r4, readings, shown, table
from stationkit.functions.calendar import calendar_columns
from stationkit.operators import features as ops

_FIVE = f"city, location, pollutant, {r4('value')}, last_updated"
_ROLLED = ", ".join(r4(f"rolling_{f}_3h") for f in ("mean", "max", "min"))


def calendar_features(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.calendar_features(readings(spark, folder)))


def calendar_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Calendar parts over seven years of order dates."""
    dated = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    parts = calendar_columns(F.col("o_orderdate"))
    return shown(dated.withColumns(parts))


def series_stats(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.with_series_stats(readings(spark, folder)))


def series_count(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.series_count(readings(spark, folder)))


def global_index(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.global_index(readings(spark, folder)))


def zscore(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.zscore(readings(spark, folder)))


def _timed(spark: SparkSession, folder: str) -> DataFrame:
    return readings(spark, folder).withColumn("ts", F.unix_timestamp("last_updated"))


def rolling_3h(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.rolling(_timed(spark, folder)))


def rolling_3h_by_type(spark: SparkSession, folder: str) -> DataFrame:
    """Few, long series: every frame holds many readings."""
    return shown(ops.rolling(_timed(spark, folder), keys=["pollutant"]))


def feature_table(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.build_features(readings(spark, folder)))


_WEEK = "CAST(week(last_updated) AS INTEGER) AS week"
_DOUBLES = {
    "value", "avg_value", "max_value", "min_value", "global_index", "rolling_mean_3h",
    "rolling_max_3h", "rolling_min_3h", "value_z_score_by_pollutant",
}
ALL_FEATURES = ", ".join(r4(c) if c in _DOUBLES else c for c in ops.FEATURE_COLUMNS)

QUERIES = {
    "calendar_features": Query(
        calendar_features,
        f"""WITH {DATED} SELECT {_FIVE}, hour, day, month, year, {_WEEK}, is_weekend, season, ts,
        is_rush_hour FROM dated""",
    ),
    "calendar_orders": Query(
        calendar_orders,
        f"""WITH named AS (SELECT o_orderkey, o_orderdate AS last_updated FROM orders)
        SELECT o_orderkey, last_updated AS o_orderdate, {CALENDAR}, {_WEEK} FROM named""",
    ),
    "series_stats": Query(
        series_stats,
        f"""WITH {FEATURES} SELECT {_FIVE}, {r4("avg_value")}, {r4("max_value")},
        {r4("min_value")}, num_readings FROM features""",
    ),
    "series_count": Query(
        series_count, f"WITH {FEATURES} SELECT {_FIVE}, station_pollutant_count FROM features"
    ),
    "global_index": Query(
        global_index, f"WITH {FEATURES} SELECT {_FIVE}, {r4('global_index')} FROM features"
    ),
    "zscore": Query(
        zscore, f"WITH {FEATURES} SELECT {_FIVE}, {r4('value_z_score_by_pollutant')} FROM features"
    ),
    "rolling_3h": Query(rolling_3h, f"WITH {FEATURES} SELECT {_FIVE}, ts, {_ROLLED} FROM features"),
    "rolling_3h_by_type": Query(
        rolling_3h_by_type,
        f"""WITH {DATED}, rolled AS (SELECT *, avg(value) OVER h AS rolling_mean_3h,
        max(value) OVER h AS rolling_max_3h, min(value) OVER h AS rolling_min_3h FROM dated
        WINDOW h AS (PARTITION BY pollutant ORDER BY ts
                     RANGE BETWEEN 10800 PRECEDING AND CURRENT ROW))
        SELECT {_FIVE}, ts, {_ROLLED} FROM rolled""",
    ),
    "feature_table": Query(feature_table, f"WITH {FEATURES} SELECT {ALL_FEATURES} FROM features"),
}
