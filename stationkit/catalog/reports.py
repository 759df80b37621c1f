"""Report, correlation and anomaly queries."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.catalog.base import DATED, FEATURES, READINGS, Query, r4, readings, shown
from stationkit.operators import features, relations
from stationkit.operators import reports as ops
from stationkit.plans import flow

# The event types of the SQL below; the queries take theirs from the data.
TYPES = ["click", "error", "purchase", "signup", "view"]


def _on_readings(operator):
    return lambda spark, folder: shown(operator(readings(spark, folder)))


def _on_dated(operator):
    return lambda spark, folder: shown(
        operator(features.calendar_features(readings(spark, folder)))
    )


def _pivot(spark: SparkSession, folder: str) -> DataFrame:
    day = F.date_trunc("day", "last_updated")
    return relations.pollutant_pivot(readings(spark, folder), time=day)


def pollutant_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return shown(_pivot(spark, folder))


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    """Average of each pollutant per station and day, in long form."""
    cell = F.struct("city", "location", F.date_trunc("day", "last_updated").alias("day")).alias("cell")
    rows = readings(spark, folder).select(cell, "pollutant", "value")
    return rows.groupBy("cell", "pollutant").agg(F.avg("value").alias("level"))


def pollutant_corr(spark: SparkSession, folder: str) -> DataFrame:
    return shown(relations.pollutant_corr_long(_daily(spark, folder)))


def pollutant_corr_pairwise(spark: SparkSession, folder: str) -> DataFrame:
    return shown(relations.pollutant_corr_long(_daily(spark, folder), missing="pairwise"))


def rolling_summary(spark: SparkSession, folder: str) -> DataFrame:
    timed = readings(spark, folder).withColumn("ts", F.unix_timestamp("last_updated"))
    return shown(ops.rolling_summary(features.rolling(timed)))


def hour_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return shown(relations.hour_profiles(readings(spark, folder)))


def reports_from_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Two of the reports derived from one stored rollup of the readings."""
    cells = flow.rollup(features.calendar_features(readings(spark, folder)))
    derived = flow.reports_from_rollup(cells)
    stations = derived["station_exposure"].select(
        F.concat_ws("/", "city", "location").alias("name"), F.col("avg_pollution").alias("level")
    )
    hours = derived["hourly_peaks"].select(
        F.concat_ws("/", F.col("hour").cast("string"), "pollutant").alias("name"),
        F.col("avg_value").alias("level"),
    )
    return shown(stations.unionByName(hours))


_AVG = r4("avg(value)", "avg_value")
_MAX = r4("max(value)", "max_value")
_MIN = r4("min(value)", "min_value")
_N = "count(*) AS num_measurements"
_DAILY = f"""{READINGS}, daily AS (
  SELECT city, location, date_trunc('day', last_updated) AS last_updated,
  {", ".join(f"avg(value) FILTER (pollutant = '{t}') AS {t}" for t in TYPES)}
  FROM readings GROUP BY ALL)"""


def _corr_sql(zero: bool) -> str:
    def used(name: str) -> str:
        return f"coalesce({name}, 0)" if zero else name

    return f"WITH {_DAILY} " + " UNION ALL ".join(
        f"""SELECT '{a}' AS pollutant_a, '{b}' AS pollutant_b,
        {r4(f"corr({used(a)}, {used(b)})", "corr")} FROM daily"""
        for a, b in combinations(TYPES, 2)
    )


def _report_sql(source: str, keys: str, measures: str) -> str:
    return f"WITH {source} SELECT {keys}, {measures} FROM {'dated' if source is DATED else 'readings'} GROUP BY ALL"


QUERIES = {
    "category_counts": Query(
        _on_readings(ops.category_counts), _report_sql(READINGS, "pollutant", "count(*) AS count")
    ),
    "city_summary": Query(
        _on_readings(ops.city_summary),
        _report_sql(
            READINGS, "city", "count(*) AS num_rows, count(DISTINCT location) AS num_locations"
        ),
    ),
    "station_exposure": Query(
        _on_readings(ops.station_exposure),
        _report_sql(
            READINGS,
            "city, location",
            f"{r4('avg(value)', 'avg_pollution')}, {r4('max(value)', 'peak_pollution')}, {_N}",
        ),
    ),
    "hourly_peaks": Query(
        _on_dated(ops.hourly_peaks), _report_sql(DATED, "hour, pollutant", _AVG)
    ),
    "pollutant_stats": Query(
        _on_readings(ops.pollutant_stats),
        _report_sql(READINGS, "pollutant", f"{_AVG}, {_MIN}, {_MAX}, {_N}"),
    ),
    "season_stats": Query(
        _on_dated(ops.season_stats), _report_sql(DATED, "season, pollutant", f"{_AVG}, {_MAX}")
    ),
    "month_stats": Query(_on_dated(ops.month_stats), _report_sql(DATED, "month, pollutant", _AVG)),
    "weekend_stats": Query(
        _on_dated(ops.weekend_stats), _report_sql(DATED, "is_weekend, pollutant", _AVG)
    ),
    "high_events": Query(
        _on_readings(ops.high_events),
        f"""WITH {READINGS} SELECT city, location, pollutant, count(*) AS high_pollution_count
        FROM readings WHERE value > 100 GROUP BY ALL""",
    ),
    "rolling_summary": Query(
        rolling_summary,
        f"""WITH {FEATURES} SELECT city, location, pollutant,
        {r4("avg(rolling_mean_3h)", "avg_rolling_mean")},
        {r4("max(rolling_max_3h)", "max_rolling")}, {r4("min(rolling_min_3h)", "min_rolling")}
        FROM features GROUP BY ALL""",
    ),
    "anomaly_3sigma": Query(
        _on_readings(ops.anomaly_3sigma),
        f"""WITH {READINGS} SELECT city, location, pollutant, {r4("value")}, last_updated
        FROM readings, (SELECT avg(value) AS m, stddev_samp(value) AS s FROM readings)
        WHERE value > m + 3 * s OR value < m - 3 * s""",
    ),
    "daily_trend": Query(
        _on_readings(ops.daily_trend),
        _report_sql(
            READINGS,
            "CAST(last_updated AS DATE) AS date, pollutant",
            f"{_AVG}, {_MIN}, {_MAX}, {_N}",
        ),
    ),
    "variance_patterns": Query(
        _on_readings(ops.variance_patterns),
        _report_sql(
            READINGS,
            "city, location, pollutant",
            f"""{r4("var_samp(value)", "variance")}, {r4("stddev_samp(value)", "stddev")},
            {r4("stddev_samp(value) / nullif(avg(value), 0)", "variation")},
            count(value) AS num_readings""",
        ),
    ),
    "pollutant_pivot": Query(
        pollutant_pivot,
        f"""WITH {_DAILY} SELECT city, location, last_updated,
        {", ".join(r4(t) for t in TYPES)} FROM daily""",
    ),
    "pollutant_corr": Query(pollutant_corr, _corr_sql(zero=True)),
    "pollutant_corr_pairwise": Query(pollutant_corr_pairwise, _corr_sql(zero=False)),
    "hour_profiles": Query(
        hour_profiles,
        f"WITH {DATED} SELECT city, location, "
        + ", ".join(r4(f"avg(value) FILTER (hour = {h})", f"h{h:02d}") for h in relations.HOURS)
        + " FROM dated GROUP BY ALL",
    ),
    "reports_from_rollup": Query(
        reports_from_rollup,
        f"""WITH {DATED} SELECT city || '/' || location AS name, {r4("avg(value)", "level")}
        FROM dated GROUP BY city, location
        UNION ALL SELECT hour || '/' || pollutant, {r4("avg(value)", "level")}
        FROM dated GROUP BY hour, pollutant""",
    ),
}
