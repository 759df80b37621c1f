"""Loading helpers and SQL fragments shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationkit.functions.numeric import settle
from stationkit.sources.events import EVENT_POLLUTANTS, raw_from_events, readings_from_events


@dataclass(frozen=True)
class Query:
    """A query over a table folder and, where possible, the same in SQL."""

    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables. Calendar parts are taken in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def readings(spark: SparkSession, folder: str) -> DataFrame:
    return readings_from_events(table(spark, folder, "events"))


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return raw_from_events(table(spark, folder, "events"))


def shown(df: DataFrame) -> DataFrame:
    """Round doubles and give times without zone, as the SQL side has them."""

    def column(field: T.StructField):
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DoubleType):
            c = settle(c) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        return c.alias(field.name)

    return df.select(*(column(f) for f in df.schema.fields))


def r4(expression: str, name: str | None = None) -> str:
    """SQL counterpart of the rounding in ``shown``; 0e0 turns -0 into 0."""
    return f"(round({expression} + 1e-7, 4) + 0e0) AS {name or expression}"


READINGS = """readings AS (
  SELECT 'c' || (user_id % 12) AS city, 's' || user_id AS location,
         event_type AS pollutant, value, ts AS last_updated
  FROM events)"""

_LABELS = " ".join(f"WHEN '{e}' THEN '{p}'" for e, p in EVENT_POLLUTANTS.items())
RAW = f"""raw AS (
  SELECT 'Saint-Étienne  ' || (user_id % 12) AS city,
         CASE WHEN user_id % 25 = 0 THEN '   '
              ELSE 'Site / N°' || user_id || ' - Est ' END AS location,
         CASE event_type {_LABELS} END AS pollutant,
         value, ts AS last_updated
  FROM events)"""

CALENDAR = """
  CAST(hour(last_updated) AS INTEGER) AS hour,
  CAST(day(last_updated) AS INTEGER) AS day,
  CAST(month(last_updated) AS INTEGER) AS month,
  CAST(year(last_updated) AS INTEGER) AS year,
  CAST(CASE WHEN dayofweek(last_updated) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  CASE WHEN month(last_updated) BETWEEN 3 AND 5 THEN 'Spring'
       WHEN month(last_updated) BETWEEN 6 AND 8 THEN 'Summer'
       WHEN month(last_updated) BETWEEN 9 AND 11 THEN 'Autumn'
       ELSE 'Winter' END AS season,
  CAST(floor(epoch(last_updated)) AS BIGINT) AS ts,
  CAST(CASE WHEN hour(last_updated) BETWEEN 7 AND 9
              OR hour(last_updated) BETWEEN 17 AND 19 THEN 1 ELSE 0 END AS INTEGER)
    AS is_rush_hour"""

DATED = f"{READINGS}, dated AS (SELECT *, {CALENDAR} FROM readings)"

FEATURES = f"""{DATED}, features AS (
  SELECT *,
    avg(value) OVER s AS avg_value, max(value) OVER s AS max_value,
    min(value) OVER s AS min_value, count(value) OVER s AS num_readings,
    (value - min(value) OVER p) / nullif(max(value) OVER p - min(value) OVER p, 0)
      AS global_index,
    avg(value) OVER h AS rolling_mean_3h, max(value) OVER h AS rolling_max_3h,
    min(value) OVER h AS rolling_min_3h,
    CASE WHEN coalesce(stddev_samp(value) OVER p, 0) = 0 THEN 0
         ELSE (value - avg(value) OVER p) / stddev_samp(value) OVER p END
      AS value_z_score_by_pollutant,
    count(*) OVER s AS station_pollutant_count
  FROM dated
  WINDOW s AS (PARTITION BY city, location, pollutant),
         p AS (PARTITION BY pollutant),
         h AS (PARTITION BY city, location, pollutant ORDER BY ts
               RANGE BETWEEN 10800 PRECEDING AND CURRENT ROW))"""
