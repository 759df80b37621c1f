"""Queries along time: as-of join, episodes, overlap of intervals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.catalog.base import READINGS, Query, r4, readings, shown
from stationkit.operators import temporal
from stationkit.schema import HIGH_VALUE, SERIES, STATION

# A calibration holds for so long; a pause of this length ends an episode.
CALIBRATED_SECONDS = 3 * 86_400
PAUSE_SECONDS = 12 * 3_600
# A high reading stands for the hour after it.
HOLDS_SECONDS = 3_600
SHIFT_HOURS = 8


def asof_reading(spark: SparkSession, folder: str) -> DataFrame:
    """Every reading with the last calibration of its station, at most three days old.

    Readings of one kind serve as calibrations.
    """
    rows = readings(spark, folder)
    calibrations = rows.where("pollutant = 'signup'").select(
        *STATION, F.col("last_updated").alias("calibrated_at"), F.col("value").alias("calibration")
    )
    return shown(
        temporal.asof_join(
            rows, calibrations, STATION, "last_updated", "calibrated_at", CALIBRATED_SECONDS
        )
    )


def _high(spark: SparkSession, folder: str) -> DataFrame:
    return readings(spark, folder).where(F.col("value") > HIGH_VALUE)


def high_episodes(spark: SparkSession, folder: str) -> DataFrame:
    return shown(temporal.episodes(_high(spark, folder), PAUSE_SECONDS))


def episode_shifts(spark: SparkSession, folder: str) -> DataFrame:
    """Episodes of high values of a city with the working shifts they fall in."""
    found = temporal.episodes(_high(spark, folder), PAUSE_SECONDS).select(
        *SERIES, "episode_start",
        (F.col("episode_end") + F.expr(f"INTERVAL {HOLDS_SECONDS} SECOND")).alias("episode_end"),
    )
    days = readings(spark, folder).select(
        F.col("city"), F.date_trunc("day", "last_updated").alias("day")
    ).distinct()
    hours = F.explode(F.sequence(F.lit(0), F.lit(23), F.lit(SHIFT_HOURS))).alias("shift")
    shifts = days.select("city", "day", hours).select(
        "city", "shift",
        F.timestamp_seconds(F.unix_seconds("day") + F.col("shift") * 3600).alias("shift_start"),
        F.timestamp_seconds(F.unix_seconds("day") + (F.col("shift") + SHIFT_HOURS) * 3600).alias(
            "shift_end"
        ),
    )
    met = temporal.overlap_join(
        found, shifts, ["city"], ("episode_start", "episode_end"), ("shift_start", "shift_end")
    )
    shared = F.unix_micros(F.least("episode_end", "shift_end")) - F.unix_micros(
        F.greatest("episode_start", "shift_start")
    )
    return shown(
        met.select(*SERIES, "episode_start", "shift", "shift_start", (shared / 6e7).alias("minutes"))
    )


EPISODES = f"""marked AS (
  SELECT *, CASE WHEN last_updated - lag(last_updated) OVER s <= INTERVAL {PAUSE_SECONDS} SECOND
    THEN 0 ELSE 1 END AS begins
  FROM readings WHERE value > {HIGH_VALUE}
  WINDOW s AS (PARTITION BY city, location, pollutant ORDER BY last_updated)),
runs AS (
  SELECT *, sum(begins) OVER (PARTITION BY city, location, pollutant ORDER BY last_updated
    ROWS UNBOUNDED PRECEDING) AS run FROM marked),
episodes AS (
  SELECT city, location, pollutant, min(last_updated) AS episode_start,
         max(last_updated) AS episode_end, count(*) AS num_readings,
         max(value) AS peak_value, avg(value) AS mean_value
  FROM runs GROUP BY city, location, pollutant, run)"""

QUERIES = {
    "asof_reading": Query(
        asof_reading,
        f"""WITH {READINGS}, calibrations AS (
          SELECT city, location, last_updated AS calibrated_at, max(value) AS calibration
          FROM readings WHERE pollutant = 'signup' GROUP BY ALL),
        joined AS (
          SELECT r.*, c.calibrated_at, c.calibration,
                 r.last_updated - c.calibrated_at <= INTERVAL {CALIBRATED_SECONDS} SECOND AS fresh
          FROM readings r ASOF LEFT JOIN calibrations c ON r.city = c.city
            AND r.location = c.location AND r.last_updated >= c.calibrated_at)
        SELECT city, location, pollutant, {r4("value")}, last_updated,
          CASE WHEN fresh THEN calibrated_at END AS calibrated_at,
          {r4("CASE WHEN fresh THEN calibration END", "calibration")} FROM joined""",
    ),
    "high_episodes": Query(
        high_episodes,
        f"""WITH {READINGS}, {EPISODES} SELECT city, location, pollutant, episode_start, episode_end,
        num_readings, {r4("peak_value")}, {r4("mean_value")} FROM episodes""",
    ),
    "episode_shifts": Query(
        episode_shifts,
        f"""WITH {READINGS}, {EPISODES}, shifts AS (
          SELECT DISTINCT city, CAST(s AS INTEGER) AS shift,
                 date_trunc('day', last_updated) + to_hours(s) AS shift_start,
                 date_trunc('day', last_updated) + to_hours(s + {SHIFT_HOURS}) AS shift_end
          FROM readings, (VALUES (0), ({SHIFT_HOURS}), ({2 * SHIFT_HOURS})) AS t(s)),
        held AS (
          SELECT *, episode_end + INTERVAL {HOLDS_SECONDS} SECOND AS until FROM episodes)
        SELECT h.city, location, pollutant, episode_start, shift, shift_start,
          {r4("epoch_us(least(until, shift_end)) - epoch_us(greatest(episode_start, shift_start))".join(("(", ") / 6e7")), "minutes")}
        FROM held h JOIN shifts s ON h.city = s.city AND episode_start < shift_end
          AND shift_start < until""",
    ),
}
