"""Streaming queries: each drains the given table as a file stream."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.catalog import cleaning
from stationkit.catalog.base import DATED, READINGS, Query, r4, readings, shown, table
from stationkit.catalog.temporal import EPISODES, PAUSE_SECONDS
from stationkit.operators.features import calendar_features
from stationkit.plans.stored import fresh_path
from stationkit.schema import HIGH_VALUE, STATION
from stationkit.sources.events import raw_from_events, readings_from_events
from stationkit.streaming import jobs, watch

# A calibration counts for so many hours; a series is silent after so many seconds and stuck
# after so many readings in the same hundred.
CALIBRATED_HOURS = 36
SILENT_SECONDS = 5 * 86_400
STUCK = 4


def _events(spark: SparkSession, folder: str) -> DataFrame:
    schema = table(spark, folder, "events").schema
    return jobs.read_files(spark, folder, schema, pathGlobFilter="events.parquet")


def _arriving(spark: SparkSession, folder: str) -> DataFrame:
    return readings_from_events(_events(spark, folder))


def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    stream = jobs.stream_ingest(_arriving(spark, folder))
    return shown(jobs.drain(stream, fresh_path(spark, "stream")))


def stream_sliding(spark: SparkSession, folder: str) -> DataFrame:
    stream = jobs.stream_sliding(_arriving(spark, folder))
    return shown(jobs.drain(stream, fresh_path(spark, "stream")))


def stream_score(spark: SparkSession, folder: str) -> DataFrame:
    """A line fitted on the stored readings scores the arriving ones."""
    steps = Pipeline(
        stages=[
            VectorAssembler(inputCols=["hour"], outputCol="_hour"),
            LinearRegression(labelCol="value", featuresCol="_hour"),
        ]
    )
    known = calendar_features(readings(spark, folder)).select("hour", "value")
    model = jobs.save_and_load(steps.fit(known), fresh_path(spark, "model"))
    scored = jobs.stream_score(calendar_features(_arriving(spark, folder)), model).select(
        "city", "location", "pollutant", "value", "last_updated", "hour", "prediction"
    )
    return shown(jobs.drain(scored, fresh_path(spark, "stream")))


def stream_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The whole cleaning on arriving raw rows; equal to the batch."""
    return shown(jobs.drain(jobs.stream_clean(raw_from_events(_events(spark, folder)))))


def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    high = _arriving(spark, folder).where(F.col("value") > HIGH_VALUE)
    return shown(jobs.drain(jobs.stream_sessions(high, f"{PAUSE_SECONDS} seconds")))


def stream_calibrated(spark: SparkSession, folder: str) -> DataFrame:
    """Readings of one kind serve as calibrations of the others, as a second stream."""
    rows = _arriving(spark, folder).where("pollutant <> 'signup'")
    calibrations = _arriving(spark, folder).where("pollutant = 'signup'").select(
        *STATION, F.col("last_updated").alias("calibrated_at"), F.col("value").alias("calibration")
    )
    joined = jobs.stream_calibrated(rows, calibrations, f"{CALIBRATED_HOURS} hours")
    return shown(jobs.drain(joined))


def stream_watch(spark: SparkSession, folder: str) -> DataFrame:
    banded = _arriving(spark, folder).withColumn("value", F.floor(F.col("value") / 100).cast("double"))
    return shown(jobs.drain(watch.watch(banded, SILENT_SECONDS, STUCK)))


_SERIES = "city, location, pollutant"

QUERIES = {
    "stream_clean": Query(stream_clean, cleaning.QUERIES["clean_readings"].sql),
    "stream_sessions": Query(
        stream_sessions,
        f"""WITH {READINGS}, {EPISODES}
        SELECT {_SERIES}, episode_start, episode_end, num_readings, {r4("peak_value")},
        {r4("mean_value")} FROM episodes
        WHERE episode_end + INTERVAL {PAUSE_SECONDS} SECOND <= (
          SELECT max(last_updated) - INTERVAL 1 HOUR FROM readings WHERE value > {HIGH_VALUE})""",
    ),
    "stream_calibrated": Query(
        stream_calibrated,
        f"""WITH {READINGS}, watched AS (SELECT * FROM readings WHERE pollutant <> 'signup'),
        calibrations AS (
          SELECT city, location, last_updated AS calibrated_at, value AS calibration
          FROM readings WHERE pollutant = 'signup'),
        passed AS (
          SELECT least((SELECT max(last_updated) FROM watched),
                       (SELECT max(calibrated_at) FROM calibrations)) - INTERVAL 1 HOUR AS until),
        joined AS (
          SELECT w.*, c.calibrated_at, c.calibration FROM watched w LEFT JOIN calibrations c
            ON w.city = c.city AND w.location = c.location AND w.last_updated >= c.calibrated_at
            AND w.last_updated <= c.calibrated_at + INTERVAL {CALIBRATED_HOURS} HOUR)
        SELECT {_SERIES}, {r4("value")}, last_updated, calibrated_at, {r4("calibration")}
        FROM joined WHERE calibrated_at IS NOT NULL OR last_updated <= (SELECT until FROM passed)""",
    ),
    "stream_watch": Query(
        stream_watch,
        f"""WITH {READINGS}, stepped AS (
          SELECT {_SERIES}, last_updated, floor(value / 100) AS value,
                 lead(last_updated) OVER s AS next,
                 CASE WHEN floor(value / 100) = lag(floor(value / 100)) OVER s THEN 0 ELSE 1 END AS begins
          FROM readings WINDOW s AS (PARTITION BY {_SERIES} ORDER BY last_updated)),
        runs AS (
          SELECT *, sum(begins) OVER (PARTITION BY {_SERIES} ORDER BY last_updated
            ROWS UNBOUNDED PRECEDING) AS run FROM stepped),
        numbered AS (
          SELECT *, row_number() OVER r AS k, first(last_updated) OVER r AS run_start FROM runs
          WINDOW r AS (PARTITION BY {_SERIES}, run ORDER BY last_updated)),
        alerts AS (
          SELECT {_SERIES}, 'silence' AS kind, last_updated AS since, next AS until, value
          FROM numbered WHERE next - last_updated > INTERVAL {SILENT_SECONDS} SECOND
          UNION ALL
          SELECT {_SERIES}, 'quiet', last_updated, NULL, value FROM numbered
          WHERE next IS NULL AND last_updated + INTERVAL {SILENT_SECONDS} SECOND
            < (SELECT max(last_updated) - INTERVAL 1 HOUR FROM readings)
          UNION ALL SELECT {_SERIES}, 'stuck', run_start, last_updated, value FROM numbered
          WHERE k = {STUCK})
        SELECT {_SERIES}, kind, since, until, {r4("value")} FROM alerts""",
    ),
    "stream_ingest": Query(
        stream_ingest,
        f"""WITH {READINGS} SELECT DISTINCT city, location, upper(pollutant) AS pollutant,
        {r4("value")}, last_updated FROM readings""",
    ),
    "stream_sliding": Query(
        stream_sliding,
        f"""WITH {READINGS}, windows AS (
          SELECT *, date_trunc('hour', last_updated) - k * INTERVAL 1 HOUR AS window_start
          FROM readings, range(3) AS t(k))
        SELECT window_start, window_start + INTERVAL 3 HOUR AS window_end,
        city, location, pollutant, {r4("avg(value)", "mean_value")},
        {r4("max(value)", "max_value")}, {r4("min(value)", "min_value")},
        count(*) AS num_readings FROM windows
        WHERE window_start + INTERVAL 3 HOUR
          <= (SELECT max(last_updated) - INTERVAL 1 HOUR FROM readings)
        GROUP BY ALL""",
    ),
    "stream_score": Query(
        stream_score,
        f"""WITH {DATED}, fit AS (
          SELECT regr_slope(value, hour) AS b, regr_intercept(value, hour) AS a FROM dated)
        SELECT city, location, pollutant, {r4("value")}, last_updated, hour,
        {r4("a + b * hour", "prediction")} FROM dated, fit""",
    ),
}
