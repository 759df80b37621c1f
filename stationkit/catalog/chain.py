"""The whole chain as queries: raw files, cleaning, city filter, features, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.catalog.base import DATED, FEATURES, READINGS, Query, r4, raw, shown
from stationkit.catalog.cleaning import CLEANED
from stationkit.catalog.features import ALL_FEATURES
from stationkit.operators.features import FEATURE_COLUMNS
from stationkit.plans import flow
from stationkit.plans.stored import fresh_path
from stationkit.sources import files


def _run(spark: SparkSession, folder: str) -> flow.Run:
    """The given readings as delimited files, through the chain."""
    path = fresh_path(spark, "chain")
    files.write_csv(raw(spark, folder), f"{path}/in")
    return flow.run(spark, f"{path}/in", f"{path}/out")


def flow_features(spark: SparkSession, folder: str) -> DataFrame:
    return shown(_run(spark, folder).features.select(*FEATURE_COLUMNS))


def flow_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Two reports from one rollup of the chain's features, below each other."""
    made = flow.reports_from_rollup(flow.rollup(_run(spark, folder).features))
    stations = made["station_exposure"].select(
        F.lit("station_exposure").alias("report"), F.concat_ws("/", "city", "location").alias("name"),
        F.col("avg_pollution").alias("average"), F.col("peak_pollution").alias("highest"),
    )
    seasons = made["season_stats"].select(
        F.lit("season_stats").alias("report"), F.concat_ws("/", "season", "pollutant").alias("name"),
        F.col("avg_value").alias("average"), F.col("max_value").alias("highest"),
    )
    return shown(stations.unionByName(seasons))


# Cities with at least three readings stay.
_KEPT = f"""{CLEANED.replace("readings AS (", "cleaned AS (")},
readings AS (SELECT * FROM cleaned WHERE city IN (
  SELECT city FROM cleaned GROUP BY city HAVING count(*) >= 3))"""

QUERIES = {
    "flow_features": Query(
        flow_features, f"WITH {FEATURES.replace(READINGS, _KEPT)} SELECT {ALL_FEATURES} FROM features"
    ),
    "flow_reports": Query(
        flow_reports,
        f"""WITH {DATED.replace(READINGS, _KEPT)}
        SELECT 'station_exposure' AS report, city || '/' || location AS name,
          {r4("avg(value)", "average")}, {r4("max(value)", "highest")} FROM dated GROUP BY city, location
        UNION ALL SELECT 'season_stats', season || '/' || pollutant, {r4("avg(value)", "average")},
          {r4("max(value)", "highest")} FROM dated GROUP BY season, pollutant""",
    ),
}
