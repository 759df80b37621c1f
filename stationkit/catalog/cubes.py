"""Queries over a rollup: grouping sets, percentiles from sketches, exact percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.catalog.base import DATED, READINGS, Query, r4, readings, shown
from stationkit.operators import cubes
from stationkit.operators.features import calendar_features
from stationkit.plans import flow
from stationkit.plans.keyed import attach
from stationkit.plans.stored import store
from stationkit.schema import SERIES

CUBE = ["city", "pollutant", "season", "is_weekend"]
PROBABILITIES = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    return flow.rollup(calendar_features(readings(spark, folder)))


def report_cube(spark: SparkSession, folder: str) -> DataFrame:
    return shown(cubes.sets_report(_cells(spark, folder), CUBE))


def report_rollup(spark: SparkSession, folder: str) -> DataFrame:
    return shown(cubes.sets_report(_cells(spark, folder), CUBE, cubes.rollup_sets(CUBE)))


def exact_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    rows = readings(spark, folder)
    return shown(cubes.exact_quantiles(rows, ["city", "pollutant"], "value", PROBABILITIES))


def quantiles_from_rollup(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles from the cells' sketches, beside the exact ones, and whether they keep to the error.

    The rank of a sketched percentile is taken among the readings themselves.
    """
    rows = readings(spark, folder)
    cells = cubes.sketch_rollup(calendar_features(rows), [*SERIES, "hour"])
    sketched = store(
        cubes.quantiles_from_rollup(cells, ["pollutant"], PROBABILITIES), "sketched"
    ).df
    ranks = (
        attach(rows.select("pollutant", "value"), sketched, ["pollutant"], "inner")
        .groupBy("pollutant", "probability")
        .agg(
            (F.count_if(F.col("value") < F.col("quantile")) / F.count("value")).alias("_below"),
            (F.count_if(F.col("value") <= F.col("quantile")) / F.count("value")).alias("_upto"),
        )
    )
    true = rows.groupBy("pollutant").agg(
        F.count_distinct("city", "location").alias("_stations"),
        F.count_distinct(F.to_date("last_updated")).alias("_days"),
    )
    exact = cubes.exact_quantiles(rows, ["pollutant"], "value", PROBABILITIES)
    p, error = F.col("probability"), cubes.RANK_ERROR

    def near(estimate: str, count: str):
        return F.abs(F.col(estimate) - F.col(count)) <= F.col(count) * cubes.DISTINCT_ERROR

    joined = (
        sketched.join(ranks, ["pollutant", "probability"])
        .join(exact, ["pollutant", "probability"])
        .join(true, "pollutant")
    )
    return shown(
        joined.select(
            "pollutant", "probability", "num_values", "exact",
            ((F.col("_below") <= p + error) & (F.col("_upto") >= p - error)).alias("rank_kept"),
            near("stations", "_stations").alias("stations_kept"),
            near("days", "_days").alias("days_kept"),
        )
    )


_BY = ", ".join(CUBE)
_MEASURES = f"""{r4("avg(value)", "avg_value")}, {r4("max(value)", "max_value")},
  {r4("min(value)", "min_value")}, count(*) AS num_measurements"""
_P = ", ".join(map(str, PROBABILITIES))

QUERIES = {
    "report_cube": Query(
        report_cube,
        f"""WITH {DATED} SELECT {_BY}, CAST(grouping({_BY}) AS BIGINT) AS grouping, {_MEASURES}
        FROM dated GROUP BY CUBE ({_BY})""",
    ),
    "report_rollup": Query(
        report_rollup,
        f"""WITH {DATED} SELECT {_BY}, CAST(grouping({_BY}) AS BIGINT) AS grouping, {_MEASURES}
        FROM dated GROUP BY ROLLUP ({_BY})""",
    ),
    "exact_quantiles": Query(
        exact_quantiles,
        f"""WITH {READINGS}, listed AS (
          SELECT city, pollutant, unnest([{_P}]::DOUBLE[]) AS probability,
                 unnest(quantile_cont(value, [{_P}]::DOUBLE[])) AS exact
          FROM readings GROUP BY city, pollutant)
        SELECT city, pollutant, {r4("probability")}, {r4("exact")} FROM listed""",
    ),
    "quantiles_from_rollup": Query(
        quantiles_from_rollup,
        f"""WITH {READINGS}, listed AS (
          SELECT pollutant, unnest([{_P}]::DOUBLE[]) AS probability,
                 unnest(quantile_cont(value, [{_P}]::DOUBLE[])) AS exact, count(*) AS num_values
          FROM readings GROUP BY pollutant)
        SELECT pollutant, {r4("probability")}, num_values, {r4("exact")}, true AS rank_kept,
          true AS stations_kept, true AS days_kept FROM listed""",
    ),
}
