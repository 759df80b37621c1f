"""Encoding, model and forecast queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationkit.catalog.base import DATED, FEATURES, READINGS, Query, r4, readings, shown, table
from stationkit.operators import features, forecast, validation
from stationkit.operators import learning as ops
from stationkit.plans.stored import store

FOLDS = 4
PURGED_SECONDS = 86_400


def mean_encode(spark: SparkSession, folder: str) -> DataFrame:
    return shown(ops.mean_encode(features.global_index(readings(spark, folder))))


def string_index(spark: SparkSession, folder: str) -> DataFrame:
    return ops.string_index(table(spark, folder, "part"), "p_brand")


def one_hot(spark: SparkSession, folder: str) -> DataFrame:
    """The flag that is set for each order, in long form, and how many flags there are."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    flags = vector_to_array("o_orderpriority_encode")
    return ops.one_hot(orders, ["o_orderpriority"]).select(
        "o_orderkey",
        "o_orderpriority",
        (F.array_position(flags, 1.0) - 1).cast("int").alias("slot"),
        F.aggregate(flags, F.lit(0.0), lambda total, flag: total + flag).cast("int").alias("flags_set"),
        F.size(flags).alias("slots"),
    )


def honest_encode(spark: SparkSession, folder: str) -> DataFrame:
    """Category means that no row's own target is part of: of the other training rows, or for test rows of all."""
    rows = features.global_index(readings(spark, folder))
    train, test = ops.train_test_split(rows, ["city", "location", "pollutant", "last_updated"])
    return shown(
        ops.mean_encode(train, leave_out=True).withColumn("part", F.lit("train"))
        .unionByName(ops.mean_encode(test, fit_on=train).withColumn("part", F.lit("test")))
    )


def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    train, test = ops.train_test_split(table(spark, folder, "events"), ["event_id"])
    return (
        train.select("event_id", F.lit("train").alias("part"))
        .unionByName(test.select("event_id", F.lit("test").alias("part")))
    )


def regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The series average as a prediction of each reading."""
    predicted = features.with_series_stats(readings(spark, folder))
    return shown(ops.regression_metrics(predicted, "value", "avg_value"))


def _prepared(spark: SparkSession, folder: str, leaky: bool) -> ops.Prepared:
    table_ = store(features.build_features(readings(spark, folder)), "features").df
    return ops.prepare(table_, leaky)


def feature_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return ops.feature_ranking(_prepared(spark, folder, leaky=True))


def model_leaderboard(spark: SparkSession, folder: str) -> DataFrame:
    return ops.model_leaderboard(_prepared(spark, folder, leaky=True))


def _line(column: str) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=[column], outputCol="_x"),
            LinearRegression(labelCol="value", featuresCol="_x"),
        ]
    )


def cross_validation(spark: SparkSession, folder: str) -> DataFrame:
    """Two lines on every fold of time, a day before each test span purged."""
    rows = features.calendar_features(readings(spark, folder))
    models = {"hour": _line("hour"), "weekend": _line("is_weekend")}
    scores = validation.cross_validate(
        rows, models, "value", "last_updated", FOLDS, PURGED_SECONDS
    )
    return shown(scores)


def forecast_naive(spark: SparkSession, folder: str) -> DataFrame:
    return shown(forecast.forecast_naive(readings(spark, folder), 6))


def forecast_lags(spark: SparkSession, folder: str) -> DataFrame:
    return shown(forecast.lagged(readings(spark, folder), 24, 3, 1))


def forecast_model(spark: SparkSession, folder: str) -> DataFrame:
    return forecast.forecast_model(readings(spark, folder))


def forecast_table(spark: SparkSession, folder: str) -> DataFrame:
    return shown(forecast.forecast_table(readings(spark, folder)))


_LEVELS = f"""{READINGS}, levels AS (
  SELECT city, location, pollutant,
         CAST(floor(floor(epoch(last_updated)) / 86400) AS BIGINT) AS moment, avg(value) AS level
  FROM readings GROUP BY ALL),
lags AS (
  SELECT l.city, l.location, l.pollutant, l.moment, l.level AS lag_0,
         coalesce(p.level, l.level) AS lag_1, coalesce(q.level, l.level) AS lag_2,
         n.level AS label
  FROM levels l
  LEFT JOIN levels p ON (p.city, p.location, p.pollutant) = (l.city, l.location, l.pollutant)
    AND p.moment = l.moment - 1
  LEFT JOIN levels q ON (q.city, q.location, q.pollutant) = (l.city, l.location, l.pollutant)
    AND q.moment = l.moment - 2
  LEFT JOIN levels n ON (n.city, n.location, n.pollutant) = (l.city, l.location, l.pollutant)
    AND n.moment = l.moment + 1)"""

QUERIES = {
    "mean_encode": Query(
        mean_encode,
        f"""WITH {FEATURES} SELECT city, location, pollutant, {r4("value")}, last_updated,
        {r4("global_index")}, {r4("avg(global_index) OVER (PARTITION BY city)", "city_encode")},
        {r4("avg(global_index) OVER (PARTITION BY location)", "location_encode")} FROM features""",
    ),
    "string_index": Query(
        string_index,
        """SELECT p_brand, count(*) AS count,
        CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS INTEGER) AS index
        FROM part GROUP BY p_brand""",
    ),
    "one_hot": Query(
        one_hot,
        """WITH ranked AS (SELECT o_orderpriority,
          row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS i, count(*) OVER () AS n
          FROM orders GROUP BY o_orderpriority)
        SELECT o_orderkey, o_orderpriority, CAST(i AS INTEGER) AS slot,
          CAST(1 AS INTEGER) AS flags_set, CAST(n AS INTEGER) AS slots
        FROM orders JOIN ranked USING (o_orderpriority)""",
    ),
    "honest_encode": Query(
        honest_encode,
        f"""WITH {FEATURES}, dealt AS (
          SELECT city, location, pollutant, value, last_updated, global_index,
            ('0x' || substr(md5(city || '|' || location || '|' || pollutant || '|' ||
              epoch_us(last_updated)), 1, 8))::BIGINT % 100 < 20 AS tested
          FROM features),
        overall AS (SELECT avg(global_index) AS mean FROM dealt WHERE NOT tested),
        cities AS (SELECT city, sum(global_index) AS total, count(global_index) AS n
          FROM dealt WHERE NOT tested GROUP BY city),
        places AS (SELECT location, sum(global_index) AS total, count(global_index) AS n
          FROM dealt WHERE NOT tested GROUP BY location)
        SELECT d.city, d.location, pollutant, {r4("value")}, last_updated, {r4("global_index")},
          {r4("CASE WHEN tested THEN coalesce(c.total / c.n, mean) WHEN c.n > 1 THEN (c.total - global_index) / (c.n - 1) ELSE mean END", "city_encode")},
          {r4("CASE WHEN tested THEN coalesce(p.total / p.n, mean) WHEN p.n > 1 THEN (p.total - global_index) / (p.n - 1) ELSE mean END", "location_encode")},
          CASE WHEN tested THEN 'test' ELSE 'train' END AS part
        FROM dealt d CROSS JOIN overall LEFT JOIN cities c ON c.city = d.city
          LEFT JOIN places p ON p.location = d.location""",
    ),
    "train_test_split": Query(
        train_test_split,
        """SELECT event_id, CASE WHEN
        ('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT % 100 < 20
        THEN 'test' ELSE 'train' END AS part FROM events""",
    ),
    "regression_metrics": Query(
        regression_metrics,
        f"""WITH {FEATURES} SELECT 'avg_value' AS name,
        {r4("sqrt(avg((value - avg_value) ** 2))", "rmse")},
        {r4("1 - avg((value - avg_value) ** 2) / var_pop(value)", "r2")} FROM features""",
    ),
    "cross_validation": Query(
        cross_validation,
        f"""WITH {DATED}, ends AS (
          SELECT CAST(floor(epoch(min(last_updated))) AS BIGINT) AS low,
                 CAST(floor(epoch(max(last_updated))) AS BIGINT) AS high FROM dated),
        folds AS (
          SELECT k AS fold, low + (high + 1 - low) * k // {FOLDS + 1} AS starts,
                 low + (high + 1 - low) * (k + 1) // {FOLDS + 1} AS stops
          FROM ends, range(1, {FOLDS + 1}) AS t(k)),
        given AS (
          SELECT 'hour' AS name, ts, value, hour::DOUBLE AS x FROM dated
          UNION ALL SELECT 'weekend', ts, value, is_weekend::DOUBLE FROM dated),
        lines AS (
          SELECT name, fold, starts, stops, count(*) AS train_rows,
                 CASE WHEN min(x) < max(x) THEN regr_slope(value, x) ELSE 0 END AS b,
                 CASE WHEN min(x) < max(x) THEN regr_intercept(value, x) ELSE avg(value) END AS a
          FROM folds JOIN given ON ts < starts - {PURGED_SECONDS} GROUP BY ALL)
        SELECT name, CAST(fold AS INTEGER) AS fold,
          {r4("sqrt(avg((value - a - b * x) ** 2))", "rmse")},
          {r4("1 - avg((value - a - b * x) ** 2) / var_pop(value)", "r2")},
          any_value(train_rows) AS train_rows, count(*) AS test_rows
        FROM lines JOIN given USING (name) WHERE ts >= starts AND ts < stops GROUP BY name, fold""",
    ),
    "feature_ranking": Query(feature_ranking),
    "model_leaderboard": Query(model_leaderboard),
    "forecast_naive": Query(
        forecast_naive,
        f"""WITH {READINGS}, latest AS (
          SELECT city, location, pollutant, max(last_updated) AS as_of,
                 arg_max(value, last_updated) AS last_value, avg(value) AS mean
          FROM readings GROUP BY ALL),
        hourly AS (SELECT city, location, pollutant, hour(last_updated) AS h, avg(value) AS level
          FROM readings GROUP BY ALL),
        both_methods AS (
          SELECT city, location, pollutant, as_of, 'last_value' AS method, last_value AS prediction
          FROM latest
          UNION ALL
          SELECT l.city, l.location, l.pollutant, as_of, 'hour_mean', coalesce(level, mean)
          FROM latest l LEFT JOIN hourly h ON l.city = h.city AND l.location = h.location
            AND l.pollutant = h.pollutant AND h = hour(as_of + INTERVAL 6 HOUR))
        SELECT city, location, pollutant, as_of, CAST(6 AS INTEGER) AS horizon_h, method,
        {r4("prediction")} FROM both_methods""",
    ),
    "forecast_lags": Query(
        forecast_lags,
        f"""WITH {_LEVELS} SELECT city, location, pollutant, moment, {r4("lag_0")}, {r4("lag_1")},
        {r4("lag_2")}, {r4("label")} FROM lags""",
    ),
    "forecast_model": Query(forecast_model),
    "forecast_table": Query(
        forecast_table,
        f"""WITH {_LEVELS}, fit AS (
          SELECT regr_slope(label, lag_0) AS b, regr_intercept(label, lag_0) AS a FROM lags
          WHERE label IS NOT NULL),
        latest AS (SELECT city, location, pollutant, max(moment) AS moment,
          arg_max(lag_0, moment) AS level FROM lags GROUP BY ALL)
        SELECT city, location, pollutant,
        TIMESTAMP '1970-01-01' + moment * INTERVAL 1 DAY AS as_of,
        CAST(24 AS INTEGER) AS horizon_h, {r4("a + b * level", "prediction")} FROM latest, fit""",
    ),
}
