import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from stationkit.catalog.base import readings
from stationkit.operators import forecast, learning
from stationkit.operators.features import build_features
from stationkit.plans.stored import store

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return store(build_features(readings(spark, SMALL)), "features").df


def test_unseen_label_is_kept_with_an_empty_flag_vector(spark):
    seen = spark.createDataFrame([("a",), ("a",), ("b",)], "label string")
    fitted = Pipeline(stages=learning.category_stages(["label"])).fit(seen)
    new = spark.createDataFrame([("a",), ("b",), ("c",)], "label string")
    flags = fitted.transform(new).select("_label_index", vector_to_array("label_encode"))
    assert [(r[0], r[1]) for r in flags.collect()] == [(0.0, [1, 0]), (1.0, [0, 1]), (2.0, [0, 0])]


def test_metrics(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)], "label double, prediction double")
    scores = learning.regression_metrics(rows).first()
    assert scores.rmse == pytest.approx(0.57735, abs=1e-5)
    assert scores.r2 == pytest.approx(0.5)


def test_split_is_stable_and_complete(spark):
    rows = spark.range(5000)
    train, test = learning.train_test_split(rows, ["id"])
    again = learning.train_test_split(rows.repartition(13), ["id"])[1]
    assert train.count() + test.count() == 5000
    assert 0.17 < test.count() / 5000 < 0.23
    assert test.exceptAll(again).count() == 0


@pytest.mark.parametrize("limit", [None, 0])
def test_mean_encoding_on_training_rows_only(spark, limit):
    schema = "city string, location string, global_index double"
    train = spark.createDataFrame([("a", "x", 0.2), ("a", "x", 0.4), ("b", "y", 1.0)], schema)
    test = spark.createDataFrame([("a", "x", 9.0), ("new", "y", 9.0)], schema)
    found = learning.mean_encode(test, fit_on=train, broadcast_bytes=limit).collect()
    by_city = {r.city: (r.city_encode, r.location_encode) for r in found}
    assert by_city["a"] == pytest.approx((0.3, 0.3))
    assert by_city["new"] == pytest.approx((1.6 / 3, 1.0))


def test_candidates(table):
    encoded = table.withColumns({c: F.lit(0.0) for c in (
        "city_encode", "location_encode", "pollutant_encode", "season_encode")})
    assert len(learning.candidate_features(encoded, leaky=True)) == 20
    assert not {"value", "rolling_mean_3h"} & set(learning.candidate_features(encoded))


def test_importances_belong_to_columns_and_sum_to_one(spark, table):
    prepared = learning.prepare(table, leaky=True)
    ranking = learning.feature_ranking(prepared, trees=10).collect()
    assert sorted(r.feature for r in ranking) == sorted(prepared.features)
    assert sum(r.importance for r in ranking) == pytest.approx(1)
    # The label is an affine function of either within a pollutant.
    assert ranking[0].feature in ("value", "value_z_score_by_pollutant")
    # One slot per pollutant label, all counted for the one column.
    slots = learning._slots(prepared.train, "features")
    assert slots.count("pollutant_encode") == 5


def test_leaderboard(table):
    board = learning.model_leaderboard(learning.prepare(table, leaky=True)).cache()
    rows = board.orderBy("rank").collect()
    assert {r.name for r in rows} == {"RandomForest", "DecisionTree", "GBT", "LinearRegression"}
    assert [r.rmse for r in rows] == sorted(r.rmse for r in rows)
    assert learning.best_model(board).first().name == rows[0].name
    assert rows[0].r2 > 0.9


def test_honest_preparation_has_no_same_row_columns(table):
    prepared = learning.prepare(table)
    assert "value" not in prepared.features
    assert prepared.test.where("city_encode IS NULL").count() == 0


def test_lags_line_up(make_readings):
    day = 86400
    rows = make_readings([("a", "b", "O3", float(d * d), d * day + 60) for d in (0, 1, 2, 4)])
    found = forecast.lagged(rows, lags=2).orderBy("moment").collect()
    assert [(r.moment, r.lag_0, r.lag_1, r.label) for r in found] == [
        (0, 0.0, 0.0, 1.0), (1, 1.0, 0.0, 4.0), (2, 4.0, 1.0, None), (4, 16.0, 16.0, None)]


def test_naive_forecasts(make_readings):
    hour = 3600
    rows = make_readings([("a", "b", "O3", v, t) for v, t in (
        (10.0, 6 * hour), (2.0, 0), (20.0, 30 * hour), (7.0, 48 * hour))])
    found = {r.method: r.prediction for r in forecast.forecast_naive(rows, 6).collect()}
    assert found == {"last_value": 7.0, "hour_mean": 15.0}


def test_linear_forecast_continues_a_line(make_readings):
    day = 86400
    rows = make_readings([("a", "b", "O3", 3.0 + 2 * d, d * day) for d in range(10)])
    row = forecast.forecast_table(rows).first()
    assert row.prediction == pytest.approx(23.0)
    assert (row.horizon_h, str(row.as_of)) == (24, "1970-01-10 00:00:00")


def test_leaving_out_the_own_label(spark):
    schema = "city string, location string, global_index double"
    rows = [("a", "x", 0.2), ("a", "x", 0.4), ("a", "y", 0.6), ("b", "z", 1.0), ("c", "z", None)]
    found = learning.mean_encode(spark.createDataFrame(rows, schema), leave_out=True).collect()
    got = {(r.city, r.global_index): r.city_encode for r in found}
    overall = 2.2 / 4
    assert got == {("a", 0.2): pytest.approx(0.5), ("a", 0.4): pytest.approx(0.4), ("a", 0.6): pytest.approx(0.3),
                   ("b", 1.0): pytest.approx(overall), ("c", None): pytest.approx(overall)}


def test_honest_encoding_does_not_tell_the_label(spark, table):
    """Cities of few rows: with the own label in the mean, the encoding would follow the label."""
    few = table.withColumn("city", F.concat("city", F.lit("-"), F.substring(F.md5("location"), 1, 2)))
    few = few.withColumn("city", F.concat("city", "pollutant", (F.col("day") % 10).cast("string")))
    seen = learning.mean_encode(few).agg(F.corr("city_encode", "global_index")).first()[0]
    unseen = learning.mean_encode(few, leave_out=True).agg(F.corr("city_encode", "global_index")).first()[0]
    assert seen > 0.5 and unseen < 0.2


def test_split_does_not_depend_on_the_time_zone(spark):
    rows = spark.range(2_000).select(F.timestamp_seconds(F.col("id") * 977).alias("t"), "id")
    ids = []
    for zone in ("UTC", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        test = learning.train_test_split(rows, ["t"])[1]
        ids.append(sorted(r.id for r in test.collect()))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert ids[0] == ids[1] and 300 < len(ids[0]) < 500
    plain = rows.select(F.col("t").cast("timestamp_ntz").alias("t"), "id")
    assert sorted(r.id for r in learning.train_test_split(plain, ["t"])[1].collect()) == ids[0]


def test_labels_are_numbered_without_the_driver(spark):
    rows = [("b",)] * 3 + [("a",)] * 3 + [("c",)] * 9 + [(None,)] * 4
    got = learning.string_index(spark.createDataFrame(rows, "label string"), "label").collect()
    assert sorted(map(tuple, got)) == [("a", 3, 1), ("b", 3, 2), ("c", 9, 0)]
