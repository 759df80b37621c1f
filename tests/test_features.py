import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from stationkit.functions import calendar
from stationkit.operators import features as ft

NAMES = ["rolling_mean_3h", "rolling_max_3h", "rolling_min_3h"]


def naive_rolling(df, keys=("city", "location", "pollutant"), seconds=10800):
    w = Window.partitionBy(*keys).orderBy("ts").rangeBetween(-seconds, 0)
    aggregates = (F.avg("value"), F.max("value"), F.min("value"))
    return df.withColumns({n: a.over(w) for n, a in zip(NAMES, aggregates, strict=True)})


def same(a, b, columns):
    def rounded(df):
        return df.select(
            *(F.round(F.col(c) + 1e-7, 5).alias(c) if t == "double" else F.col(c)
              for c, t in df.select(*columns).dtypes)
        )

    a, b = rounded(a), rounded(b)
    assert a.exceptAll(b).count() == 0
    assert b.exceptAll(a).count() == 0


def test_calendar_flags(spark):
    days = spark.sql("SELECT explode(array('2024-01-06', '2024-01-07', '2024-01-08')) d")
    weekend = days.select(calendar.is_weekend(F.to_timestamp("d")))
    assert [r[0] for r in weekend.collect()] == [1, 1, 0]
    months = spark.createDataFrame([(m,) for m in (2, 3, 6, 9, 12, None)], "m int")
    seasons = [r[0] for r in months.select(calendar.season(F.col("m"))).collect()]
    assert seasons == ["Winter", "Spring", "Summer", "Autumn", "Winter", "Winter"]
    hours = spark.createDataFrame([(h,) for h in (6, 7, 9, 10, 17, 19, 20)], "h int")
    rush = [r[0] for r in hours.select(calendar.is_rush_hour(F.col("h"))).collect()]
    assert rush == [0, 1, 1, 0, 1, 1, 0]


def test_constant_pollutant_has_no_index_and_zero_score(make_readings):
    rows = make_readings([("a", "b", "flat", 5.0, t) for t in range(3)])
    assert {r.global_index for r in ft.global_index(rows).collect()} == {None}
    assert {r.value_z_score_by_pollutant for r in ft.zscore(rows).collect()} == {0.0}


def test_single_reading_has_zero_score(make_readings):
    row = ft.zscore(make_readings([("a", "b", "once", 5.0, 0)])).first()
    assert row.value_z_score_by_pollutant == 0.0


def test_rolling_bound_is_inclusive(make_readings):
    rows = make_readings([("a", "b", "O3", v, t) for v, t in ((1.0, 0), (2.0, 10800), (4.0, 10801))])
    means = {r.ts: r.rolling_mean_3h for r in ft.rolling(rows).collect()}
    assert means == {0: 1.0, 10800: 1.5, 10801: 3.0}


def test_rolling_includes_ties(make_readings):
    rows = make_readings([("a", "b", "O3", 1.0, 7), ("a", "b", "O3", 3.0, 7)])
    assert [r.rolling_mean_3h for r in ft.rolling(rows).collect()] == [2.0, 2.0]


def dense(spark, make_readings):
    """A third of the readings in one second of one series, the rest spread out."""
    rows = spark.range(6000).select(
        F.lit("c").alias("city"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(
            F.concat(F.lit("l"), (F.col("id") % 5).cast("string"))
        ).alias("location"),
        F.lit("O3").alias("pollutant"),
        ((F.col("id") * 7919) % 1000 / 10).alias("value"),
        F.when(F.col("id") % 3 == 0, 50_000 + (F.col("id") % 2) * 9000)
        .otherwise((F.col("id") * 104729) % 200_000)
        .alias("ts"),
    )
    return rows.withColumn("last_updated", F.timestamp_seconds("ts"))


@pytest.mark.parametrize("block_rows", [10**6, 100, 0])
@pytest.mark.parametrize("limit", [None, 0])
def test_rolling_equals_range_window(spark, make_readings, block_rows, limit):
    rows = dense(spark, make_readings)
    rolled = ft.rolling(rows, block_rows=block_rows, broadcast_bytes=limit)
    same(naive_rolling(rows), rolled, rolled.columns)


@pytest.mark.parametrize("seconds", [60, 86400 * 3])
def test_rolling_with_other_ranges_and_keys(spark, make_readings, seconds):
    rows = dense(spark, make_readings)
    rolled = ft.rolling(rows, keys=["pollutant"], seconds=seconds)
    same(naive_rolling(rows, ["pollutant"], seconds), rolled, rolled.columns)


def test_rolling_before_1970_and_with_missing_values(make_readings):
    rows = make_readings([("a", "b", "O3", v, t) for v, t in (
        (1.0, -20000), (None, -15000), (3.0, -9300), (None, 90000), (5.0, 0))])
    rolled = ft.rolling(rows)
    same(naive_rolling(rows), rolled, rolled.columns)


@pytest.mark.parametrize("limit", [None, 0])
@pytest.mark.parametrize("parts", [1, 4, 17])
def test_feature_table_equals_window_forms(spark, make_readings, limit, parts):
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    rows = dense(spark, make_readings).drop("ts")
    table = ft.build_features(rows, broadcast_bytes=limit)
    assert table.columns == ft.FEATURE_COLUMNS
    series, pollutant = Window.partitionBy("city", "location", "pollutant"), Window.partitionBy("pollutant")
    v, low = F.col("value"), F.min("value").over(pollutant)
    expected = naive_rolling(ft.calendar_features(rows)).withColumns(
        {
            "avg_value": F.avg("value").over(series),
            "max_value": F.max("value").over(series),
            "min_value": F.min("value").over(series),
            "num_readings": F.count("value").over(series),
            "station_pollutant_count": F.count(F.lit(1)).over(series),
            "global_index": (v - low) / (F.max("value").over(pollutant) - low),
            "value_z_score_by_pollutant": (v - F.avg("value").over(pollutant))
            / F.stddev("value").over(pollutant),
        }
    )
    same(expected, table, ft.FEATURE_COLUMNS)


def test_feature_invariants(spark):
    from stationkit.catalog.base import readings

    rows = readings(spark, "/root/testdata/sf0.001")
    table = ft.build_features(rows).cache()
    assert table.count() == rows.count()
    assert table.where("global_index NOT BETWEEN 0 AND 1").count() == 0
    assert table.where("value NOT BETWEEN rolling_min_3h AND rolling_max_3h").count() == 0
    means = table.groupBy("pollutant").agg(F.avg("value_z_score_by_pollutant").alias("m"))
    assert means.where("abs(m) > 1e-9").count() == 0


def test_readings_cross_one_shuffle(spark):
    """Index, score and statistics come by broadcast; only the rolling part moves rows."""
    from stationkit.catalog.base import readings

    table = ft.build_features(readings(spark, "/root/testdata/sf0.001"))
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
