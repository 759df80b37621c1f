"""Grouping sets, sketches merged over groupings, exact percentiles of large groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from stationkit.operators import cubes
from stationkit.plans import flow


def cells(spark, rows):
    df = spark.createDataFrame(rows, "city string, location string, pollutant string, value double, hour int")
    return flow.rollup(df.withColumns({"month": F.lit(1), "season": F.lit("Winter"), "is_weekend": F.lit(0)}))


ROWS = [("a", "x", "p", 1.0, 1), ("a", "x", "q", 3.0, 1), (None, "y", "p", 8.0, 2), ("b", "z", None, None, 2)]


def test_null_in_the_data_is_told_from_a_sum(spark):
    got = {
        (r.city, r.pollutant, r.grouping): (r.avg_value, r.num_measurements)
        for r in cubes.sets_report(cells(spark, ROWS), ["city", "pollutant"]).collect()
    }
    assert len(got) == 4 + 3 + 3 + 1
    assert got[None, None, 3] == (4.0, 4) and got[None, None, 1] == (8.0, 1)
    assert got[None, None, 2] == (None, 1) and got[None, "p", 2] == (4.5, 2) and got["b", None, 0] == (None, 1)


def test_chosen_sets(spark):
    found = cubes.sets_report(cells(spark, ROWS), ["city", "pollutant", "hour"], [["city"], ["pollutant", "hour"], []])
    assert sorted(r.grouping for r in found.collect()) == [3] * 3 + [4] * 4 + [7]
    assert cubes.rollup_sets(["a", "b"]) == [["a", "b"], ["a"], []]
    empty = cubes.sets_report(cells(spark, ROWS).where("false"), ["city"], [["city"], ["city"]])
    assert empty.count() == 0


def test_readings_are_not_expanded(spark):
    plan = cubes.sets_report(cells(spark, ROWS), ["city", "pollutant"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Expand") < plan.rindex("HashAggregate")
    below = plan[plan.index("Expand"):]
    assert "HashAggregate" in below and "Exchange" in below


@pytest.mark.parametrize("shape", ["smooth", "steps", "heavy"])
def test_merged_sketches_keep_the_rank_error(spark, shape):
    """Many small cells and one hot one, merged; ranks by counting."""
    random = np.random.default_rng(3)
    n = 60_000
    value = {"smooth": random.normal(size=n), "steps": random.integers(0, 5, n).astype(float),
             "heavy": np.exp(3 * random.normal(size=n))}[shape]
    cell = np.where(random.random(n) < 0.4, 0, random.integers(1, 500, n))
    rows = [(f"c{c % 7}", f"s{c}", "p", float(v), int(i)) for i, (c, v) in enumerate(zip(cell, value, strict=True))]
    df = spark.createDataFrame(rows, "city string, location string, pollutant string, value double, t int")
    df = df.withColumn("last_updated", F.timestamp_seconds(F.col("t") * 60))
    stored = cubes.sketch_rollup(df, ["city", "location"])
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    for by in (["city"], []):
        for r in cubes.quantiles_from_rollup(stored, by, probabilities).collect():
            own = value[cell % 7 == int(r.city[1:])] if by else value
            assert r.num_values == len(own)
            below, upto = (own < r.quantile).mean(), (own <= r.quantile).mean()
            assert below <= r.probability + cubes.RANK_ERROR and upto >= r.probability - cubes.RANK_ERROR
            if not by:
                assert abs(r.stations - 500) <= 30 and abs(r.days - 42) <= 3


def test_sketches_of_odd_cells(spark):
    rows = [("a", "x", None, 0), ("a", "x", float("nan"), 0), ("b", "y", 2.0, None), (None, "z", 5.0, 0)]
    df = spark.createDataFrame(rows, "city string, location string, value double, t int")
    stored = cubes.sketch_rollup(df.withColumn("last_updated", F.timestamp_seconds("t")), ["city"])
    got = {r.city: (r.quantile, r.num_values) for r in cubes.quantiles_from_rollup(stored, ["city"], [0.5]).collect()}
    assert got == {"b": (2.0, 1), None: (5.0, 1)}


@pytest.mark.parametrize("partitions", [3, 17])
def test_exact_quantiles(spark, partitions):
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    random = np.random.default_rng(9)
    groups = {"hot": random.normal(size=9_000), "ties": np.repeat([1.0, 2.0], 50), "one": np.array([4.0]),
              None: random.normal(size=11)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("hot", None), ("hot", float("nan")), ("gone", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probabilities = [0.0, 0.3, 0.5, 0.999, 1.0]
    got = {(r.g, r.probability): r.exact for r in cubes.exact_quantiles(df, ["g"], "v", probabilities).collect()}
    assert got == {(g, p): pytest.approx(np.quantile(vs, p)) for g, vs in groups.items() for p in probabilities}
    whole = cubes.exact_quantiles(df, [], "v", [0.5]).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert whole[0].exact == pytest.approx(np.median(np.concatenate(list(groups.values()))))
