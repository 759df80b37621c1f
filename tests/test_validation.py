"""Time-blocked cross-validation against numpy, and the choice of a model."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F
from stationkit.operators import validation


def lines(*columns):
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="_x"),
        LinearRegression(featuresCol="_x", labelCol="y"),
    ])


@pytest.fixture(scope="module")
def rows(spark):
    random = np.random.default_rng(0)
    t = np.sort(random.integers(0, 40_000, 400))
    x = random.normal(size=(400, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 1 + 0.3 * random.normal(size=400)
    data = [(int(a), float(b), float(c), float(d)) for a, (b, c), d in zip(t, x, y, strict=True)]
    df = spark.createDataFrame([*data, (5, 1.0, 1.0, None)], "t bigint, x1 double, x2 double, y double")
    return df.withColumn("t", F.timestamp_seconds("t")), (t, x, y)


def normal_equations(x, y, train, test):
    a = np.column_stack((x, np.ones(len(x))))
    beta = np.linalg.solve(a[train].T @ a[train], a[train].T @ y[train])
    off = y[test] - a[test] @ beta
    return np.sqrt((off**2).mean()), 1 - (off**2).mean() / y[test].var()


@pytest.mark.parametrize("gap", [0, 3_000])
def test_scores_equal_normal_equations(rows, gap):
    df, (t, x, y) = rows
    scores = validation.cross_validate(df, {"one": lines("x1"), "both": lines("x1", "x2")}, "y", "t", 3, gap)
    got = {(r.name, r.fold): r for r in scores.collect()}
    assert len(got) == 6
    for fold in validation.time_folds(int(t.min()), int(t.max()), 3, gap):
        train, test = t < fold.train_until, (t >= fold.begin) & (t < fold.end)
        for name, used in (("one", x[:, :1]), ("both", x)):
            r = got[name, fold.number]
            rmse, r2 = normal_equations(used, y, train, test)
            assert (r.rmse, r.r2) == (pytest.approx(rmse, rel=1e-6), pytest.approx(r2, rel=1e-6))
            assert (r.train_rows, r.test_rows) == (train.sum(), test.sum())


def test_folds_cover_the_time_once():
    folds = validation.time_folds(100, 1_099, 4, 50)
    assert [(f.begin, f.end) for f in folds] == [(300, 500), (500, 700), (700, 900), (900, 1_100)]
    assert all(f.train_until == f.begin - 50 for f in folds)
    with pytest.raises(ValueError, match="folds"):
        validation.time_folds(0, 1, 0)


def test_best_model_is_kept_with_its_parameters(rows, tmp_path):
    df, _ = rows
    tree = Pipeline(stages=[VectorAssembler(inputCols=["x1"], outputCol="_x"),
                            DecisionTreeRegressor(featuresCol="_x", labelCol="y", maxDepth=2)])
    models = {"tree": tree, "line": lines("x1", "x2")}
    scores = validation.cross_validate(df, models, "y", "t", 2, parallel=1)
    name, model = validation.fit_best(df, models, scores, "y", str(tmp_path / "model"))
    assert name == "line"
    loaded = PipelineModel.load(str(tmp_path / "model")).stages[-1]
    assert loaded.coefficients == model.stages[-1].coefficients and loaded.coefficients[0] == pytest.approx(3, abs=0.1)


def test_empty_folds(rows):
    df, _ = rows
    early = df.where(F.unix_seconds("t") < 3_000).unionByName(df.where(F.unix_seconds("t") > 38_000))
    scores = validation.cross_validate(early, {"line": lines("x1")}, "y", "t", 3)
    assert [r.rmse is None for r in scores.orderBy("fold").collect()] == [True, True, False]
    none = validation.cross_validate(df.where("false"), {"line": lines("x1")}, "y", "t")
    assert none.count() == 0 and validation.best_name(none) is None
