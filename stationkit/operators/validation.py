"""Choosing a model by time-blocked cross-validation."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.plans.stored import store

# Fits that run at the same time; each is a series of Spark jobs over the same stored table.
PARALLEL = 4


@dataclass(frozen=True)
class Fold:
    """Rows before ``train_until`` are learned from, rows from ``begin`` to before ``end`` tested on."""

    number: int
    train_until: int
    begin: int
    end: int


def time_folds(low: datetime | int, high: datetime | int, folds: int, gap_seconds: float = 0) -> list[Fold]:
    """Spans of equal length: fold k learns from the first k spans and is tested on the next.

    The last ``gap_seconds`` before a test span are purged from its training
    rows, so that lagged features or labels that look ahead cannot leak. Ends are
    whole seconds; the last span includes the last moment.
    """
    first, last = (int(t.timestamp()) if isinstance(t, datetime) else int(t) for t in (low, high))
    if folds < 1:
        raise ValueError("folds must be at least 1")
    edges = [first + (last + 1 - first) * k // (folds + 1) for k in range(folds + 2)]
    return [Fold(k, int(edges[k] - gap_seconds), edges[k], edges[k + 1]) for k in range(1, folds + 1)]


def cross_validate(
    rows: DataFrame,
    models: Mapping[str, Estimator],
    label: str,
    time: str,
    folds: int = 3,
    gap_seconds: float = 0,
    parallel: int = PARALLEL,
) -> DataFrame:
    """Scores of every model on every fold: ``name, fold, rmse, r2, train_rows, test_rows``.

    Rows with a null label or time are left out. The table is stored once; the
    fits, which do not depend on each other, run ``parallel`` at a time over it.
    A fold without rows to learn from or to test on has null scores. ``r2`` is
    null where the labels of the test span are all equal. No rows: no scores.
    """
    spark = rows.sparkSession
    second = F.unix_seconds(F.col(time).cast("timestamp"))
    known = rows.where(F.col(label).isNotNull() & F.col(time).isNotNull())
    table = store(
        known.withColumn("_second", second), "validation",
        low=F.min(second), high=F.max(second),
    )
    kind = "name string, fold int, rmse double, r2 double, train_rows bigint, test_rows bigint"
    if not table.rows:
        return spark.createDataFrame([], kind)
    cuts = time_folds(table.seen["low"], table.seen["high"], folds, gap_seconds)
    counts = table.df.agg(
        *(F.count_if(F.col("_second") < f.train_until).alias(f"train{f.number}") for f in cuts),
        *(F.count_if(F.col("_second").between(f.begin, f.end - 1)).alias(f"test{f.number}") for f in cuts),
    ).first()

    def score(task: tuple[str, Fold]) -> tuple:
        name, fold = task
        train_rows, test_rows = counts[f"train{fold.number}"], counts[f"test{fold.number}"]
        if not train_rows or not test_rows:
            return name, fold.number, None, None, train_rows, test_rows
        train = table.df.where(F.col("_second") < fold.train_until)
        test = table.df.where(F.col("_second").between(fold.begin, fold.end - 1))
        off = F.col(label) - F.col("prediction")
        found = models[name].fit(train).transform(test).agg(
            F.sum(off * off).alias("sse"), F.var_pop(label).alias("spread")
        ).first()
        mse = found["sse"] / test_rows
        r2 = 1 - mse / found["spread"] if found["spread"] else None
        return name, fold.number, mse**0.5, r2, train_rows, test_rows

    tasks = [(name, fold) for name in sorted(models) for fold in cuts]
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        scores = list(pool.map(score, tasks))
    return spark.createDataFrame(scores, kind)


def best_name(scores: DataFrame) -> str | None:
    """The model with the smallest mean error over its folds; the first by name if equal."""
    means = scores.where("rmse IS NOT NULL").groupBy("name").agg(F.avg("rmse").alias("rmse"))
    best = means.orderBy("rmse", "name").first()
    return best["name"] if best else None


def fit_best(
    rows: DataFrame,
    models: Mapping[str, Estimator],
    scores: DataFrame,
    label: str,
    path: str | None = None,
) -> tuple[str, Model]:
    """The best model, fitted on all rows with a label, and saved with its parameters under ``path``."""
    name = best_name(scores)
    if name is None:
        raise ValueError("no model has a score")
    model = models[name].fit(rows.where(F.col(label).isNotNull()))
    if path:
        (model if isinstance(model, PipelineModel) else PipelineModel([model])).write().overwrite().save(path)
    return name, model
