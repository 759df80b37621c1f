"""Encoding, feature ranking and comparison of regression models."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Model, Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationkit.functions.numeric import split_bucket
from stationkit.plans.keyed import attach
from stationkit.plans.ordered import dense_ids
from stationkit.plans.stored import store
from stationkit.schema import SERIES

LABEL = "global_index"
SEED = 42
TREES = 50
BOOSTING_ROUNDS = 50
LINEAR_ITERATIONS = 100

# Columns that identify a row or are replaced by an encoding.
NOT_FEATURES = {LABEL, "pollutant", "city", "location", "season", "last_updated", "ts"}
# Columns computed from the row's own value, of which the label is a function.
SAME_ROW = {
    "value",
    "value_z_score_by_pollutant",
    "rolling_mean_3h",
    "rolling_max_3h",
    "rolling_min_3h",
}


def _micros_without_zone(time: str) -> Column:
    """Microseconds of a time without zone, counted as if it were UTC."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", zero, F.col(time))


def train_test_split(
    df: DataFrame, keys: Sequence[str], test_percent: int = 20
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the row key: the same rows on every run and layout.

    Copies of a row fall on the same side. Times count as microseconds, so the
    split does not depend on the session's time zone.
    """
    kinds = dict(df.dtypes)
    at = {"timestamp": F.unix_micros, "timestamp_ntz": _micros_without_zone}
    bucket = split_bucket([at.get(kinds[k], F.col)(k) for k in keys])
    marked = df.withColumn("_bucket", bucket)
    train = marked.where(F.col("_bucket") >= test_percent).drop("_bucket")
    test = marked.where(F.col("_bucket") < test_percent).drop("_bucket")
    return train, test


def mean_encode(
    df: DataFrame,
    fit_on: DataFrame | None = None,
    columns: Iterable[str] = ("city", "location"),
    target: str = LABEL,
    broadcast_bytes: int | None = None,
    leave_out: bool = False,
) -> DataFrame:
    """Add the mean target of each category as ``<column>_encode``.

    The means come from ``fit_on``, normally the training rows; categories that
    it lacks get its overall mean. Leaving it out uses ``df`` itself, which lets
    every row see its own target, unless ``leave_out`` takes the mean over the
    other rows of the category. A row alone in its category then gets the overall
    mean.
    """
    source = df if fit_on is None else fit_on
    encoded = df
    fallback = fit_on is not None or leave_out
    overall = source.agg(F.avg(target)).first()[0] if fallback else None
    for column in columns:
        name = f"{column}_encode"
        means = source.groupBy(column).agg(
            F.avg(target).alias(name), F.sum(target).alias("_sum"), F.count(target).alias("_n"),
            F.count(F.lit(1)).alias("_rows"),
        )
        # The row counts describe df only when the means were taken from it.
        weight = "_rows" if fit_on is None else None
        encoded = attach(encoded, means, [column], weight=weight, broadcast_bytes=broadcast_bytes)
        if leave_out:
            own = F.col(target)
            others = F.try_divide(F.col("_sum") - own, F.col("_n") - 1)
            encoded = encoded.withColumn(name, F.when(own.isNull(), F.col(name)).otherwise(others))
        if fallback:
            encoded = encoded.withColumn(name, F.coalesce(name, F.lit(overall)))
        encoded = encoded.drop("_sum", "_n", "_rows")
    return encoded


def string_index(df: DataFrame, column: str) -> DataFrame:
    """Labels numbered by frequency, most frequent first, ties by name: label, count, index.

    Numbering is spread over tasks, so there may be any number of labels. A null
    is no label.
    """
    known = df.where(F.col(column).isNotNull())
    counts = known.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    ranked = dense_ids(counts.withColumn("_fewer", -F.col("count")), ["_fewer", column], "index")
    return ranked.select(column, "count", F.col("index").cast("int").alias("index"))


def category_stages(columns: Sequence[str]) -> list:
    """Indexer and one-hot encoder for each text column; unseen labels are kept."""
    indexed = [f"_{c}_index" for c in columns]
    return [
        StringIndexer(inputCols=list(columns), outputCols=indexed, handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_encode" for c in columns]),
    ]


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add a 0/1 vector ``<column>_encode`` for each text column."""
    fitted = Pipeline(stages=category_stages(columns)).fit(df)
    return fitted.transform(df).drop(*(f"_{c}_index" for c in columns))


def candidate_features(df: DataFrame, leaky: bool = False) -> list[str]:
    """Feature columns by exclusion.

    ``leaky=True`` keeps the value and its same-row derivatives among them, from
    which the label follows directly.
    """
    excluded = NOT_FEATURES if leaky else NOT_FEATURES | SAME_ROW
    return [c for c in df.columns if c not in excluded and not c.startswith("_")]


@dataclass(frozen=True)
class Prepared:
    """Encoded, split and assembled data, ready to fit."""

    train: DataFrame
    test: DataFrame
    features: list[str]


def prepare(
    features: DataFrame, leaky: bool = False, keys: Sequence[str] | None = None
) -> Prepared:
    """Encode, split 80/20 and assemble the feature table.

    With ``leaky=True`` category means are taken over all rows before the split;
    otherwise every encoding is fitted on the training rows only, and a training
    row's own label is left out of its category means.
    """
    keys = [*SERIES, "last_updated", "value"] if keys is None else list(keys)
    usable = features.where(F.col(LABEL).isNotNull())
    if leaky:
        train, test = train_test_split(mean_encode(usable), keys)
    else:
        raw_train, raw_test = train_test_split(usable, keys)
        train = mean_encode(raw_train, leave_out=True)
        test = mean_encode(raw_test, fit_on=raw_train)
    encoder = Pipeline(stages=category_stages(["pollutant", "season"]))
    encoders = encoder.fit(train.unionByName(test) if leaky else train)
    columns = candidate_features(encoders.transform(train), leaky)
    assembler = VectorAssembler(inputCols=columns, outputCol="features")

    def finished(part: DataFrame, label: str) -> DataFrame:
        assembled = assembler.transform(encoders.transform(part))
        return store(assembled.select(*columns, LABEL, "features"), label).df

    return Prepared(finished(train, "train"), finished(test, "test"), columns)


def _slots(df: DataFrame, vector: str) -> list[str]:
    """Source column of every slot of an assembled vector, from its metadata."""
    attributes = df.schema[vector].metadata["ml_attr"]["attrs"]
    slots = [slot for kind in attributes.values() for slot in kind]
    names = {f.name for f in df.schema.fields if f.name != vector}
    by_index = {}
    for slot in slots:
        exact = slot["name"] in names
        # A slot of a vector column is named <column>_<label>.
        owner = slot["name"] if exact else max(
            (n for n in names if slot["name"].startswith(f"{n}_")), key=len
        )
        by_index[slot["idx"]] = owner
    return [by_index[i] for i in sorted(by_index)]


def feature_ranking(prepared: Prepared, trees: int = TREES) -> DataFrame:
    """Random-forest importance of each feature column, largest first.

    A one-hot column has one importance per label; they are added up.
    """
    train = prepared.train
    forest = RandomForestRegressor(
        labelCol=LABEL, featuresCol="features", numTrees=trees, seed=SEED
    )
    importances = forest.fit(train.select(LABEL, "features")).featureImportances.toArray()
    totals = dict.fromkeys(prepared.features, 0.0)
    for column, importance in zip(_slots(train, "features"), importances, strict=True):
        totals[column] += float(importance)
    ordered = sorted(totals.items(), key=lambda item: (-item[1], item[0]))
    rows = [(name, importance, rank) for rank, (name, importance) in enumerate(ordered, 1)]
    return train.sparkSession.createDataFrame(
        rows, "feature string, importance double, rank int"
    )


def regression_metrics(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """RMSE and R² of a prediction column."""
    return _metrics(predictions, label, {prediction: prediction})


def _metrics(predictions: DataFrame, label: str, columns: dict[str, str]) -> DataFrame:
    """RMSE and R² of several prediction columns in one pass."""
    y = F.col(label)

    def scores(name: str, column: str) -> Column:
        squared = F.pow(y - F.col(column), F.lit(2))
        return F.struct(
            F.lit(name).alias("name"),
            F.sqrt(F.avg(squared)).alias("rmse"),
            (1 - F.try_divide(F.avg(squared), F.var_pop(y))).alias("r2"),
        )

    all_scores = F.array(*(scores(n, c) for n, c in columns.items()))
    return predictions.agg(all_scores.alias("_scores")).select(F.inline("_scores"))


def regressors(label: str, features: str) -> dict[str, object]:
    """The four compared estimators by name."""
    common = {"labelCol": label, "featuresCol": features}
    return {
        "RandomForest": RandomForestRegressor(numTrees=TREES, seed=SEED, **common),
        "DecisionTree": DecisionTreeRegressor(seed=SEED, **common),
        "GBT": GBTRegressor(maxIter=BOOSTING_ROUNDS, seed=SEED, **common),
        "LinearRegression": LinearRegression(
            maxIter=LINEAR_ITERATIONS, regParam=0.0, **common
        ),
    }


def compare_models(
    train: DataFrame, test: DataFrame, label: str, features: str
) -> tuple[DataFrame, dict[str, Model]]:
    """Fit every regressor, all at the same time, and rank them by RMSE on the test rows.

    All predictions are added as columns and scored in a single pass.
    """
    train = train.select(label, features).persist()
    candidates = regressors(label, features)
    # The fits do not depend on each other; a small one fills the gaps of a large one.
    with ThreadPoolExecutor(max_workers=len(candidates)) as pool:
        models = pool.map(lambda estimator: estimator.fit(train), candidates.values())
        fitted: dict[str, Model] = dict(zip(candidates, models, strict=True))
    train.unpersist()
    predicted = test
    for name, model in fitted.items():
        predicted = model.setPredictionCol(f"_{name}").transform(predicted)
    board = _metrics(predicted, label, {name: f"_{name}" for name in fitted})
    best_first = Window.partitionBy(F.lit(0)).orderBy("rmse", "name")
    return board.withColumn("rank", F.row_number().over(best_first)), fitted


def model_leaderboard(prepared: Prepared, top: int = 10) -> DataFrame:
    """Name, RMSE, R² and rank of each model on the ``top`` ranked features."""
    ranking = feature_ranking(prepared)
    chosen = [r.feature for r in ranking.where(F.col("rank") <= top).orderBy("rank").collect()]
    assembler = VectorAssembler(inputCols=chosen, outputCol="features_top")
    board, _ = compare_models(
        assembler.transform(prepared.train),
        assembler.transform(prepared.test),
        LABEL,
        "features_top",
    )
    return board


def best_model(board: DataFrame) -> DataFrame:
    """The leaderboard row with the lowest RMSE."""
    return board.orderBy("rmse", "name").limit(1)
