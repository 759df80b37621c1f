"""Short-horizon forecasts per series, from plain groupings and equality joins.

Lags and labels come from shifting each time bucket to the moments it serves and
grouping by that moment. No window orders a whole series in one task.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.functions.calendar import epoch_seconds
from stationkit.operators.learning import compare_models
from stationkit.plans.stored import store
from stationkit.schema import SERIES

HOUR = 3600


def forecast_naive(readings: DataFrame, horizon_h: int = 24) -> DataFrame:
    """Two baseline forecasts per series, ``horizon_h`` hours after its last reading.

    ``last_value`` repeats the last reading; ``hour_mean`` is the series average
    at the target's hour of the day, or over all hours where that is unknown.
    """
    ahead = F.make_interval(hours=F.lit(horizon_h))
    latest = readings.groupBy(*SERIES).agg(
        F.max(F.struct("last_updated", "value")).alias("_last"),
        F.avg("value").alias("_mean"),
    )
    latest = latest.select(
        *SERIES,
        F.col("_last.last_updated").alias("as_of"),
        F.col("_last.value").alias("_value"),
        "_mean",
        F.hour(F.col("_last.last_updated") + ahead).alias("_hour"),
    )
    hourly = readings.groupBy(*SERIES, F.hour("last_updated").alias("_hour")).agg(
        F.avg("value").alias("_hour_mean")
    )
    joined = latest.join(hourly, [*SERIES, "_hour"], "left")
    methods = F.array(
        F.struct(F.lit("last_value").alias("method"), F.col("_value").alias("prediction")),
        F.struct(
            F.lit("hour_mean").alias("method"),
            F.coalesce("_hour_mean", "_mean").alias("prediction"),
        ),
    )
    return joined.select(
        *SERIES, "as_of", F.lit(horizon_h).alias("horizon_h"), F.inline(methods)
    )


def lagged(
    readings: DataFrame, bucket_h: int = 24, lags: int = 3, horizon: int = 1
) -> DataFrame:
    """One row per series and bucket: its level, earlier levels and the later label.

    A bucket's average is sent to every moment at which it is a lag, and to the
    moment whose label it is; grouping by moment then lines them up in a single
    shuffle. A missing earlier level takes the current one. ``label`` is null
    where the future bucket has no readings.
    """
    seconds = bucket_h * HOUR
    number = F.floor(epoch_seconds(F.col("last_updated")) / seconds)
    levels = readings.groupBy(*SERIES, number.alias("_bucket")).agg(
        F.avg("value").alias("_level")
    )
    shifts = F.array(*(F.lit(s) for s in [*range(lags), -horizon]))
    served = levels.select(*SERIES, "_bucket", "_level", F.explode(shifts).alias("_shift"))

    def level_at(shift: int):
        return F.max(F.when(F.col("_shift") == shift, F.col("_level")))

    rows = served.groupBy(*SERIES, (F.col("_bucket") + F.col("_shift")).alias("moment")).agg(
        *(level_at(lag).alias(f"lag_{lag}") for lag in range(lags)),
        level_at(-horizon).alias("label"),
    )
    known = rows.where(F.col("lag_0").isNotNull())
    return known.withColumns(
        {f"lag_{lag}": F.coalesce(f"lag_{lag}", "lag_0") for lag in range(1, lags)}
    )


def _assembler(lags: int) -> VectorAssembler:
    return VectorAssembler(inputCols=[f"lag_{n}" for n in range(lags)], outputCol="features")


def forecast_model(
    readings: DataFrame,
    bucket_h: int = 24,
    lags: int = 3,
    horizon: int = 1,
    train_share: float = 0.8,
) -> DataFrame:
    """Compare regressors on predicting the level ``horizon`` buckets ahead.

    The split is by time: models are fitted on the earlier part of the period
    and scored on the later part; labels from the later part train nothing.
    """
    rows = lagged(readings, bucket_h, lags, horizon).where(F.col("label").isNotNull())
    table = store(_assembler(lags).transform(rows).select("moment", "features", "label"), "lags").df
    span = table.agg(
        F.floor(
            F.min("moment") + (F.max("moment") - F.min("moment")) * F.lit(train_share)
        ).alias("cut")
    ).scalar()
    board, _ = compare_models(
        table.where(F.col("moment") + horizon <= span),
        table.where(F.col("moment") > span),
        "label",
        "features",
    )
    return board


def forecast_table(
    readings: DataFrame, bucket_h: int = 24, lags: int = 1, horizon: int = 1
) -> DataFrame:
    """Linear forecast of every series from its latest bucket.

    ``as_of`` is the start of that bucket and ``horizon_h`` the hours from it to
    the start of the predicted one.
    """
    rows = store(lagged(readings, bucket_h, lags, horizon), "lags").df
    assembler = _assembler(lags)
    known = assembler.transform(rows.where(F.col("label").isNotNull()))
    model = LinearRegression(labelCol="label", featuresCol="features").fit(
        known.select("features", "label")
    )
    names = [f"lag_{n}" for n in range(lags)]
    latest = rows.groupBy(*SERIES).agg(F.max(F.struct("moment", *names)).alias("_latest"))
    current = latest.select(*SERIES, "_latest.*")
    return model.transform(assembler.transform(current)).select(
        *SERIES,
        F.timestamp_seconds(F.col("moment") * (bucket_h * HOUR)).alias("as_of"),
        F.lit(bucket_h * horizon).alias("horizon_h"),
        "prediction",
    )
