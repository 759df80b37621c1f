"""Streaming ingestion, sliding windows and scoring, with durable checkpoints."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stationkit.operators.clean import clean_rows, normal_rows
from stationkit.plans.stored import fresh_path
from stationkit.schema import POLLUTANT_CAPS, READING, SERIES, STATION


def read_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    form: str = "parquet",
    files_per_trigger: int | None = None,
    **options: object,
) -> DataFrame:
    """Stream of files that arrive in a folder, read with a given schema."""
    reader = spark.readStream.schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(form).load(folder)


def stream_ingest(readings: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Normalised, complete, distinct readings.

    The row-wise cleaning is the batch code. Duplicates are recognised as long
    as they arrive within the watermark, which bounds the state.
    """
    clean = normal_rows(readings).withWatermark("last_updated", lateness)
    return clean.dropDuplicatesWithinWatermark(READING)


def stream_clean(
    raw: DataFrame, caps: Mapping[str, float] = POLLUTANT_CAPS, lateness: str = "1 hour"
) -> DataFrame:
    """Raw rows to normalised, distinct, in-range readings, as the batch cleaning makes them.

    Everything row-wise is the batch code: dropping, splitting of labels, range
    check, text. Only the duplicate removal differs: copies are recognised as
    long as they arrive within the watermark.
    """
    clean = clean_rows(raw, caps).withWatermark("last_updated", lateness)
    return clean.dropDuplicatesWithinWatermark(READING)


def drain_checked(lines: DataFrame, folder: str, corrupt: str = "_corrupt") -> tuple[DataFrame, DataFrame]:
    """Run a stream of parsed lines over everything available, good and bad ones apart.

    ``corrupt`` is the column in which the reader leaves what it could not read.
    Returns (good, bad). Every micro-batch writes a folder of its own, which a
    repeated batch overwrites, so a restart neither loses nor repeats lines.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        bad = F.col(corrupt).isNotNull()
        batch.where(~bad).drop(corrupt).write.mode("overwrite").parquet(f"{folder}/good/batch={number}")
        batch.where(bad).select(corrupt).write.mode("overwrite").parquet(f"{folder}/bad/batch={number}")
        batch.unpersist()

    query = (
        lines.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{folder}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    spark = lines.sparkSession
    good = T.StructType([f for f in lines.schema.fields if f.name != corrupt])
    bad = T.StructType([lines.schema[corrupt]])
    return tuple(
        spark.read.schema(schema).parquet(f"{folder}/{name}/batch=*")
        for name, schema in (("good", good), ("bad", bad))
    )


def stream_sessions(
    readings: DataFrame, gap: str = "12 hours", lateness: str = "1 hour"
) -> DataFrame:
    """Runs of readings of a series without a pause longer than ``gap``.

    The same runs as ``temporal.episodes``, each emitted once no reading within
    the watermark can still lengthen it. Sessions that a reading joins are merged
    in the state.
    """
    watched = readings.withWatermark("last_updated", lateness)
    runs = watched.groupBy(F.session_window("last_updated", gap), *SERIES).agg(
        F.min("last_updated").alias("episode_start"),
        F.max("last_updated").alias("episode_end"),
        F.count(F.lit(1)).alias("num_readings"),
        F.max("value").alias("peak_value"),
        F.avg("value").alias("mean_value"),
    )
    return runs.drop("session_window")


def stream_calibrated(
    readings: DataFrame,
    calibrations: DataFrame,
    within: str = "6 hours",
    lateness: str = "1 hour",
) -> DataFrame:
    """Every reading with the calibrations of its station in the time ``within`` before it.

    Two streams are joined; ``calibrations`` has ``calibrated_at, calibration``
    beside the station. Both watermarks bound the state: a reading is kept until
    no calibration can come for it any more, and is then emitted with nulls if
    none has; a calibration is kept for ``within`` and the lateness. Readings
    with a null station or time are not emitted.
    """
    left = readings.withWatermark("last_updated", lateness)
    right = calibrations.withWatermark("calibrated_at", lateness).withColumnsRenamed(
        {c: f"_{c}" for c in STATION}
    )
    same = [F.col(c) == F.col(f"_{c}") for c in STATION]
    near = (F.col("last_updated") >= F.col("calibrated_at")) & (
        F.col("last_updated") <= F.col("calibrated_at") + F.expr(f"INTERVAL {within}")
    )
    joined = left.join(right, [*same, near], "left_outer")
    return joined.drop(*(f"_{c}" for c in STATION))


def stream_sliding(
    readings: DataFrame,
    length: str = "3 hours",
    slide: str = "1 hour",
    lateness: str = "1 hour",
) -> DataFrame:
    """Mean, max, min and count per series over sliding event-time windows.

    Windows are emitted once the watermark has passed their end; readings for a
    window already emitted are dropped.
    """
    window = F.window("last_updated", length, slide)
    rolled = (
        readings.withWatermark("last_updated", lateness)
        .groupBy(window, *SERIES)
        .agg(
            F.avg("value").alias("mean_value"),
            F.max("value").alias("max_value"),
            F.min("value").alias("min_value"),
            F.count(F.lit(1)).alias("num_readings"),
        )
    )
    return rolled.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *SERIES,
        "mean_value",
        "max_value",
        "min_value",
        "num_readings",
    )


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    """Save a fitted pipeline and load it as a separate scoring job would."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def stream_score(rows: DataFrame, model: PipelineModel) -> DataFrame:
    """Predictions of a fitted pipeline for every arriving row."""
    return model.transform(rows)


def start_files(
    stream: DataFrame, folder: str, available_now: bool = True, interval: str = "1 minute"
) -> StreamingQuery:
    """Write a stream to Parquet under ``folder/data``, progress in ``folder/progress``.

    ``available_now`` handles what has arrived and stops; otherwise the query
    keeps running. Restarting on the same folder continues where it stopped.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{folder}/data")
        .option("checkpointLocation", f"{folder}/progress")
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()


def drain(stream: DataFrame, folder: str | None = None) -> DataFrame:
    """Run a stream over everything available and return what it has written.

    Without a folder it is a new one, so nothing is continued.
    """
    folder = folder or fresh_path(stream.sparkSession, "stream")
    start_files(stream, folder).awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/data")
