"""Per-reading features: calendar, series statistics, scaled values, rolling windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationkit.functions.calendar import calendar_columns, epoch_seconds
from stationkit.functions.numeric import min_max, z_score
from stationkit.plans.keyed import attach
from stationkit.plans.stored import StoredTable, store
from stationkit.schema import ROLLING_SECONDS, SERIES

# Rolling blocks with more rows than this are reduced to one row per second first.
BLOCK_ROWS = 1_000_000
# Series with at most so many readings in every frame are rolled by Spark's own range window, which
# looks at each reading of a frame again; they are cut into stretches of so many frames.
FRAME_ROWS = 1024
STRETCH = 64

FEATURE_COLUMNS = [
    "city", "location", "pollutant", "value", "last_updated",
    "hour", "day", "month", "year",
    "avg_value", "max_value", "min_value", "num_readings",
    "global_index", "is_weekend", "season", "ts", "is_rush_hour",
    "rolling_mean_3h", "rolling_max_3h", "rolling_min_3h",
    "value_z_score_by_pollutant", "station_pollutant_count",
]


def calendar_features(readings: DataFrame) -> DataFrame:
    """Add the calendar columns of ``last_updated``."""
    return readings.withColumns(calendar_columns(F.col("last_updated")))


def series_stats(readings: DataFrame) -> DataFrame:
    """Average, extremes and count of each series."""
    return readings.groupBy(*SERIES).agg(
        F.avg("value").alias("avg_value"),
        F.max("value").alias("max_value"),
        F.min("value").alias("min_value"),
        F.count("value").alias("num_readings"),
    )


def with_series_stats(
    readings: DataFrame, broadcast_bytes: int | None = None
) -> DataFrame:
    """Every reading with the statistics of its series."""
    return attach(
        readings,
        series_stats(readings),
        SERIES,
        weight="num_readings",
        broadcast_bytes=broadcast_bytes,
    )


def series_count(readings: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """Every reading with the number of readings in its series."""
    counts = readings.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("station_pollutant_count")
    )
    return attach(
        readings,
        counts,
        SERIES,
        weight="station_pollutant_count",
        broadcast_bytes=broadcast_bytes,
    )


def pollutant_scale(readings: DataFrame) -> DataFrame:
    """Range, mean and sample deviation of each pollutant.

    A window by pollutant would give the same numbers but send each pollutant's
    readings to one task; grouping first moves one row per pollutant and task.
    """
    return readings.groupBy("pollutant").agg(
        F.min("value").alias("_low"),
        F.max("value").alias("_high"),
        F.avg("value").alias("_mean"),
        F.stddev("value").alias("_std"),
        F.count(F.lit(1)).alias("_rows"),
    )


def _scaled(
    readings: DataFrame, index: bool, score: bool, broadcast_bytes: int | None
) -> DataFrame:
    joined = attach(
        readings,
        pollutant_scale(readings),
        ["pollutant"],
        weight="_rows",
        broadcast_bytes=broadcast_bytes,
    )
    columns = {}
    value = F.col("value")
    if index:
        columns["global_index"] = min_max(value, F.col("_low"), F.col("_high"))
    if score:
        columns["value_z_score_by_pollutant"] = z_score(value, F.col("_mean"), F.col("_std"))
    return joined.withColumns(columns).drop("_low", "_high", "_mean", "_std", "_rows")


def global_index(readings: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """Min-max position of each value within its pollutant; null if all are equal."""
    return _scaled(readings, True, False, broadcast_bytes)


def zscore(readings: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """Standard score of each value within its pollutant; 0 without spread."""
    return _scaled(readings, False, True, broadcast_bytes)


def _with_blocks(readings: DataFrame, seconds: int) -> DataFrame:
    """Give each reading to its own time block and to the one after it.

    Blocks are as long as the frame. The later copy is moved forward by one
    frame: it belongs to the frames of all own readings up to that moment
    ``_at``. It carries no other columns, to keep the shuffle lean.
    """
    shift, value = F.col("_shift"), F.col("value")
    placed = readings.withColumn("_shift", F.explode(F.array(F.lit(0), F.lit(1))))
    return placed.withColumns(
        {
            "_block": F.floor(F.col("ts") / seconds) + shift,
            "_at": F.col("ts") + shift * seconds,
            "_own": shift == 0,
            "_now": F.when(shift == 0, value),
            "_old": F.when(shift == 1, value),
        }
    ).drop("_shift")


# Aggregate and column prefix of each running measure over single readings.
_SINGLE = {
    "sum": (F.sum, ""),
    "count": (F.count, ""),
    "max": (F.max, ""),
    "min": (F.min, ""),
}
# The same over rows that already sum up one second.
_PER_SECOND = {
    "sum": (F.sum, "_sum"),
    "count": (F.sum, "_count"),
    "max": (F.max, "_max"),
    "min": (F.min, "_min"),
}


def _roll(part: DataFrame, keys: list[str], names: list[str], measures: dict) -> DataFrame:
    """Combine the two halves of every frame.

    A frame is the own block up to now plus the end of the block before it. Both
    are running aggregates, one forwards and one backwards in time, so the work
    per reading does not grow with the number of readings in a frame.
    """
    # The block leads: sorting by a number first is cheaper than by names.
    block = Window.partitionBy("_block", *keys)
    until = (Window.unboundedPreceding, Window.currentRow)
    so_far = block.orderBy("_at").rangeBetween(*until)
    still_in = block.orderBy(F.desc("_at")).rangeBetween(*until)

    def halves(measure: str) -> tuple[Column, Column]:
        aggregate, kind = measures[measure]
        return aggregate(f"_now{kind}").over(so_far), aggregate(f"_old{kind}").over(still_in)

    def added(measure: str) -> Column:
        own, earlier = (F.coalesce(half, F.lit(0)) for half in halves(measure))
        return own + earlier

    mean, high, low = names
    return part.withColumns(
        {
            mean: F.try_divide(added("sum"), added("count")),
            high: F.greatest(*halves("max")),
            low: F.least(*halves("min")),
        }
    ).where("_own")


def _dense_series(readings: DataFrame, keys: list[str], seconds: int, most: int) -> StoredTable:
    """Keys of the series that have more than ``most`` readings within one block of a frame's length.

    Only series with more readings in all are looked at by block.
    """
    totals = readings.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = store(totals.where(F.col("_n") > most).select(*keys, "_n"), "large-series")
    if not large.rows:
        return large.view(large.df.drop("_n"))
    own = attach(readings.select(*keys, "ts"), large, keys, "inner", weight="_n")
    blocks = own.groupBy(*keys, F.floor(F.col("ts") / seconds).alias("_block")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    return store(blocks.where(F.col("_rows") > most).select(*keys).distinct(), "dense-series")


def _rolled_by_range(
    readings: DataFrame, keys: list[str], names: list[str], seconds: int
) -> DataFrame:
    """Spark's range window over stretches of a series; only a stretch's last frame is repeated."""
    span, stretch = seconds * STRETCH, F.floor(F.col("ts") / (seconds * STRETCH))
    reaches_on = F.col("ts") >= (stretch + 1) * span - seconds
    placed = readings.withColumn(
        "_stretch",
        F.explode(F.when(reaches_on, F.array(stretch, stretch + 1)).otherwise(F.array(stretch))),
    )
    # The stretch leads: sorting by a number first is cheaper than by names.
    frame = Window.partitionBy("_stretch", *keys).orderBy("ts").rangeBetween(-seconds, 0)
    aggregates = (F.avg("value"), F.max("value"), F.min("value"))
    rolled = placed.withColumns({n: a.over(frame) for n, a in zip(names, aggregates, strict=True)})
    return rolled.where(stretch.eqNullSafe(F.col("_stretch"))).drop("_stretch")


def rolling(
    readings: DataFrame,
    keys: list[str] | None = None,
    seconds: int = ROLLING_SECONDS,
    suffix: str = "3h",
    block_rows: int = BLOCK_ROWS,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Trailing mean, max and min over a time range, current time and ties included.

    Needs an epoch-second column ``ts``. A series is cut along time, so a long
    one spreads over many tasks. Most series have few readings in a frame and go
    through one range window; those with more than ``FRAME_ROWS`` in some frame
    through running aggregates, whose work per reading does not grow with the
    readings in a frame (see ``_rolled_by_blocks``).
    """
    keys = SERIES if keys is None else list(keys)
    names = [f"rolling_{f}_{suffix}" for f in ("mean", "max", "min")]
    dense = _dense_series(readings, keys, seconds, min(FRAME_ROWS, block_rows))
    if not dense.rows:
        return _rolled_by_range(readings, keys, names, seconds)
    flagged = dense.view(dense.df.withColumn("_dense", F.lit(True)))
    marked = attach(readings, flagged, keys, broadcast_bytes=broadcast_bytes)
    sparse = marked.where(F.col("_dense").isNull()).drop("_dense").select(*readings.columns)
    crowded = marked.where(F.col("_dense")).drop("_dense").select(*readings.columns)
    return _rolled_by_range(sparse, keys, names, seconds).unionByName(
        _rolled_by_blocks(crowded, keys, names, seconds, block_rows, broadcast_bytes)
    )


def _rolled_by_blocks(
    readings: DataFrame,
    keys: list[str],
    names: list[str],
    seconds: int,
    block_rows: int,
    broadcast_bytes: int | None,
) -> DataFrame:
    """Frames put together from running aggregates over blocks as long as the range.

    A block with more than ``block_rows`` rows is first reduced to one row per
    second, which bounds it by the seconds in the range; its readings then look
    their result up.
    """
    blocked = _with_blocks(readings, seconds)

    counts = blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    full = store(counts.where(F.col("_n") > block_rows), "full-blocks")

    def each_reading(part: DataFrame) -> DataFrame:
        needed = {*keys, "_block", "_at", "_own", "_now", "_old"}
        carried = [c for c in readings.columns if c not in needed]
        lean = part.withColumns({c: F.when(F.col("_own"), F.col(f"`{c}`")) for c in carried})
        return _roll(lean, keys, names, _SINGLE).select(*readings.columns, *names)

    if full.rows == 0:
        return each_reading(blocked)

    marked = attach(blocked, full, [*keys, "_block"], broadcast_bytes=broadcast_bytes)
    crowded = marked.where(F.col("_n").isNotNull())
    each_second = crowded.groupBy(*keys, "_block", "_at").agg(
        *(
            aggregate(side).alias(f"{side}_{name}")
            for side in ("_now", "_old")
            for name, (aggregate, _) in _SINGLE.items()
        ),
        F.bool_or("_own").alias("_own"),
        F.count_if("_own").alias("_rows"),
    )
    results = _roll(each_second, keys, names, _PER_SECOND).select(
        *keys, F.col("_at").alias("ts"), *names, "_rows"
    )
    looked_up = attach(
        crowded.where("_own").select(*readings.columns),
        results,
        [*keys, "ts"],
        weight="_rows",
        broadcast_bytes=broadcast_bytes,
    )
    return each_reading(marked.where(F.col("_n").isNull())).unionByName(
        looked_up.select(*readings.columns, *names)
    )


def build_features(readings: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """The full feature table of clean readings.

    Series statistics and the series count come from one aggregate, index and
    z-score from another; the readings themselves are shuffled once, by series
    and day, for the rolling columns. Pass a stored table: it is scanned a few
    times.
    """
    timed = readings.withColumn("ts", epoch_seconds(F.col("last_updated")))
    rolled = rolling(timed, broadcast_bytes=broadcast_bytes)
    stats = attach(
        calendar_features(rolled),
        series_stats(readings),
        SERIES,
        weight="num_readings",
        broadcast_bytes=broadcast_bytes,
    )
    scaled = attach(
        stats,
        pollutant_scale(readings),
        ["pollutant"],
        weight="_rows",
        broadcast_bytes=broadcast_bytes,
    )
    value = F.col("value")
    complete = scaled.withColumns(
        {
            "global_index": min_max(value, F.col("_low"), F.col("_high")),
            "value_z_score_by_pollutant": z_score(value, F.col("_mean"), F.col("_std")),
            "station_pollutant_count": F.col("num_readings"),
        }
    )
    return complete.select(*FEATURE_COLUMNS)
