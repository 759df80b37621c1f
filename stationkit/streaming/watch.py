"""Watching every series of a stream: silent sensors, stuck values, late readings.

The state of a series is the time and value of its last reading and how long
that value has lasted, whatever the number of readings seen. A timer in event
time goes off when a series has been silent for too long.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stationkit.plans.shipping import ship
from stationkit.schema import SERIES

STATE = "at bigint, value double, since bigint, repeats bigint"
ALERTS = (
    "city string, location string, pollutant string, kind string, since_us bigint, until_us bigint, "
    "value double"
)
_ALERT = Row("city", "location", "pollutant", "kind", "since_us", "until_us", "value")
# The state store that custom state needs.
STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SeriesWatch(StatefulProcessor):
    """Alerts of one series; see ``watch``."""

    def __init__(self, silence_us: int, stuck: int):
        self.silence_us, self.stuck = silence_us, stuck

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("last", STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        last = self.state.get()
        at, value, since, repeats = last or (None, None, None, 0)
        fresh = False
        for t, v in sorted((row["at"], row["value"]) for row in rows):
            if last and t < last[0]:
                yield _ALERT(*key, "late", t, None, v)
                continue
            fresh = True
            if at is not None and t - at > self.silence_us:
                yield _ALERT(*key, "silence", at, t, value)
            if v == value:
                repeats += 1
            else:
                since, repeats = t, 1
            if repeats == self.stuck:
                yield _ALERT(*key, "stuck", since, t, v)
            at, value = t, v
        if fresh:
            self.state.update((at, value, since, repeats))
            # A new series has no timer yet.
            for timer in list(self.handle.listTimers()) if last else ():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer((at + self.silence_us) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        at, value, _, _ = self.state.get()
        yield _ALERT(*key, "quiet", at, None, value)

    def close(self) -> None:
        pass


def watch(
    readings: DataFrame, silence: float, stuck: int, lateness: str = "1 hour"
) -> DataFrame:
    """Alerts of every series: ``city, location, pollutant, kind, since, until, value``.

    * ``silence``: two readings further apart than ``silence`` seconds.
    * ``quiet``: no reading for that long after the last one, by the watermark.
    * ``stuck``: the same value ``stuck`` times in a row (at least 2), told once a run.
    * ``late``: a reading older than one of its series already handled in an
      earlier batch. It is reported and otherwise ignored.

    Of readings with equal time the smaller value counts as the earlier. Readings
    with a null key, time or value are left out. Readings that are older than the
    watermark are dropped by Spark before they get here. Readings come to Python as
    rows, many series in one batch, since a table for each series costs far more
    than its readings. A series takes one task for its readings of a micro-batch; bound the batch with ``files_per_trigger``.
    """
    if stuck < 2:
        raise ValueError("stuck must be at least 2")
    spark = readings.sparkSession
    ship(spark)
    spark.conf.set(STORE_KEY, STORE)
    known = readings.na.drop(subset=[*SERIES, "last_updated", "value"])
    timed = known.withWatermark("last_updated", lateness).select(
        *SERIES, "last_updated", F.unix_micros("last_updated").alias("at"), "value"
    )
    alerts = timed.groupBy(*SERIES).transformWithState(
        SeriesWatch(round(silence * 1_000_000), stuck), ALERTS, "append", "eventtime"
    )
    return alerts.select(
        *SERIES, "kind", F.timestamp_micros("since_us").alias("since"),
        F.timestamp_micros("until_us").alias("until"), "value",
    )
