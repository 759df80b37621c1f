"""Calendar parts of a reading time (session time zone, pinned to UTC by callers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hours that count as commuting peaks, both ends included.
RUSH_HOURS = ((7, 9), (17, 19))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere (null included)."""
    return F.when(condition, 1).otherwise(0)


def season(month: Column) -> Column:
    """Meteorological season; anything outside March-November is winter."""
    return (
        F.when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .when(month.between(9, 11), "Autumn")
        .otherwise("Winter")
    )


def is_weekend(time: Column) -> Column:
    return flag(F.weekday(time) >= 5)


def is_rush_hour(hour: Column) -> Column:
    morning, evening = (hour.between(*span) for span in RUSH_HOURS)
    return flag(morning | evening)


def epoch_seconds(time: Column) -> Column:
    return F.unix_timestamp(time)


def calendar_columns(time: Column) -> dict[str, Column]:
    """All calendar features by column name, in table order."""
    return {
        "hour": F.hour(time),
        "day": F.dayofmonth(time),
        "month": F.month(time),
        "year": F.year(time),
        "week": F.weekofyear(time),
        "is_weekend": is_weekend(time),
        "season": season(F.month(time)),
        "ts": epoch_seconds(time),
        "is_rush_hour": is_rush_hour(F.hour(time)),
    }
