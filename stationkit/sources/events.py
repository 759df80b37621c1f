"""Adapters that present an event table as station readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CITIES = 12

# Pollutant label given to each event type in the raw form.
EVENT_POLLUTANTS = {
    "click": "PM10",
    "view": "NO2",
    "purchase": "O3,CO",
    "signup": "PM2.5",
    "error": "pm10",
}


def readings_from_events(events: DataFrame) -> DataFrame:
    """Users as stations spread over cities, event types as pollutants."""
    user = F.col("user_id")
    return events.select(
        F.concat(F.lit("c"), (user % CITIES).cast("string")).alias("city"),
        F.concat(F.lit("s"), user.cast("string")).alias("location"),
        F.col("event_type").alias("pollutant"),
        "value",
        F.col("ts").cast("timestamp").alias("last_updated"),
    )


def raw_from_events(events: DataFrame) -> DataFrame:
    """The ten-column raw layout, with names and labels that need cleaning.

    City names carry accents, every 25th user has a blank location, and labels
    include a combined and a wrongly cased one.
    """
    user = F.col("user_id")
    label = F.when(F.lit(False), "")
    for event_type, pollutant in EVENT_POLLUTANTS.items():
        label = label.when(F.col("event_type") == event_type, pollutant)
    site = F.concat(F.lit("Site / N°"), user.cast("string"), F.lit(" - Est "))
    return events.select(
        F.lit("FR").alias("Country Code"),
        F.concat(F.lit("Saint-Étienne  "), (user % CITIES).cast("string")).alias("City"),
        F.when(user % 25 == 0, "   ").otherwise(site).alias("Location"),
        F.lit("0,0").alias("Coordinates"),
        label.alias("Pollutant"),
        F.lit("events").alias("Source Name"),
        F.lit("µg/m³").alias("Unit"),
        F.col("value").alias("Value"),
        F.col("ts").cast("timestamp").alias("Last Updated"),
        F.lit("France").alias("Country Label"),
    )
