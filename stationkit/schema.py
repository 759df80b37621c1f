"""Table layouts, key lists and the fixed values of the readings model."""

from __future__ import annotations

from pyspark.sql import types as T

# A station is the pair (city, location); a series is one pollutant at a station.
STATION = ["city", "location"]
SERIES = ["city", "location", "pollutant"]
READING = [*SERIES, "value", "last_updated"]

RAW_SCHEMA = T.StructType(
    [
        T.StructField("Country Code", T.StringType()),
        T.StructField("City", T.StringType()),
        T.StructField("Location", T.StringType()),
        T.StructField("Coordinates", T.StringType()),
        T.StructField("Pollutant", T.StringType()),
        T.StructField("Source Name", T.StringType()),
        T.StructField("Unit", T.StringType()),
        T.StructField("Value", T.DoubleType()),
        T.StructField("Last Updated", T.TimestampType()),
        T.StructField("Country Label", T.StringType()),
    ]
)

READINGS_SCHEMA = T.StructType(
    [
        T.StructField("city", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("pollutant", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("last_updated", T.TimestampType()),
    ]
)

# Raw column -> reading column; raw columns not named here are dropped.
RAW_TO_READING = {
    "City": "city",
    "Location": "location",
    "Pollutant": "pollutant",
    "Value": "value",
    "Last Updated": "last_updated",
}

# Highest plausible reading per raw pollutant label. A label that
# is not listed is not a known pollutant and its rows are dropped.
POLLUTANT_CAPS = {
    "PM10": 500.0,
    "PM2.5": 300.0,
    "PM1": 100.0,
    "BC": 50.0,
    "NO": 200.0,
    "NO2": 400.0,
    "NOX": 500.0,
    "O3": 300.0,
    "CO": 50.0,
    "SO2": 100.0,
}

ROLLING_SECONDS = 3 * 3600
HIGH_VALUE = 100.0
SIMILAR_INDEX = 0.2
