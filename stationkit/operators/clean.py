"""Cleaning: projection, missing values, duplicates, range limits, text form."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationkit.functions import text
from stationkit.plans.keyed import attach
from stationkit.schema import POLLUTANT_CAPS, RAW_TO_READING, READINGS_SCHEMA


def string_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold text."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*names)


def to_readings(raw: DataFrame, mapping: Mapping[str, str] = RAW_TO_READING) -> DataFrame:
    """Pick, rename and type the five reading columns in one projection."""
    types = {f.name: f.dataType for f in READINGS_SCHEMA.fields}
    return raw.select(
        *(F.col(f"`{old}`").cast(types[new]).alias(new) for old, new in mapping.items())
    )


def blank_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn empty and space-only text into null, for all text columns by default."""
    chosen = string_columns(df) if columns is None else list(columns)
    return df.withColumns({c: text.null_if_blank(F.col(f"`{c}`")) for c in chosen})


def drop_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns."""
    return df.na.drop(subset=None if columns is None else list(columns))


def dedupe(df: DataFrame) -> DataFrame:
    """Distinct rows. Copies collapse inside each map task before the shuffle."""
    return df.dropDuplicates()


def split_categories(df: DataFrame, column: str = "pollutant", sep: str = ",") -> DataFrame:
    """One row per label of a multi-valued column; empty labels are dropped."""
    labels = F.split(F.trim(column), f" *{re.escape(sep)} *")
    return df.withColumn(column, F.explode(labels)).where(F.col(column) != "")


def _cap(label: Column, caps: Mapping[str, float]) -> Column:
    entries = chain.from_iterable(caps.items())
    return F.try_element_at(F.create_map(*(F.lit(e) for e in entries)), label)


def range_filter(
    df: DataFrame,
    caps: Mapping[str, float] = POLLUTANT_CAPS,
    category: str = "pollutant",
    value: str = "value",
) -> DataFrame:
    """Keep values from 0 to the cap of their category; other categories are dropped.

    The label list and the outer bounds are plain comparisons, which reach the
    file scan; the cap lookup runs on what is left.
    """
    label, amount = F.col(category), F.col(value)
    return df.where(
        label.isin(*caps)
        & amount.between(0.0, max(caps.values()))
        & (amount <= _cap(label, caps))
    )


def normalize_text(df: DataFrame) -> DataFrame:
    """Slug city and location, code the pollutant label."""
    return df.withColumns(
        {
            "city": text.slug(F.col("city")),
            "location": text.slug(F.col("location")),
            "pollutant": text.code(F.col("pollutant")),
        }
    )


def min_group_rows(
    df: DataFrame,
    key: str = "city",
    min_rows: int = 3,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Keep only groups with at least ``min_rows`` rows."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    large = counts.where(F.col("_rows") >= min_rows)
    return attach(
        df, large, [key], "left_semi", weight="_rows", broadcast_bytes=broadcast_bytes
    )


def _complete(rows: DataFrame, named: Callable[[Column], Column]) -> DataFrame:
    """Rows with a usable name at both station levels, a label, a value and a time.

    Testing the names as they came, before they are rewritten, gives the same
    rows as rewriting, blanking and dropping; but a filter on rewritten text
    would be pushed below the rewrite and repeat its expressions.
    """
    usable = named(F.col("city")) & named(F.col("location")) & ~text.is_blank(F.col("pollutant"))
    return drop_missing(rows.where(usable), ["value", "last_updated"])


def ingest_rows(raw: DataFrame, caps: Mapping[str, float] = POLLUTANT_CAPS) -> DataFrame:
    """Row-wise part of ingestion: project, drop incomplete, split, range check, strip.

    Labels are split before the range check, so each part is checked on its own.
    """
    rows = _complete(to_readings(raw), text.has_ascii)
    checked = range_filter(split_categories(rows), caps)
    return checked.withColumns({c: text.ascii_only(F.col(c)) for c in ("city", "location")})


def normal_rows(readings: DataFrame) -> DataFrame:
    """Row-wise part of normalisation: drop incomplete rows, rewrite the text.

    There is no shuffle here, so the same function serves batch and streams.
    """
    return normalize_text(_complete(readings, text.has_words))


def ingest_clean(raw: DataFrame, caps: Mapping[str, float] = POLLUTANT_CAPS) -> DataFrame:
    """Raw table to distinct, complete, in-range readings (labels as they came).

    Filters run before the duplicate removal, which leaves the result unchanged
    and shrinks the only shuffle.
    """
    return dedupe(ingest_rows(raw, caps))


def clean_rows(raw: DataFrame, caps: Mapping[str, float] = POLLUTANT_CAPS) -> DataFrame:
    """Row-wise part of the whole cleaning, for batches and streams alike."""
    rows = _complete(to_readings(raw), text.has_words)
    return normalize_text(range_filter(split_categories(rows), caps))


def clean_readings(raw: DataFrame, caps: Mapping[str, float] = POLLUTANT_CAPS) -> DataFrame:
    """Raw table to normalised distinct readings.

    Rows that are equal before normalising are equal after it, so one duplicate
    removal at the end does the work of one per stage; the slug strips to ASCII
    itself, so every name is rewritten once.
    """
    return dedupe(clean_rows(raw, caps))
