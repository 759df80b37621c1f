"""Profiles of a table: counts, missing values, duplicates, summary numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationkit.functions.text import is_blank
from stationkit.operators.clean import string_columns


def _long(df: DataFrame, measures: dict[str, Column], name: str, value: str) -> DataFrame:
    """Aggregate all measures in one pass and return one row per measure."""
    if not measures:
        return df.sparkSession.createDataFrame([], f"`{name}` string, `{value}` bigint")
    wide = df.agg(*(c.alias(k) for k, c in measures.items()))
    return wide.unpivot([], [f"`{k}`" for k in measures], name, value)


def preview(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def schema_profile(df: DataFrame) -> DataFrame:
    """Name, type and position of every column."""
    fields = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(fields, "name string, type string, position int")


def missing_profile(df: DataFrame) -> DataFrame:
    """Null-or-blank count of every text column."""
    measures = {c: F.count_if(is_blank(F.col(f"`{c}`"))) for c in string_columns(df)}
    return _long(df, measures, "column", "missing")


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column."""
    measures = {c: F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}
    return _long(df, measures, "column", "nulls")


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies.

    Copies are counted inside each map task first, so a row that makes up a
    third of the table crosses the shuffle once per task.
    """
    groups = df.groupBy(*(f"`{c}`" for c in df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    rows = F.coalesce(F.sum("_n"), F.lit(0))
    return groups.agg(
        rows.alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (rows - F.count(F.lit(1))).alias("duplicates"),
    )


def cardinality(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    """Number of distinct non-null values of each column.

    The exact form first reduces the table to its distinct value combinations,
    so the per-column counts work on far fewer rows.
    """
    if approximate:
        counts = {c: F.approx_count_distinct(c) for c in columns}
        return _long(df, counts, "column", "distinct_values")
    combos = df.select(*columns).distinct()
    counts = {c: F.count_distinct(c) for c in columns}
    return _long(combos, counts, "column", "distinct_values")


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The different values of one column."""
    return df.select(column).distinct()


def summary_stats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, smallest and largest value of each column.

    Mean and deviation are null for text; smallest and largest are given as text
    so that one table can hold all columns. A table without numbers or text has no rows.
    """
    usable = [
        f for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType))
    ]
    chosen = [f for f in usable if columns is None or f.name in columns]
    if not chosen:
        return df.sparkSession.createDataFrame(
            [], "column string, count bigint, mean double, stddev double, min string, max string"
        )

    def described(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        numeric = isinstance(field.dataType, T.NumericType)
        nothing = F.lit(None).cast("double")
        return F.struct(
            F.lit(field.name).alias("column"),
            F.count(c).alias("count"),
            (F.avg(c) if numeric else nothing).alias("mean"),
            (F.stddev(c) if numeric else nothing).alias("stddev"),
            F.min(c).cast("string").alias("min"),
            F.max(c).cast("string").alias("max"),
        )

    return df.agg(F.array(*(described(f) for f in chosen)).alias("_s")).select(F.inline("_s"))


def quality_report(df: DataFrame) -> DataFrame:
    """Row count with null, blank and NaN counts of all columns, in one pass."""
    measures: dict[str, Column] = {"rows": F.count(F.lit(1))}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        measures[f"{f.name}:null"] = F.count_if(c.isNull())
        if isinstance(f.dataType, T.StringType):
            measures[f"{f.name}:blank"] = F.count_if(is_blank(c))
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            measures[f"{f.name}:nan"] = F.count_if(F.isnan(c))
    return _long(df, measures, "measure", "value")
