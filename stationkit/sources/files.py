"""Reading delimited station files and writing result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationkit.plans.stored import store
from stationkit.schema import RAW_SCHEMA, RAW_TO_READING

CORRUPT = "_corrupt_record"


def _in_file_order(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, needed: Sequence[str] | None
) -> T.StructType:
    """The file's columns in their order: known ones typed, further ones as text.

    Fails if the header lacks a needed column.
    """
    header = spark.read.options(header=True, sep=sep).csv(path).columns
    fields = {f.name: f for f in schema.fields}
    if needed is None:
        needed = [c for c in schema.names if schema != RAW_SCHEMA or c in RAW_TO_READING]
    lacking = [c for c in needed if c not in header]
    if lacking:
        raise ValueError(f"header {header} does not name the columns {lacking}")
    return T.StructType([fields.get(c, T.StructField(c, T.StringType())) for c in header])


def _asked_for(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The columns of the schema; those the file does not have are null."""
    return [
        F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]


# A line break or backslash in a text, and how it is written on one line.
_ESCAPES = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")]


def escape_lines(df: DataFrame) -> DataFrame:
    """Texts without line breaks: backslashes and line ends become ``\\\\``, ``\\n`` and ``\\r``."""

    def escaped(name: str) -> Column:
        column = F.col(f"`{name}`")
        for plain, written in _ESCAPES:
            column = F.replace(column, F.lit(plain), F.lit(written))
        return column.alias(name)

    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*(escaped(c) if c in texts else F.col(f"`{c}`") for c in df.columns))


def unescape_lines(df: DataFrame) -> DataFrame:
    """Undo ``escape_lines``. Escaped backslashes are set aside as a character no text holds."""

    def plain(name: str) -> Column:
        parts = F.split(F.col(f"`{name}`"), r"\\\\")
        undone = F.transform(
            parts,
            lambda part: F.replace(
                F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")
            ),
        )
        return F.array_join(undone, "\\").alias(name)

    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*(plain(c) if c in texts else F.col(f"`{c}`") for c in df.columns))


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = RAW_SCHEMA,
    sep: str = ";",
    needed: Sequence[str] | None = None,
    escaped: bool = False,
) -> DataFrame:
    """Scan delimited files with a header line, which names the columns in any order.

    The types are given, so no job reads the files just to guess them; pass
    ``None`` to infer them. Further columns of the files are ignored. Columns of
    the schema that the files lack are null, but for those ``needed`` (all; of
    the raw layout those a reading is made of), without which the read fails. All
    files must have the same header. ``escaped`` restores line breaks that
    ``write_csv`` has escaped.
    """
    reader = spark.read.options(header=True, sep=sep, mode="PERMISSIVE")
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    ordered = _in_file_order(spark, path, schema, sep, needed)
    rows = reader.schema(ordered).option("enforceSchema", False).csv(path)
    rows = rows.select(*_asked_for(rows, schema))
    return unescape_lines(rows) if escaped else rows


def read_csv_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType = RAW_SCHEMA,
    sep: str = ";",
    needed: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Scan delimited files into good rows and a quarantine of unreadable lines.

    A line is unreadable if a field does not parse as its type or the number of
    fields is wrong. The quarantine holds the line as it was. The text is parsed
    once, in full, into a stored table from which both results are read. The header
    names the columns as for ``read_csv``.
    """
    ordered = _in_file_order(spark, path, schema, sep, needed)
    tolerant = T.StructType([*ordered.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(tolerant).options(
        header=True,
        sep=sep,
        mode="PERMISSIVE",
        enforceSchema=False,
        columnNameOfCorruptRecord=CORRUPT,
    )
    # All columns are asked for, or a line would not be parsed in full.
    lines = store(reader.csv(path), "parsed").df
    parsed = lines.select(*_asked_for(lines, schema), CORRUPT)
    unreadable = F.col(CORRUPT).isNotNull()
    good = parsed.where(~unreadable).drop(CORRUPT)
    bad = parsed.where(unreadable).select(F.col(CORRUPT).alias("line"))
    return good, bad


def write_csv(df: DataFrame, path: str, sep: str = ";", escaped: bool = False) -> None:
    """Write delimited files with a header line each, times unchanged; an empty text reads as null.

    A file is read line by line, in parts, so a text must not hold a line break.
    ``escaped`` writes those, and backslashes, in a form that ``read_csv`` undoes
    when told so; otherwise such a text fails the job instead of becoming other rows.
    """
    if escaped:
        df = escape_lines(df)
    else:
        for field in df.schema.fields:
            if isinstance(field.dataType, T.StringType):
                text = F.col(f"`{field.name}`")
                broken = F.raise_error(F.lit(f"{field.name} holds a line break; write it escaped"))
                whole = F.when(text.rlike("[\\r\\n]"), broken.cast("string")).otherwise(text)
                df = df.withColumn(field.name, whole)
    df.write.mode("overwrite").options(
        header=True,
        sep=sep,
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    ).csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ("pollutant",)) -> None:
    """Write Parquet, partitioned so that readers of one pollutant skip the rest.

    Rows are not regrouped first: each task writes its own part of every
    pollutant, so a dominant pollutant does not pile up in one writer.
    """
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a Parquet result table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
