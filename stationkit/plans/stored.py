"""Tables written once to the cluster's shared folder and read back.

Writing cuts the lineage and survives the loss of executors, which a cached or
locally checkpointed DataFrame does not. Parquet also keeps column pruning and
gives the optimizer real sizes.
"""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="stationkit-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/stationkit-{label}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class StoredTable:
    """A stored DataFrame with the row count and size seen while it was written."""

    df: DataFrame
    rows: int
    bytes: int
    seen: dict[str, Any] = field(default_factory=dict)

    def view(self, df: DataFrame) -> StoredTable:
        """A projection or filter of the stored rows, for which the size still bounds."""
        return StoredTable(df, self.rows, self.bytes, self.seen)


def _beyond_word(column: Column, kind: T.DataType) -> Column | None:
    """In-memory bytes of a value besides its word in the row; None where there are none."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + 8
    if isinstance(kind, T.StructType):
        parts = [_beyond_word(column.getField(f.name), f.dataType) for f in kind.fields]
        return sum((p for p in parts if p is not None), F.lit(16 + 8 * len(kind.fields)).cast("bigint"))
    if isinstance(kind, T.ArrayType) and not isinstance(
        kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)
    ):
        return F.greatest(F.size(column), F.lit(0)).cast("bigint") * 8 + 24
    if isinstance(kind, (T.ArrayType, T.MapType)):
        # Numbers and texts take about as many bytes written out, each with a word or two besides.
        return F.coalesce(F.octet_length(column.cast("string")), F.lit(0)).cast("bigint") * 4 + 24
    return None


def _row_bytes(df: DataFrame) -> Column:
    """In-memory size of a row: header, one word per column, texts and nested values."""
    width = 16 + 8 * len(df.columns)
    parts = [_beyond_word(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    return sum((p for p in parts if p is not None), F.lit(width).cast("bigint"))


def store(df: DataFrame, label: str, **measures: Column) -> StoredTable:
    """Write a DataFrame to the shared folder.

    Its size, and any further aggregate asked for by name, is observed in the
    same job.
    """
    spark = df.sparkSession
    seen = Observation()
    path = fresh_path(spark, label)
    counted = df.observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"),
        *(measure.alias(name) for name, measure in measures.items()),
    )
    counted.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    numbers = seen.get
    return StoredTable(stored, numbers["rows"], numbers["bytes"], numbers)
