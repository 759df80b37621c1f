"""Joining a key table to many rows, safely at any size or skew."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationkit.plans.stored import StoredTable, store

# A stored table below this size is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# A key holding more than 1/SLICES of all rows is split. At most SLICES keys
# can be that large, so the list of them is small whatever the data.
SLICES = 256

_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.UserDefinedType)


def row_hash(df: DataFrame) -> Column:
    """Hash that spreads rows, exact copies included, over slices.

    Copies sit in many partitions, so the partition number is mixed in. Both
    parts are fixed for a given input partition, which keeps a retried task
    consistent with its first run (a random number would not be).
    """
    flat = [
        F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, _NESTED)
    ]
    return F.xxhash64(F.spark_partition_id(), *flat)


def _heavy_keys(
    rows: DataFrame, table: DataFrame, on: Sequence[str], weight: str | None
) -> DataFrame:
    """Keys with more than 1/SLICES of the rows, and how many slices each gets."""
    if weight is None:
        counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_weight"))
        total = rows.agg(F.count(F.lit(1)).alias("total")).scalar()
    else:
        counts = table.select(*on, F.col(weight).alias("_weight"))
        total = table.agg(F.sum(weight).alias("total")).scalar()
    slices = F.ceil(F.try_divide(F.col("_weight") * SLICES, total))
    heavy = counts.select(*on, slices.alias("_slices")).where(F.col("_slices") > 1)
    return store(heavy, "heavy-keys").df


def _sliced_join(
    rows: DataFrame, table: DataFrame, on: Sequence[str], how: str, weight: str | None
) -> DataFrame:
    """Shuffle join in which every heavy key is cut into slices.

    The table row of a heavy key is repeated once per slice and each reading
    picks one slice. Rows with a null key match nothing and are just spread.
    """
    heavy = F.broadcast(_heavy_keys(rows, table, on, weight))
    no_key = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in on))
    picked = (
        rows.withColumn("_hash", row_hash(rows))
        .join(heavy, list(on), "left")
        .withColumn(
            "_slice",
            F.when(no_key, F.pmod("_hash", F.lit(SLICES)))
            .when(F.col("_slices").isNotNull(), F.pmod("_hash", F.col("_slices")))
            .otherwise(F.lit(0)),
        )
        .drop("_hash", "_slices")
    )
    last_slice = F.coalesce(F.col("_slices"), F.lit(1)) - 1
    repeated = (
        table.join(heavy, list(on), "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), last_slice)))
        .drop("_slices")
    )
    return picked.join(repeated, [*on, "_slice"], how).drop("_slice")


def attach(
    rows: DataFrame,
    table: DataFrame | StoredTable,
    on: Sequence[str],
    how: str = "left",
    weight: str | None = None,
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """Join a key table to ``rows``; any key may hold any share of the rows.

    The table is stored first, which reveals its size. A small one is broadcast
    and the rows never move; a larger one goes through a shuffle join with heavy
    keys split. ``weight`` names a column of the table with the number of rows
    per key, which spares counting them.
    """
    stored = table if isinstance(table, StoredTable) else store(table, "keys")
    limit = BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes
    if stored.bytes <= limit:
        return rows.join(F.broadcast(stored.df), list(on), how)
    return _sliced_join(rows, stored.df, on, how, weight)
