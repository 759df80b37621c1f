"""Dense numbering and running sums over one global order, without a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationkit.plans.stored import store


def running_total(
    df: DataFrame,
    order: Sequence[str | Column],
    amount: Column,
    name: str,
    block: str,
    single: bool = False,
) -> DataFrame:
    """Running sum of ``amount`` in ``order``, the row itself included.

    ``block`` is a column whose values cut the order into consecutive runs. Each
    run is summed on its own; the totals of the runs before it, one row per
    block, are added from a broadcast. Callers keep the number of blocks small.
    ``single`` says that there is only one block, with nothing before it.
    """
    within = Window.partitionBy(block).orderBy(*order)
    rows_so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if single:
        return df.withColumn(name, F.sum(amount).over(rows_so_far))
    totals = df.groupBy(block).agg(F.sum(amount).alias("_total"))
    # One task, over one row per block.
    before = Window.partitionBy(F.lit(0)).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        block, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before")
    )
    return (
        df.withColumn("_within", F.sum(amount).over(rows_so_far))
        .join(F.broadcast(offsets), block)
        .withColumn(name, F.col("_within") + F.col("_before"))
        .drop("_within", "_before")
    )


def last_so_far(
    df: DataFrame, order: Sequence[str], value: Column, name: str, block: str, itself: bool = True
) -> DataFrame:
    """The last value in ``order`` that is not null, up to each row, the row itself included or not.

    ``block`` cuts the order into consecutive runs, as ``range_blocks`` makes
    them. Each run is looked through on its own; the last value of the runs
    before it, one row per block, comes from a broadcast. No key has a task of
    its own, so it does not matter how many rows share one.
    """
    valued = df.withColumn("_value", value)
    end = Window.currentRow if itself else -1
    within = Window.partitionBy(block).orderBy(*order)
    placed = F.when(F.col("_value").isNotNull(), F.struct(*order, "_value"))
    lasts = valued.groupBy(block).agg(F.max(placed).alias("_last"))
    # One task, over one row per block.
    before = Window.partitionBy(F.lit(0)).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select(
        block, F.last(F.col("_last._value"), ignorenulls=True).over(before).alias("_carried")
    )
    here = F.last("_value", ignorenulls=True).over(
        within.rowsBetween(Window.unboundedPreceding, end)
    )
    return (
        valued.withColumn("_here", here)
        .join(F.broadcast(carried), block)
        .withColumn(name, F.coalesce("_here", "_carried"))
        .drop("_value", "_here", "_carried")
    )


def range_blocks(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Store ``df`` cut into consecutive value ranges, numbered by ``_block``.

    Range bounds come from a sample, so a second evaluation could cut elsewhere;
    the stored table pins them. There are as many blocks as shuffle partitions.
    """
    ranged = df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id())
    return store(ranged, label).df


def dense_ids(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Number rows 0, 1, 2, ... in the order of a unique key."""
    blocks = range_blocks(df, order, "ordered")
    one = F.lit(1).cast("bigint")
    numbered = running_total(blocks, list(order), one, name, "_block")
    return numbered.withColumn(name, F.col(name) - 1).drop("_block")
