"""What changed between two versions of a table, as multisets of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.plans.stored import store

# Parts that the rows are dealt into by hash; a digest of each tells whether it changed.
PARTS = 4096


def _dealt(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with two hashes of all columns; nulls count by their place, which xxhash64 skips over."""
    named = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(*(F.when(c.isNull(), "1").otherwise("0") for c in named))
    return df.select(
        *named,
        F.xxhash64(F.lit(1), nulls, *named).alias("_hash"),
        F.xxhash64(F.lit(2), *named, nulls).alias("_other"),
    ).withColumn("_part", F.pmod("_hash", F.lit(PARTS)))


def _digests(dealt: DataFrame) -> DataFrame:
    wide = "decimal(38,0)"
    return dealt.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.col("_hash").cast(wide)).alias("_sum"),
        F.sum(F.col("_other").cast(wide)).alias("_other_sum"),
    )


def changed_parts(before: DataFrame, after: DataFrame) -> DataFrame:
    """``_part`` of the parts whose digests differ: at most ``PARTS`` rows, from one row a part and task.

    A digest is the number of rows and the sums of two 64-bit hashes of each;
    parts with different rows agree by chance once in 2^128.
    """
    columns = before.columns
    old = _digests(_dealt(before, columns)).withColumnsRenamed(
        {"_rows": "_rows0", "_sum": "_sum0", "_other_sum": "_other0"}
    )
    both = old.join(_digests(_dealt(after, columns)), "_part", "full")
    same = (
        F.col("_rows").eqNullSafe(F.col("_rows0"))
        & F.col("_sum").eqNullSafe(F.col("_sum0"))
        & F.col("_other_sum").eqNullSafe(F.col("_other0"))
    )
    return both.where(~same).select("_part")


def snapshot_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows that are not equally often in both versions.

    Returns the columns with ``copies_before, copies_after`` and ``change``:
    ``added`` (not there before), ``removed`` (gone), ``more`` or ``fewer``
    copies. Both versions must have the same columns, in any order; nulls equal
    each other.

    Digests are taken first, over hash parts of the rows. Only rows of parts that
    differ are shuffled, one for each distinct row and task, so a small change in
    a large table costs two scans and little else, and a row that makes up a
    third of the table is no burden.
    """
    if set(before.columns) != set(after.columns):
        odd = sorted(set(before.columns) ^ set(after.columns))
        raise ValueError(f"only one version has {', '.join(odd)}")
    columns = before.columns
    parts = store(changed_parts(before, after), "changed-parts").df

    def side(df: DataFrame, number: int) -> DataFrame:
        # At most PARTS numbers are broadcast.
        kept = _dealt(df, columns).join(F.broadcast(parts), "_part", "left_semi")
        return kept.select(*(F.col(f"`{c}`") for c in columns), F.lit(number).alias("_after"))

    counted = (
        side(before, 0)
        .unionByName(side(after.select(*(F.col(f"`{c}`") for c in columns)), 1))
        .groupBy(*(F.col(f"`{c}`") for c in columns))
        .agg(
            F.count_if(F.col("_after") == 0).alias("copies_before"),
            F.count_if(F.col("_after") == 1).alias("copies_after"),
        )
    )
    old, new = F.col("copies_before"), F.col("copies_after")
    change = (
        F.when(old == 0, "added").when(new == 0, "removed").when(new > old, "more").otherwise("fewer")
    )
    return counted.where(old != new).withColumn("change", change)
