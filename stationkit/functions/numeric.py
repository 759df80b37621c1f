"""Scaling and rounding expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def min_max(value: Column, low: Column, high: Column) -> Column:
    """Position of a value between low and high; null when the range is empty."""
    return F.try_divide(value - low, high - low)


def z_score(value: Column, mean: Column, std: Column) -> Column:
    """Standard score; 0 when the spread is zero or cannot be estimated."""
    return F.when(std > 0, (value - mean) / std).otherwise(0.0)


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over the rows that have both; null if either is constant.

    The built-in one raises a division by zero for a constant column.
    """
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def settle(value: Column, digits: int = 4) -> Column:
    """Round with a small nudge so that summation order cannot flip an exact tie."""
    return F.round(value + F.lit(1e-7), digits)


def split_bucket(keys: Sequence[Column | str], buckets: int = 100) -> Column:
    """Bucket number 0..buckets-1 from an md5 of the row key.

    It depends on the key alone, so it is the same after any repartition, on
    any retry, and in any other engine that has md5.
    """
    digest = F.md5(F.concat_ws("|", *keys))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets
