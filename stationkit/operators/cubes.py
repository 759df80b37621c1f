"""Grouping sets, percentiles and distinct counts from a rollup, and exact percentiles beside them.

A rollup is written once at a fine grain and answers coarser questions later.
Sums and extremes add up; percentiles and distinct counts do not, so a cell also
keeps two sketches, which merge over any grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.plans.keyed import attach
from stationkit.plans.ordered import range_blocks, running_total
from stationkit.plans.stored import store
from stationkit.schema import STATION

# Size of the quantile sketch, and the rank error stated for it: the share of values by which
# a quantile may lie too high or too low. The sketch keeps to a third of it in 99 of 100 cases.
QUANTILE_K = 400
RANK_ERROR = 0.02
# Registers of the distinct sketch as a power of two; relative error stated for it.
DISTINCT_LOG = 12
DISTINCT_ERROR = 0.06


def _measures() -> list:
    """Report measures over the sums of ``flow.rollup``."""
    return [
        F.try_divide(F.sum("_sum"), F.sum("_values")).alias("avg_value"),
        F.max("_max").alias("max_value"),
        F.min("_min").alias("min_value"),
        F.sum("_rows").alias("num_measurements"),
    ]


def sets_report(
    cells: DataFrame, by: Sequence[str], sets: Sequence[Sequence[str]] | None = None
) -> DataFrame:
    """Averages, extremes and counts for several groupings at once; all of them (a cube) by default.

    Columns ``by`` are null where a row sums over them; ``grouping`` tells this
    from a null in the data: its bits, the first column highest, are 1 for the
    columns summed over. The cells are first added up to the finest grouping, and
    only those sums are expanded, so the readings themselves are never repeated.
    """
    by = list(by)
    finest = cells.groupBy(*by).agg(
        F.sum("_sum").alias("_sum"),
        F.sum("_values").alias("_values"),
        F.max("_max").alias("_max"),
        F.min("_min").alias("_min"),
        F.sum("_rows").alias("_rows"),
    )
    if sets is None:
        grouped = finest.cube(*by)
    else:
        grouped = finest.groupingSets([[F.col(c) for c in own] for own in sets], *by)
    return grouped.agg(F.grouping_id().alias("grouping"), *_measures())


def rollup_sets(by: Sequence[str]) -> list[list[str]]:
    """The groupings of a rollup: all columns, then one fewer from the end, down to none."""
    return [list(by[:n]) for n in range(len(by), -1, -1)]


def sketch_rollup(readings: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored cells with a quantile sketch of the values and distinct sketches of stations and days.

    Null and NaN values are not in the sketch. Sketches are combined in every
    task before the shuffle, so a cell with a third of the readings is no heavier
    than another.
    """
    value = F.when(~F.isnan("value"), F.col("value"))
    cells = readings.groupBy(*by).agg(
        F.kll_sketch_agg_double(value, QUANTILE_K).alias("_quantiles"),
        F.hll_sketch_agg(F.to_json(F.struct(*STATION)), DISTINCT_LOG).alias("_stations"),
        F.hll_sketch_agg(F.unix_date(F.to_date("last_updated")), DISTINCT_LOG).alias("_days"),
        F.count(value).alias("_values"),
    )
    return store(cells, "sketches").df


def quantiles_from_rollup(
    cells: DataFrame, by: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """Percentiles of any coarser grouping from the sketches of its cells.

    One row per group and probability: ``probability, quantile, num_values``, and
    about how many ``stations`` and ``days`` the group has. The rank of a
    quantile is right to ``RANK_ERROR``. Groups without values have none.
    """
    merged = cells.where("_values > 0").groupBy(*by).agg(
        F.kll_merge_agg_double("_quantiles").alias("_sketch"),
        F.hll_sketch_estimate(F.hll_union_agg("_stations")).alias("stations"),
        F.hll_sketch_estimate(F.hll_union_agg("_days")).alias("days"),
        F.sum("_values").alias("num_values"),
    )
    wanted = F.array(*(F.lit(float(p)) for p in probabilities))
    quantiles = F.kll_sketch_get_quantile_double("_sketch", wanted)
    each = F.inline(F.arrays_zip(wanted.alias("probability"), quantiles.alias("quantile")))
    return merged.select(*by, each.alias("probability", "quantile"), "num_values", "stations", "days")


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float]
) -> DataFrame:
    """Exact percentiles, interpolated between neighbours, of groups of any size.

    Rows are put in one order of group and value and numbered; a percentile is
    then the row (or two) with a certain number. No group is gathered anywhere.
    One row per group and probability: ``probability, exact``. Null and NaN
    values are left out; a null group is a group.
    """
    by = list(by)
    number = F.col(f"`{value}`").cast("double")
    known = df.select(*by, number.alias("_value")).where(
        F.col("_value").isNotNull() & ~F.isnan("_value")
    )
    order = [*by, "_value"]
    blocks = range_blocks(known, order, "quantiles")
    one = F.lit(1).cast("bigint")
    numbered = store(running_total(blocks, order, one, "_number", "_block"), "numbered").df
    wanted = F.explode(F.array(*(F.lit(float(p)) for p in probabilities))).alias("probability")
    places = (
        numbered.groupBy(*by)
        .agg(F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .select(*(F.col(c).alias(f"_by_{c}") for c in by), "_first", "_n", wanted)
        .withColumn("_place", (F.col("_n") - 1) * F.col("probability"))
        .withColumn("_part", F.col("_place") - F.floor("_place"))
    )
    ends = F.explode(F.array_distinct(F.array(F.floor("_place"), F.ceil("_place")))).alias("_end")
    targets = places.select("*", ends).select(
        *(f"_by_{c}" for c in by), "probability", "_part",
        (F.col("_first") + F.col("_end")).alias("_number"),
    )
    found = attach(numbered.select("_number", "_value"), targets, ["_number"], "inner")
    low, high = F.min("_value"), F.max("_value")
    return (
        found.groupBy(*(F.col(f"_by_{c}").alias(c) for c in by), "probability")
        .agg((low + (high - low) * F.max("_part")).alias("exact"))
    )
