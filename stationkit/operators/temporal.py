"""Joins and groups along time: as-of, overlapping intervals, episodes.

None of them gives a key a task of its own. Rows are put in one global order of
key and time and cut into ranges; what a range needs of the ranges before it is
one row. A station that sends a third of all readings is cut like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationkit.plans.keyed import attach
from stationkit.plans.ordered import last_so_far, range_blocks, running_total
from stationkit.schema import SERIES

MICROS = 1_000_000
# Shortest cell that intervals are put in.
CELL_SECONDS = 60


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(f"`{time}`").cast("timestamp"))


def _all_known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(f"`{c}`").isNotNull() for c in columns))


def _no_clash(left: DataFrame, right: DataFrame, on: Sequence[str]) -> list[str]:
    own = [c for c in right.columns if c not in on]
    twice = sorted(set(own) & set(left.columns))
    if twice:
        raise ValueError(f"both sides have {', '.join(twice)}; rename one of them")
    return own


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    tolerance: float | None = None,
    how: str = "left",
) -> DataFrame:
    """Every left row with the last right row of its key that is not later.

    Both sides go into one order of key and time, right rows first where times
    are equal, and every left row takes the last right row before it; a range
    whose key began in an earlier range gets that one row carried over. Returns
    the left columns and the right ones without the keys; names must not clash.

    ``tolerance`` is the greatest age in seconds. Without a match the right
    columns are null, or the row is left out with ``how="inner"``. Of right rows
    with equal key and time the one with the largest columns, compared in their
    order, is taken. Rows with a null key or time match nothing; left ones among
    them are passed by without being shuffled.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    own = _no_clash(left, right, on)
    keys = [f"_k{i}" for i in range(len(on))]
    named = [F.col(f"`{c}`").alias(k) for c, k in zip(on, keys, strict=True)]
    left_row = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    right_row = F.struct(*(F.col(f"`{c}`") for c in own))
    left_known, right_known = _all_known([*on, left_time]), _all_known([*on, right_time])

    later = left.where(left_known).select(
        *named, _micros(left_time).alias("_at"), F.lit(1).alias("_side"), left_row.alias("_left")
    )
    earlier = right.where(right_known).select(
        *named, _micros(right_time).alias("_at"), F.lit(0).alias("_side"), right_row.alias("_right")
    )
    both = earlier.unionByName(later, allowMissingColumns=True).withColumn(
        "_tie", F.xxhash64("_left")
    )
    order = [*keys, "_at", "_side", "_right", "_tie"]
    blocks = range_blocks(both, order, "asof")
    seen = F.when(F.col("_side") == 0, F.struct(*keys, "_at", "_right"))
    found = last_so_far(blocks, order, seen, "_last", "_block").where("_side = 1")
    same = [F.col(k) == F.col(f"_last.{k}") for k in keys]
    if tolerance is not None:
        same.append(F.col("_at") - F.col("_last._at") <= round(tolerance * MICROS))
    match = F.when(reduce(lambda a, b: a & b, same), F.col("_last._right")).alias("_match")
    joined = found.select("_left", match)
    if how == "inner":
        joined = joined.where(F.col("_match").isNotNull())
    else:
        lost = left.where(~F.coalesce(left_known, F.lit(False)))
        joined = joined.unionByName(lost.select(left_row.alias("_left")), allowMissingColumns=True)
    return joined.select(
        *(F.col(f"_left.`{c}`").alias(c) for c in left.columns),
        *(F.col(f"_match.`{c}`").alias(c) for c in own),
    )


def _levels(df: DataFrame) -> list[int]:
    """The levels that occur: at most one for each doubling of a length, so a few dozen."""
    return sorted(r[0] for r in df.select("_level").distinct().collect())


def _width(level: Column, cell: int) -> Column:
    return (F.pow(F.lit(2.0), level) * cell).cast("bigint")


def _in_cells(df: DataFrame, levels: list[int], cell: int) -> DataFrame:
    """Rows once for each cell they touch, on their own level and on the given higher ones."""
    wanted = F.array_union(
        F.array("_level"),
        F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda v: v > F.col("_level")),
    )
    leveled = df.withColumn("_at_level", F.explode(wanted)).withColumn(
        "_width", _width(F.col("_at_level"), cell)
    )
    first = F.floor(F.col("_begin") / F.col("_width"))
    last = F.floor((F.col("_end") - 1) / F.col("_width"))
    return leveled.withColumn("_cell", F.explode(F.sequence(first, last)))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_span: tuple[str, str] = ("start", "end"),
    right_span: tuple[str, str] = ("start", "end"),
    cell_seconds: float = CELL_SECONDS,
) -> DataFrame:
    """Pairs of rows with equal keys whose intervals [begin, end) overlap.

    Time is cut into cells on several levels, each twice as wide as the one
    below. An interval lives on the level whose cells are just as long as it, so
    it touches two of them at most, and looks in on the higher levels on which
    the other side has intervals. A pair meets on the level of its longer
    interval, where only cells of its own length are searched, and counts in the
    cell in which it begins to overlap. So neither a very long interval nor very
    many short ones are repeated more than a few dozen times.

    Returns the columns of both sides, keys once; other names must not clash.
    Intervals with a null key or end, and those that end when or before they
    begin, overlap nothing. Cells that hold much of the left side are cut in
    slices by ``keyed.attach``.
    """
    own = _no_clash(left, right, on)
    cell = round(cell_seconds * MICROS)

    def spanned(df: DataFrame, span: tuple[str, str], columns: list[str], row: str) -> DataFrame:
        begin, end = (_micros(c) for c in span)
        length = F.log2((F.col("_end") - F.col("_begin")) / cell)
        level = F.greatest(F.ceil(length), F.lit(0)).cast("int")
        return (
            df.where(_all_known([*on, *span]))
            .select(
                *(F.col(f"`{c}`") for c in on), begin.alias("_begin"), end.alias("_end"),
                F.struct(*(F.col(f"`{c}`") for c in columns)).alias(row),
            )
            .where("_begin < _end")
            .withColumn("_level", level)
        )

    lefts = spanned(left, left_span, [c for c in left.columns if c not in on], "_left")
    rights = spanned(right, right_span, own, "_right")
    left_cells = _in_cells(lefts, _levels(rights), cell)
    right_cells = _in_cells(rights, _levels(lefts), cell).withColumnsRenamed(
        {"_begin": "_begin2", "_end": "_end2", "_level": "_level2"}
    ).drop("_width")
    key = [*on, "_at_level", "_cell"]
    at_home = F.col("_level") == F.col("_at_level")
    right_home = right_cells.where(F.col("_level2") == F.col("_at_level"))
    met = [
        attach(left_cells.where(at_home), right_cells, key, "inner"),
        attach(left_cells.where(~at_home), right_home, key, "inner"),
    ]
    begins = F.greatest("_begin", "_begin2")
    pairs = met[0].unionByName(met[1]).where(
        (begins < F.least("_end", "_end2")) & (F.floor(begins / F.col("_width")) == F.col("_cell"))
    )
    return pairs.select(
        *(F.col(f"`{c}`") if c in on else F.col(f"_left.`{c}`").alias(c) for c in left.columns),
        *(F.col(f"_right.`{c}`").alias(c) for c in own),
    )


def episodes(
    readings: DataFrame, gap_seconds: float, keys: Sequence[str] = SERIES
) -> DataFrame:
    """Runs of readings of a key without a pause longer than ``gap_seconds``.

    Returns the keys with ``episode_start, episode_end`` (first and last
    reading), ``num_readings, peak_value`` and ``mean_value``. A pause of exactly
    the gap does not end a run. A null key is a key; readings without a time
    are left out, values that are null count as readings only.

    Each reading needs just the one before it in the order of key and time to
    know whether a run begins with it, and runs are numbered by a running sum;
    both reach over the ranges by one row each. Runs are then grouped by number,
    with partial sums in every task.
    """
    keys = list(keys)
    timed = readings.select(*keys, _micros("last_updated").alias("_at"), "value").where(
        F.col("_at").isNotNull()
    )
    order = [*keys, "_at", "value"]
    blocks = range_blocks(timed, order, "episodes")
    here = F.struct(*keys, "_at")
    follows = last_so_far(blocks, order, here, "_previous", "_block", itself=False)
    joined = [F.col(k).eqNullSafe(F.col(f"_previous.{k}")) for k in keys]
    joined.append(F.col("_at") - F.col("_previous._at") <= round(gap_seconds * MICROS))
    begins = F.when(reduce(lambda a, b: a & b, joined), 0).otherwise(1)
    # Of equal readings the one that begins a run comes first.
    numbered = running_total(
        follows.withColumn("_begins", begins), [*order, F.desc("_begins")], F.col("_begins"),
        "_run", "_block",
    )
    return numbered.groupBy(*keys, "_run").agg(
        F.timestamp_micros(F.min("_at")).alias("episode_start"),
        F.timestamp_micros(F.max("_at")).alias("episode_end"),
        F.count(F.lit(1)).alias("num_readings"),
        F.max("value").alias("peak_value"),
        F.avg("value").alias("mean_value"),
    ).drop("_run")
