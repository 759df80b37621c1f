"""Mixing sources to target weights with a low-discrepancy schedule.

The words of a source are laid end to end in a shuffled order of its documents
and cut into blocks of equal size. Slot i of the mix takes the golden-ratio point
frac(i * 0.618…), which the cumulative targets map to a source; the slots of a
source, numbered in order, take its blocks in turn. Everything is built-in
DataFrame work. Running numbers are formed in about sqrt(n) groups and then over
the groups, so that a source with a third of all rows is no single task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationkit.plans.stored import store

# The weights of the sources in turn, the words of the mix in
# relation to those given, and how often a source may be repeated at most.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
# Words in a block.
BLOCK_WORDS = 32
GOLDEN = "0.6180339887498949D"
WORD = r"[^\x20\x09-\x0D]+"
_CELLS = 1024


def _running(rows: DataFrame, key: str, group: str, order: list, value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a key, formed by groups of neighbouring rows."""
    sums = rows.groupBy(key, group).agg(F.sum(value).alias("_sum"))
    past = Window.partitionBy(key).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(key, group, F.coalesce(F.sum("_sum").over(past), F.lit(0)).alias("_base"))
    own = Window.partitionBy(key, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = rows.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    joined = inner.join(sums, [key, group])
    return joined.withColumn(out, F.col("_base") + F.col("_own")).drop("_base", "_own")


@dataclass(frozen=True)
class Mix:
    """The parts of a mix: documents with sizes, sources with targets, slots, and pieces.

    ``pieces`` has one row for each document and block it reaches into, with the
    words of it in that block; ``slots`` one row for each slot, with the block it takes.
    """

    documents: DataFrame
    sources: DataFrame
    slots: DataFrame
    pieces: DataFrame


def source_targets(sizes: DataFrame) -> DataFrame:
    """Per source its number ``sid``, ``source_size``, weight, ``target`` and share interval.

    Sources are numbered by code point, a null one last. Where a target would
    exceed twice the source's size, it stops there, and what is left is shared
    by weight: target = min(2 * size, level * weight), with the level that makes
    the targets add up. One row per source.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    limit = F.col("source_size") * MOST_EPOCHS
    numbered = (
        sources.withColumn("sid", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", limit)
        .withColumn("ratio", F.col("limit") / F.col("weight"))
    )
    everything = Window.partitionBy()
    rising = Window.orderBy("ratio", "sid")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * F.lit(SHARE) - F.coalesce(
        F.sum("limit").over(before), F.lit(0)
    )
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = numbered.withColumn("own_level", left / weights)
    # With the k sources of lowest ratio at their limit the rest would get this level. It
    # rises while those sources are rightly at it and falls afterwards: the top is the level.
    levelled = levelled.withColumn("level", F.max("own_level").over(everything))
    target = F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight"))
    targets = levelled.withColumn("target", target)
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return targets.select(
        "sid", "source", "source_size", "target",
        (F.sum("target").over(upto) - F.col("target")).alias("low"),
        F.sum("target").over(upto).alias("high"),
        F.ceil(F.col("source_size") / BLOCK_WORDS).alias("blocks"),
    )


def mix(docs: DataFrame) -> Mix:
    """Lay out the mix of all documents. A null or empty text has size 0 and no pieces.

    A null source is a source of its own. Rows that repeat a doc_id are documents
    of their own. The order within a source is that of MD5(doc_id), so reruns
    agree. An empty table gives empty parts.
    """
    read = docs.select(
        F.col("doc_id").cast("bigint"), "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    )
    sized = store(
        read.select(
            "*", F.monotonically_increasing_id().alias("row"),
            F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("place"),
        ), "sizes",
    )
    sources = store(source_targets(sized.df), "sources").df
    total = sources.agg(F.sum("target").alias("t")).first()["t"] or 0.0
    n_slots = int(total // BLOCK_WORDS) + (1 if total % BLOCK_WORDS else 0)

    groups = max(1, int(sized.rows**0.5))
    first_bits = F.conv(F.substring("place", 1, 8), 16, 10).cast("bigint")
    keyed = sized.df.join(
        sources.select("source", "sid", "source_size", "target"),
        sized.df["source"].eqNullSafe(sources["source"]),
    ).drop(sources["source"])
    keyed = keyed.withColumn("group", F.floor(first_bits * groups / (1 << 32)))
    order = ["place", "doc_id", "size", "row"]
    laid = store(_running(keyed, "sid", "group", order, F.col("size"), "start"), "laid").df
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK_WORDS)
    pieces = (
        laid.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK_WORDS), last)))
        .withColumn("from_word", F.greatest(F.col("block") * BLOCK_WORDS - F.col("start"), F.lit(0)))
        .withColumn(
            "words",
            F.least((F.col("block") + 1) * BLOCK_WORDS - F.col("start"), "size") - F.col("from_word"),
        )
        .select("row", "doc_id", "sid", "block", "from_word", "words")
    )

    point = F.expr(f"id * {GOLDEN} - floor(id * {GOLDEN})") * F.lit(total)
    cell = F.floor(F.col("point") * _CELLS / F.lit(total or 1.0))
    points = docs.sparkSession.range(n_slots).withColumn("point", point).withColumn("cell", cell)
    spans = sources.where("target > 0").select(
        "sid", "low", "high", "blocks",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * _CELLS / F.lit(total or 1.0)),
                F.floor(F.col("high") * _CELLS / F.lit(total or 1.0)),
            )
        ).alias("cell"),
    )
    dealt = points.join(spans, "cell").where("point >= low AND point < high")
    step = max(1, int(n_slots**0.5))
    dealt = dealt.withColumn("group", F.floor(F.col("id") / step))
    ranked = _running(dealt, "sid", "group", ["id"], F.lit(1), "rank")
    slots = ranked.where(F.col("rank") < F.col("blocks") * MOST_EPOCHS).select(
        F.col("id").alias("slot"), "sid", (F.col("rank") % F.col("blocks")).alias("block"),
        F.floor(F.col("rank") / F.col("blocks")).alias("epoch"),
    )
    return Mix(laid, sources, slots, pieces)


def mixed_stream(docs: DataFrame) -> DataFrame:
    """The mix itself: which words of which document each slot takes, in slot order by ``slot``."""
    plan = mix(docs)
    return plan.slots.join(plan.pieces, ["sid", "block"]).select(
        "slot", "epoch", "sid", "doc_id", "from_word", "words"
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Every document with ``size, source_size, target`` (its source's) and ``taken``.

    ``taken`` counts the words that the mix takes from it, repeats included: at
    most twice its size. One row for each row of ``docs``.
    """
    plan = mix(docs)
    times = plan.slots.groupBy("sid", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = (
        plan.pieces.join(times, ["sid", "block"])
        .groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    )
    return plan.documents.join(taken, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).alias("taken"),
    )


_FRAC = "(i * 0.6180339887498949 - floor(i * 0.6180339887498949))"
SQL = rf"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS place
  FROM documents),
numbered AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM numbered),
ratios AS (
  SELECT *, (2 * source_size)::DOUBLE / weight AS ratio,
         sum(source_size) OVER () * 1.5::DOUBLE AS whole, sum(weight) OVER () AS weights
  FROM weighed),
levels AS (
  SELECT *, (whole - coalesce(sum(2 * source_size) OVER b, 0))::DOUBLE
            / (weights - coalesce(sum(weight) OVER b, 0)) AS own_level
  FROM ratios
  WINDOW b AS (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max(own_level) AS level FROM levels),
targets AS (
  SELECT sid, source, source_size, least((2 * source_size)::DOUBLE, level * weight) AS target,
         CAST(ceil(source_size / {BLOCK_WORDS}.0) AS BIGINT) AS blocks
  FROM levels, level),
spans AS (
  SELECT *, sum(target) OVER (ORDER BY sid ROWS UNBOUNDED PRECEDING) AS high,
         sum(target) OVER () AS total FROM targets),
slots AS (
  SELECT i, {_FRAC} * (SELECT sum(target) FROM targets) AS point
  FROM (SELECT unnest(range(CAST(ceil((SELECT sum(target) FROM targets) / {BLOCK_WORDS}.0) AS BIGINT))) AS i)),
ranked AS (
  SELECT sid, blocks, row_number() OVER (PARTITION BY sid ORDER BY i) - 1 AS k
  FROM slots JOIN spans ON point >= high - target AND point < high),
times AS (
  SELECT sid, k % blocks AS block, count(*) AS times
  FROM ranked WHERE k < 2 * blocks GROUP BY ALL),
laid AS (
  SELECT s.doc_id, s.size, t.sid, t.source_size, t.target, row_number() OVER () AS n,
         coalesce(sum(s.size) OVER (PARTITION BY t.sid ORDER BY s.place, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
pieces AS (
  SELECT n, sid, start, size,
         unnest(range(start // {BLOCK_WORDS}, (start + size - 1) // {BLOCK_WORDS} + 1)) AS block
  FROM laid WHERE size > 0),
used AS (
  SELECT n, sum(times * (least((p.block + 1) * {BLOCK_WORDS}, start + size) - greatest(p.block * {BLOCK_WORDS}, start)))
            AS taken
  FROM pieces p JOIN times USING (sid, block) GROUP BY n)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM laid LEFT JOIN used USING (n)"""
