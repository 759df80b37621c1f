"""Divergence of sources: how far apart the word use of every two sources of a language is.

The counts of a group of documents over the kept terms of its language are the
leaves of a segment tree. Nodes are hash-consed: subtrees with equal counts are
one node, wherever they stand and whichever group they belong to. Two trees are
priced by walking both at once; a pair of nodes met before is not walked again,
so long stretches that both groups lack, and stretches they share, cost one
visit each.

Terms are dealt by hash over blocks of at most ``BLOCK`` leaves, and sources over
chunks, so that a task holds the subtrees of two chunks over one block whatever
the vocabulary and the number of sources. Above a block the tree only adds.
All numbers are whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationkit.plans.keyed import attach
from stationkit.plans.stored import StoredTable, store

# Contract: documents a term must be in, smoothing, whole, length of term lists.
LEAST_DOCS = 30
SMOOTH = 5
WHOLE = 1_000_000_000
TOP = 50
# Wanted terms in a block (a power of two less some room for uneven hashing), and sources in a chunk.
BLOCK = 1800
CHUNK = 24
# Counted terms a task holds before it hands them on.
HELD = 400_000
# Long texts are cut near this many bytes, between words.
_CUT = 1 << 20

_WORD = re.compile(rb"[A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^A-Za-z\x80-\xff]")


def _pieces(text: bytes) -> Iterator[bytes]:
    begin = 0
    while len(text) - begin > _CUT:
        gap = _GAP.search(text, begin + _CUT)
        if not gap:
            break
        yield text[begin : gap.start()]
        begin = gap.start()
    yield text[begin:] if begin else text


def term_counts(docs: DataFrame) -> DataFrame:
    """Columns ``lang, source, term, count, docs``: occurrences of a term and documents with it.

    A term is a run of ASCII letters and bytes above 127, with A-Z lower-cased.
    Tasks add up what they have read before it is shuffled.
    """

    def rows(counts: dict, holders: dict):
        for (lang, source), own in counts.items():
            in_docs = holders[lang, source]
            n = len(own)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * n, pa.string()),
                    pa.array([source] * n, pa.string()),
                    pa.array(own.keys(), pa.binary()),
                    pa.array(own.values(), pa.int64()),
                    pa.array([in_docs[w] for w in own], pa.int64()),
                ],
                ["lang", "source", "term", "count", "docs"],
            )

    def run(batches):
        counts, holders = {}, {}
        held = 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "source"))
            for lang, source, text in zip(*columns, batch.column("text"), strict=True):
                key = lang, source
                if key not in counts:
                    counts[key], holders[key] = Counter(), Counter()
                own, before = counts[key], len(counts[key])
                seen: set[bytes] = set()
                for piece in _pieces(text.as_py().lower()):
                    words = _WORD.findall(piece)
                    own.update(words)
                    seen.update(words)
                holders[key].update(seen)
                held += len(own) - before
                if held > HELD:
                    yield from rows(counts, holders)
                    counts, holders, held = {}, {}, 0
        yield from rows(counts, holders)

    read = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    found = read.mapInArrow(
        run, "lang string, source string, term binary, count bigint, docs bigint"
    )
    return found.groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs")
    )


def price(count: Column, whole: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / whole) in 64-bit numbers, three digits at a time.

    ``whole`` is at least count + 5 and, for whole numbers to stay in range,
    below 9 * 10^15 term occurrences in a language.
    """
    rest = count + SMOOTH
    digits = F.lit(0).cast("bigint")
    whole_part = F.call_function("div", rest, whole)
    rest = rest - whole_part * whole
    for _ in range(3):
        rest = rest * 1000
        digit = F.call_function("div", rest, whole)
        digits, rest = digits * 1000 + digit, rest - digit * whole
    return 1 + whole_part * WHOLE + digits


def _prices(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """The same in numpy; 0 for a leaf that stands for no term (count -1)."""
    safe = np.maximum(whole, 1)
    total, rest = np.divmod(count + SMOOTH, safe)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, safe)
        total = total * 1000 + digit
    return np.where(count < 0, 0, 1 + total)


class Forest:
    """Hash-consed segment trees, one for each row of ``counts`` (rows x leaves, a power of two).

    Level 0 are the distinct counts; a node of a higher level is a distinct pair
    of nodes of the level below. ``roots`` has one node for each tree.
    """

    def __init__(self, counts: np.ndarray):
        self.leaves, nodes = np.unique(counts, return_inverse=True)
        nodes = nodes.reshape(counts.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        while nodes.shape[1] > 1:
            width = int(nodes.max()) + 1
            pairs, own = np.unique(nodes[:, ::2] * width + nodes[:, 1::2], return_inverse=True)
            self.levels.append((pairs // width, pairs % width))
            nodes = own.reshape(nodes.shape[0], -1)
        self.roots = nodes[:, 0]

    def distances(self, a: np.ndarray, b: np.ndarray, wholes: np.ndarray) -> np.ndarray:
        """Sum over the leaves of the price difference, for each pair of trees (a, b).

        Both trees of a pair are walked down together. On every level each
        distinct pair of nodes (of trees with the same two wholes) is kept once;
        prices come back up along the same steps. Equal nodes of trees with equal
        wholes differ by nothing and are left at once.
        """
        known, kind = np.unique(np.stack((wholes[a], wholes[b]), axis=1), axis=0, return_inverse=True)
        steps: list[tuple[np.ndarray, int]] = []
        kind, left, right = kind.ravel(), self.roots[a], self.roots[b]
        alike = known[:, 0] == known[:, 1]

        def once(kind, left, right):
            size = max(int(left.max(initial=0)), int(right.max(initial=0))) + 1
            key, back = np.unique((kind * size + left) * size + right, return_inverse=True)
            pair = key % (size * size)
            return key // (size * size), pair // size, pair % size, back.ravel()

        kind, left, right, back = once(kind, left, right)
        steps.append((back, 0))
        for low, high in reversed(self.levels):
            open_pairs = np.flatnonzero(~(alike[kind] & (left == right)))
            k = np.concatenate((kind[open_pairs], kind[open_pairs]))
            x = np.concatenate((low[left[open_pairs]], high[left[open_pairs]]))
            y = np.concatenate((low[right[open_pairs]], high[right[open_pairs]]))
            here = len(kind)
            kind, left, right, back = once(k, x, y)
            # From the pairs of this level to those above: two children for each open pair.
            steps.append((np.concatenate((open_pairs, back)), here))
        value = np.abs(
            _prices(self.leaves[left], known[kind, 0]) - _prices(self.leaves[right], known[kind, 1])
        )
        for index, above in reversed(steps[1:]):
            n = len(index) // 3
            total = np.zeros(above, dtype=np.int64)
            total[index[:n]] = value[index[n : 2 * n]] + value[index[2 * n :]]
            value = total
        return value[steps[0][0]]


def _compare(group: pa.Table) -> pa.Table:
    """Distances of the sources of two chunks over the terms of one block."""
    group = group.combine_chunks()
    is_cell = pc.is_valid(group["term"])
    named = group.filter(pc.invert(is_cell))
    sources, wholes = named["source"].to_pylist(), named["whole"].to_numpy()
    chunk = named["chunk"].to_numpy()
    low, high, terms = (group[c][0].as_py() for c in ("low", "high", "terms"))
    lang = group["lang"][0].as_py()
    cells = group.filter(is_cell)
    number = {s: i for i, s in enumerate(sources)}
    place = np.zeros(0, np.int64)
    if cells.num_rows:
        # Frequent terms first: what both groups lack then lies side by side.
        ranked = cells.select(["term", "total"]).group_by("term").aggregate([("total", "max")])
        order = np.argsort(-ranked["total_max"].to_numpy(), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        at = pc.index_in(cells["term"].combine_chunks(), ranked["term"].combine_chunks())
        place = rank[at.to_numpy(zero_copy_only=False)]
    width = 1 << max(int(terms) - 1, 0).bit_length()
    counts = np.full((len(sources), width), -1, dtype=np.int64)
    counts[:, :terms] = 0
    row = np.array([number[s] for s in cells["source"].to_pylist()], dtype=np.int64)
    counts[row, place] = cells["count"].to_numpy()
    trees = Forest(counts)
    first, second = np.flatnonzero(chunk == low), np.flatnonzero(chunk == high)
    a, b = (x.ravel() for x in np.meshgrid(first, second, indexing="ij"))
    if low == high:
        a, b = a[a < b], b[a < b]
    value = trees.distances(a, b, wholes) if len(a) else np.zeros(0, np.int64)
    name = pa.array(sources, pa.string())
    return pa.table(
        {
            "lang": pa.array([lang] * len(a), pa.string()),
            "x": name.take(pa.array(a)),
            "y": name.take(pa.array(b)),
            "value": pa.array(value),
        }
    )


def _pairs(groups: DataFrame, cells: DataFrame, sized: DataFrame, langs: StoredTable) -> DataFrame:
    """Columns ``lang, x, y, value`` for every two sources of a language, each pair once.

    ``groups`` and ``cells`` carry ``chunk``; every row meets all chunks of its
    language, as the result holds every pair. ``sized`` has the terms of a block.
    """
    first = F.lit(0).cast("bigint")
    spread = langs.view(langs.df.select("lang", "blocks", "chunks"))
    in_blocks = attach(groups, spread, ["lang"], "inner").withColumn(
        "block", F.explode(F.sequence(first, F.col("blocks") - 1))
    )
    named = attach(in_blocks, sized, ["lang", "block"]).select(
        "lang", "block", "source", "chunk", "chunks", "whole",
        F.coalesce("terms", first).alias("terms"),
        F.lit(None).cast("binary").alias("term"), F.lit(None).cast("bigint").alias("total"),
        F.lit(None).cast("bigint").alias("count"),
    )
    counted = cells.select(
        "lang", "block", "source", "chunk", "chunks", F.lit(None).cast("bigint").alias("whole"),
        F.lit(None).cast("bigint").alias("terms"), "term", "total", "count",
    )
    met = named.unionByName(counted).withColumn(
        "other", F.explode(F.sequence(first, F.col("chunks") - 1))
    )
    # The rows that name the sources also tell how many terms the block has.
    both = met.withColumns(
        {"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")}
    ).groupBy("lang", "block", "low", "high")

    def compare(group: pa.Table) -> pa.Table:
        terms = pc.max(group["terms"])
        filled = pa.chunked_array([pa.array([terms.as_py()] * group.num_rows, pa.int64())])
        at = group.schema.get_field_index("terms")
        return _compare(group.set_column(at, "terms", filled))

    part = both.applyInArrow(compare, "lang string, x string, y string, value bigint")
    return part.groupBy("lang", "x", "y").agg(F.sum("value").alias("value"))


def divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, block: int = BLOCK, chunk: int = CHUNK
) -> DataFrame:
    """Distances between the sources of every language, and the terms that mark a source.

    Kept are the terms in at least ``least_docs`` documents of a language. A
    group (a source in a language, or a whole language) gives a kept term that
    occurs count times the share p = 1 + floor(10^9 * (count + 5) / (N + 5 V)),
    N its occurrences of kept terms, V their number in the language. Returns
    ``lang, source, part, item, value, rank``: part ``pair`` has every other
    source of the language with the sum of |p - q| over all kept terms; part
    ``term`` has up to ``top`` terms of the source whose share exceeds the
    language's, with the difference. Ranks go by falling value, then by item.

    Null text, lang and source are ''. Every row of ``docs`` is a document, also
    if its id repeats; ids and other columns are not read. A source without
    terms still has pairs, and so have the sources of a language that keeps no
    term, with value 0. A language with one source has no pairs. An empty table
    gives an empty one. The pair part has as many rows as there are pairs.
    """
    read = docs.select(
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source"))
    )
    cells = store(term_counts(read), "term-cells").df
    kept = store(
        cells.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("count").alias("total"))
        .where(F.col("docs") >= least_docs).select("lang", "term", "total"),
        "kept-terms",
    )
    used = store(
        cells.select("lang", "source", "term", "count").join(kept.df, ["lang", "term"]), "kept-cells"
    ).df

    sources = read.select("lang", "source").distinct()
    sums = used.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    named = store(sources.join(sums, ["lang", "source"], "left"), "sources").df
    words = kept.df.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("all"))
    langs = store(
        named.groupBy("lang").agg(F.count(F.lit(1)).alias("sources")).join(words, "lang", "left")
        .select(
            "lang",
            F.coalesce("v", F.lit(0)).alias("v"),
            (F.coalesce("all", F.lit(0)) + SMOOTH * F.coalesce("v", F.lit(0))).alias("lang_whole"),
            F.greatest(F.ceil(F.coalesce("v", F.lit(0)) / block), F.lit(1)).alias("blocks"),
            F.ceil(F.col("sources") / chunk).alias("chunks"),
        ),
        "languages",
    )
    whole = F.coalesce("n", F.lit(0)) + SMOOTH * F.col("v")
    chunk_of = F.pmod(F.xxhash64("source"), F.col("chunks")).alias("chunk")
    groups = store(
        attach(named, langs, ["lang"], "inner").select("lang", "source", whole.alias("whole"), chunk_of),
        "groups",
    )
    block_of = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    sized = (
        attach(kept.df, langs, ["lang"], "inner").select("lang", block_of)
        .groupBy("lang", "block").agg(F.count(F.lit(1)).alias("terms"))
    )
    placed = attach(used, langs, ["lang"], "inner").select(
        "lang", "source", "term", "count", "total", "lang_whole", "chunks", block_of, chunk_of
    )

    once = store(_pairs(groups.df, placed, sized, langs), "distances").df
    pairs = once.select(
        "lang", F.explode(F.array(F.struct(F.col("x").alias("source"), F.col("y").alias("item")),
                                  F.struct(F.col("y").alias("source"), F.col("x").alias("item")))).alias("end"),
        "value",
    ).select("lang", "end.source", F.lit("pair").alias("part"), "end.item", "value")

    weights = groups.view(groups.df.select("lang", "source", "whole"))
    above = (
        attach(placed, weights, ["lang", "source"], "inner")
        .withColumn("value", price(F.col("count"), F.col("whole")) - price(F.col("total"), F.col("lang_whole")))
        .where("value > 0")
    )
    terms = above.select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value"
    )
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return pairs.withColumn("rank", F.row_number().over(best)).unionByName(ranked)


SQL = r"""
WITH read AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
words AS (
  SELECT doc, lang, source,
         unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM read),
kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
sized AS (SELECT lang, count(*) AS v, sum(total) AS all_terms FROM kept GROUP BY lang),
cells AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM words w JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM read) g LEFT JOIN cells USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (g.n + 5 * s.v)::HUGEINT AS p,
         1 + 1000000000::HUGEINT * (k.total + 5) // (s.all_terms + 5 * s.v)::HUGEINT AS q
  FROM groups g JOIN kept k USING (lang) JOIN sized s USING (lang)
    LEFT JOIN cells c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN apart p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part
    ORDER BY value DESC, encode(item)) AS rank FROM both_parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50"""
