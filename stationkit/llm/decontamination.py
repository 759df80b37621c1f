"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Word n-grams of the test items that are rare in the corpus are the seeds. Where
a document holds a seed, the item is aligned with the words around it. Word
insertions, deletions and changes only lower the score, so edited and
paraphrased copies are found too. Documents never move: each task reads its texts
and one block of the test items.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.llm.arrays import Words, blocks, sequence_hash, split_words, text_bytes
from stationkit.llm.superminhash import _only
from stationkit.plans.stored import store

SEED_WORDS = 4
# An n-gram in at most this share of the documents is rare. The rarer half of an
# item's n-grams always counts as rare, so that an item that is everywhere is found.
RARE_SHARE = 1e-3
# Share of the highest possible alignment score from which a document holds an item.
LEAST_SCORE = 0.5
MATCH, CHANGE, GAP = 2, -1, -1
# Windows are aligned in tables of about this many words.
CELLS = 1 << 18
# Test items are worked on in blocks of about this many characters.
ITEM_CHARS = 2_000_000

_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
    for c in range(256)
)


def plain_words(texts: list[bytes]) -> Words:
    """Lower-case words of letters and digits."""
    return split_words([t.translate(_PLAIN) for t in texts], lower=False)


@dataclass(frozen=True)
class Items:
    """One block of test items: word hashes, and sorted seeds with their places."""

    ids: list[int]
    words: list[np.ndarray]
    widths: list[int]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]

    def keep(self, wanted: dict[int, np.ndarray]) -> Items:
        """The same items with only the seeds marked in ``wanted``, by width."""
        seeds = {w: tuple(x[wanted[w]] for x in parts) for w, parts in self.seeds.items()}
        return Items(self.ids, self.words, self.widths, seeds)


def item_block(rows: list[tuple[int, bytes]]) -> Items:
    """Items with all their n-grams as seeds; an item shorter than a seed is one seed."""
    found = plain_words([text for _, text in rows])
    ids, words = [], []
    for (item_id, _), first, count in zip(rows, found.firsts, found.counts, strict=True):
        if count:
            ids.append(item_id)
            words.append(found.hashes[first : first + count])
    by_width: dict[int, list[tuple[np.ndarray, int]]] = {}
    for k, w in enumerate(words):
        width = min(SEED_WORDS, len(w))
        grams = sequence_hash([w[i : len(w) - width + 1 + i] for i in range(width)])
        by_width.setdefault(width, []).append((grams, k))
    seeds = {}
    for width, parts in by_width.items():
        grams = np.concatenate([g for g, _ in parts])
        item = np.concatenate([np.full(len(g), k) for g, k in parts])
        place = np.concatenate([np.arange(len(g)) for g, _ in parts])
        order = np.argsort(grams, kind="stable")
        seeds[width] = (grams[order], item[order], place[order])
    return Items(ids, words, sorted(by_width), seeds)


def _lookup(words: Words, width: int, sorted_seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers at which a seed begins, and the number of its first equal in the list."""
    n = len(words.hashes) - width + 1
    if n <= 0 or not len(sorted_seeds):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = sequence_hash([words.hashes[i : n + i] for i in range(width)])
    # Most n-grams fail on a table of the seeds' low bits already.
    bits = np.zeros(1 << 16, dtype=bool)
    bits[(sorted_seeds & np.uint64(0xFFFF)).astype(np.int64)] = True
    maybe = np.flatnonzero(bits[(grams & np.uint64(0xFFFF)).astype(np.int64)])
    maybe = maybe[words.texts[maybe] == words.texts[maybe + width - 1]]
    at = np.searchsorted(sorted_seeds, grams[maybe])
    at[at == len(sorted_seeds)] = 0
    hit = sorted_seeds[at] == grams[maybe]
    return maybe[hit], at[hit]


def align(item: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of an item with each row, and the word it ends at.

    Rows are word hashes padded with zeros. Within a row the best gap to the left
    is a running maximum, so that all columns of a step are computed at once.
    """
    rows, width = windows.shape
    slope = np.arange(width) * -GAP
    above = np.zeros((rows, width), dtype=np.int64)
    best, end = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
    for word in item:
        diagonal = np.zeros_like(above)
        diagonal[:, 1:] = above[:, :-1]
        here = np.maximum(diagonal + np.where(windows == word, MATCH, CHANGE), above + GAP)
        np.maximum(here, 0, out=here)
        above = np.maximum.accumulate(here + slope, axis=1) - slope
        top = above.argmax(axis=1)
        value = above[np.arange(rows), top]
        better = value > best
        best[better], end[better] = value[better], top[better]
    return best, end


def find_items(items: Items, texts: list[bytes]) -> list[tuple[int, int, float, int, int, int]]:
    """(text number, item id, score, first word, last word, seeds) of all items found.

    For each text and item the best place counts, of equal ones the first.
    """
    words = plain_words(texts)
    spots = []
    for width in items.widths:
        seeds, item, place = items.seeds[width]
        at, first = _lookup(words, width, seeds)
        last = np.searchsorted(seeds, seeds[first], side="right")
        n = last - first
        pick = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(at, n)
        spots.append(np.stack((words.texts[at], item[pick], at - place[pick]), axis=1))
    spots = np.concatenate(spots) if spots else np.zeros((0, 3), np.int64)
    if not len(spots):
        return []
    spots = spots[np.lexsort((spots[:, 2], spots[:, 0], spots[:, 1]))]
    size = np.array([len(w) for w in items.words])
    pad = size // 4 + 2
    new = np.ones(len(spots), dtype=bool)
    new[1:] = (spots[1:, :2] != spots[:-1, :2]).any(axis=1) | (
        spots[1:, 2] - spots[:-1, 2] > pad[spots[1:, 1]]
    )
    group = np.flatnonzero(new)
    seeds_in = np.diff(np.concatenate((group, [len(spots)])))
    text, item = spots[group, 0], spots[group, 1]
    final = np.concatenate((group[1:], [len(spots)])) - 1
    text_first = words.firsts[text]
    begin = np.maximum(spots[group, 2] - pad[item], text_first)
    stop = np.minimum(spots[final, 2] + size[item] + pad[item], text_first + words.counts[text])
    # An alignment that counts is at most twice as wide as its item, so it lies whole
    # in one of the pieces into which a longer window is cut.
    wide = 4 * size[item] + 2 * pad[item]
    step = wide - 2 * size[item]
    pieces = np.maximum(-((begin + wide - stop) // step) + 1, 1)
    whole = np.repeat(np.arange(len(group)), pieces)
    nth = np.arange(len(whole)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begin = begin[whole] + nth * step[whole]
    stop = np.minimum(begin + wide[whole], stop[whole])
    text, item, seeds_in, width = text[whole], item[whole], seeds_in[whole], stop - begin
    best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
    order = np.lexsort((-width, item))
    for own in np.split(order, np.flatnonzero(np.diff(item[order])) + 1):
        k, done = int(item[own[0]]), 0
        while done < len(own):
            # The longest comes first and tells how many fit into one table.
            long = int(width[own[done]])
            part = own[done : done + max(CELLS // long, 1)]
            done += len(part)
            grid = begin[part][:, None] + np.arange(long)
            inside = grid < stop[part][:, None]
            rows = np.where(inside, words.hashes[np.minimum(grid, len(words.hashes) - 1)], 0)
            value, end = align(items.words[k], rows)
            share = value / (MATCH * size[k])
            good = np.flatnonzero(share >= LEAST_SCORE)
            if not len(good):
                continue
            # The start is the end of the same alignment read backwards.
            back = np.zeros((len(good), int(end[good].max()) + 1), dtype=rows.dtype)
            for j, g in enumerate(good):
                back[j, : end[g] + 1] = rows[g, : end[g] + 1][::-1]
            _, reach = align(items.words[k][::-1], back)
            for g, r in zip(good, reach, strict=True):
                t = int(text[part[g]])
                offset = int(begin[part[g]] - words.firsts[t])
                found = (float(share[g]), offset + int(end[g] - r), offset + int(end[g]),
                         int(seeds_in[part[g]]))
                if (t, k) not in best or (found[0], -found[1]) > (best[t, k][0], -best[t, k][1]):
                    best[t, k] = found
    return [(t, items.ids[k], *found) for (t, k), found in best.items()]


def _item_blocks(items: DataFrame) -> list[Items]:
    """The test items in blocks of a bounded size, read one block after the other."""
    rows = items.select(F.col("item_id").cast("bigint"), "text").where(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    chars = rows.agg(F.sum(F.length("text") + 16).alias("n")).first()["n"] or 0
    parts = max(1, math.ceil(chars / ITEM_CHARS))
    out = []
    for k in range(parts):
        own = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        own = own.distinct().orderBy("item_id", "text").collect()
        out.append(item_block([(r["item_id"], r["text"].encode("utf-8", "replace")) for r in own]))
    return out


def _rare(items: Items, docs: DataFrame) -> Items:
    """Leave the n-grams that are rare in the corpus, and the rarer half of each item's."""
    held = docs.sparkSession.sparkContext.broadcast(items)

    def count(batches):
        items = held.value
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            totals = {w: np.zeros(len(items.seeds[w][0]), np.int64) for w in items.widths}
            for begin, end in blocks(texts):
                words = plain_words(texts[begin:end])
                for width in items.widths:
                    at, first = _lookup(words, width, items.seeds[width][0])
                    pairs = np.unique(np.stack((first, words.texts[at]), axis=1), axis=0)
                    np.add.at(totals[width], pairs[:, 0], 1)
            for width, total in totals.items():
                seen = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(seen), width)), pa.array(seen), pa.array(total[seen])],
                    ["width", "seed", "docs"],
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array([0]), pa.array([0]), pa.array([len(texts)])], ["width", "seed", "docs"]
            )

    counts = docs.select("text").mapInArrow(count, "width bigint, seed bigint, docs bigint")
    # One row for each n-gram of the block of items, however large the corpus is.
    rows = counts.groupBy("width", "seed").agg(F.sum("docs").alias("docs")).collect()
    total = next((r["docs"] for r in rows if r["width"] == 0), 0)
    wanted = {}
    for width in items.widths:
        seeds, item, _ = items.seeds[width]
        docs_with = np.zeros(len(seeds), np.int64)
        for r in rows:
            if r["width"] == width:
                docs_with[r["seed"]] = r["docs"]
        docs_with = docs_with[np.searchsorted(seeds, seeds)]
        order = np.lexsort((docs_with, item))
        first = np.searchsorted(item[order], item[order])
        size = np.bincount(item, minlength=len(items.ids))[item[order]]
        half = np.zeros(len(seeds), dtype=bool)
        half[order] = (np.arange(len(seeds)) - first) * 2 <= size
        wanted[width] = half | (docs_with <= RARE_SHARE * total)
    return items.keep(wanted)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Documents that hold a test item, and where.

    One row for each document and item found: ``doc_id, item_id, score`` (share
    of the highest alignment score, at least 0.5), ``first_word, last_word``
    (counted from 0 in words of letters and digits) and ``seeds``, the rare
    n-grams that led there. Null, empty or wordless texts and items hold nothing;
    rows without doc_id or item_id are left out; equal rows give one result row.
    An empty table on either side gives an empty result. Only these columns are read.
    """
    kind = (
        "doc_id bigint, item_id bigint, score double, first_word bigint, last_word bigint, "
        "seeds bigint"
    )
    read = docs.select(F.col("doc_id").cast("bigint"), "text").where(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    out = None
    for block in _item_blocks(items):
        held = docs.sparkSession.sparkContext.broadcast(_rare(block, read))

        def run(batches, held=held):
            names = ["doc_id", "item_id", "score", "first_word", "last_word", "seeds"]
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            for batch in batches:
                texts = text_bytes(batch.column("text"))
                ids = batch.column("doc_id")
                rows = []
                for begin, end in blocks(texts):
                    for t, *found in find_items(held.value, texts[begin:end]):
                        rows.append((ids[begin + t].as_py(), *found))
                columns = zip(*rows, strict=True) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names
                )

        found = read.mapInArrow(run, kind)
        out = found if out is None else out.union(found)
    return out.distinct()


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no test item, with all their columns."""
    found = contaminated(docs, items).select("doc_id").distinct()
    held = store(found, "contaminated")
    return _only(docs, held.df, held.rows, "left_anti")
