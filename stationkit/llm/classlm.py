"""Scoring texts with a class-based bigram model (Brown classes).

Words are counted over all training documents. The commonest words, and groups
of the other words by spelling, are the units that exchange clustering assigns to
classes: each unit in turn moves to the class that raises the likelihood of the
class bigrams most. A token's probability is class transition times unit within
class times word within unit, each smoothed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.llm.arrays import blocks, mix, split_words, text_bytes
from stationkit.llm.quality import fold
from stationkit.plans.stored import store

# Words that are units of their own, spelling groups of the others, and classes.
UNIT_WORDS = 2048
GROUPS = 256
CLASSES = 64
SWEEPS = 12
# The counts of so many commonest words (4 MB) are broadcast; rarer words meet theirs in a join.
HOT_WORDS = 1 << 18
# Prior strength of the class distribution in a transition.
PRIOR = 20.0
_END_HASH = np.uint64(0x454E44)


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and spelling group of every token, an end after each text, and tokens per text.

    The group comes from the last three bytes of a word; the end has group -1.
    """
    words = split_words(texts)
    count = len(words.hashes) + len(texts)
    hashes, groups = np.full(count, _END_HASH), np.full(count, -1)
    at = np.arange(len(words.hashes)) + words.texts
    hashes[at] = words.hashes
    tail = np.zeros(len(at), np.uint64)
    for back in (1, 2, 3):
        there = words.ends - back >= words.starts
        byte = words.data[np.maximum(words.ends - back, 0)].astype(np.uint64)
        tail = tail * np.uint64(257) + np.where(there, byte + np.uint64(1), np.uint64(0))
    groups[at] = (mix(tail) % np.uint64(GROUPS)).astype(np.int64)
    return hashes, groups, words.counts + 1


def word_counts(docs: DataFrame) -> DataFrame:
    """Columns ``word`` (hash), ``grp`` and ``n`` over all texts, ends included."""

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for begin, end in blocks(texts, 1 << 22):
                hashes, groups, _ = _tokens(texts[begin:end])
                found, at, n = np.unique(hashes, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.view(np.int64)), pa.array(groups[at]), pa.array(n)],
                    ["word", "grp", "n"],
                )

    parts = docs.select("text").mapInArrow(run, "word bigint, grp bigint, n bigint")
    return parts.groupBy("word", "grp").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class ClassModel:
    """Hot words (sorted hashes) with counts and units, and the log10 tables of the model."""

    hot: np.ndarray
    hot_counts: np.ndarray
    hot_units: np.ndarray
    total: int
    types: int
    classes: np.ndarray
    steps: np.ndarray
    unit_given_class: np.ndarray
    word_given_unit: np.ndarray


def units_of(hot: np.ndarray, hot_units: np.ndarray, hashes: np.ndarray, groups: np.ndarray):
    """Unit of every token, and its place among the hot words (-1: not one of them).

    Unit 0 is the end; the commonest words follow, then the spelling groups.
    """
    at = np.searchsorted(hot, hashes)
    at[at == len(hot)] = 0
    found = hot[at] == hashes if len(hot) else np.zeros(len(hashes), bool)
    at = np.where(found, at, -1)
    own = np.where(found, hot_units[at] if len(hot) else 0, 0)
    units = np.where(own > 0, own - 1, 1 + UNIT_WORDS + groups)
    return np.where(groups < 0, 0, units), at


def _x_log_x(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of every unit from the bigram counts of units, by exchange clustering.

    Unit 0, the end, keeps class 0 to itself. Sweeps end early when no unit moves.
    """
    units = len(pairs)
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    of = np.zeros(units, dtype=np.int64)
    order = [u for u in np.argsort(-weight, kind="stable") if u and weight[u] > 0]
    for rank, u in enumerate(order):
        of[u] = 1 + rank % (classes - 1)
    unseen = [u for u in range(1, units) if weight[u] == 0]
    of[unseen] = 1
    hot = np.zeros((units, classes))
    hot[np.arange(units), of] = 1
    table = hot.T @ pairs @ hot
    for _ in range(sweeps):
        moved = 0
        for u in order:
            c = of[u]
            right = np.bincount(of, pairs[u], classes)
            left = np.bincount(of, pairs[:, u], classes)
            own = pairs[u, u]
            right[c] -= own
            left[c] -= own
            table[c] -= right
            table[:, c] -= left
            table[c, c] -= own
            gain = (_x_log_x(table + right) - _x_log_x(table)).sum(axis=1)
            gain += (_x_log_x(table + left[:, None]) - _x_log_x(table)).sum(axis=0)
            d = np.diagonal(table)
            gain -= _x_log_x(d + right) + _x_log_x(d + left) - _x_log_x(d)
            gain += _x_log_x(d + right + left + own)
            for axis, n in ((1, right.sum() + own), (0, left.sum() + own)):
                size = table.sum(axis=axis)
                gain -= _x_log_x(size + n) - _x_log_x(size)
            gain[0] = -np.inf
            best = int(gain.argmax())
            if gain[best] <= gain[c] + 1e-9:
                best = c
            moved += best != c
            of[u] = best
            table[best] += right
            table[:, best] += left
            table[best, best] += own
        if not moved:
            break
    return of


def _unit_pairs(docs: DataFrame, hot: np.ndarray, hot_units: np.ndarray) -> np.ndarray:
    """Bigram counts of units over all training texts, each led in by an end."""
    n_units = 1 + UNIT_WORDS + GROUPS
    held = docs.sparkSession.sparkContext.broadcast((hot, hot_units))

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for begin, end in blocks(texts, 1 << 22):
                hashes, groups, _ = _tokens(texts[begin:end])
                units, _ = units_of(*held.value, hashes, groups)
                last = np.concatenate(([0], units[:-1]))
                found, n = np.unique(last * n_units + units, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], ["pair", "n"])

    parts = docs.select("text").mapInArrow(run, "pair bigint, n bigint")
    # At most one row for each pair of units: their number is fixed.
    rows = parts.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_units * n_units)
    out[rows["pair"].to_numpy()] = rows["n"].to_numpy()
    return out.reshape(n_units, n_units)


def _hot_words(counts: DataFrame) -> pa.Table:
    """The commonest words, at most ``HOT_WORDS``, by falling count.

    Counts are binned by their logarithm, and bins are taken from the top while
    they fit. Of the first that does not, an even share by hash is taken, so that
    the list is about full whatever the counts. No task has to merge a long list
    of candidates.
    """
    level = F.floor(F.log2("n") * 16)
    bins = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect()
    taken, wanted = 0, F.lit(False)
    for r in sorted(bins, reverse=True):
        room = HOT_WORDS - taken
        if r["words"] > room:
            place = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) / (1 << 30)
            wanted |= (level == r["level"]) & (place < 0.98 * room / r["words"])
            break
        taken += r["words"]
        wanted |= level == r["level"]
    hot = counts.where(wanted)
    return hot.toArrow().sort_by([("n", "descending"), ("word", "ascending")])


def train(docs: DataFrame) -> tuple[ClassModel, DataFrame]:
    """The model of some training texts, and the stored counts of all their words."""
    counts = store(word_counts(docs), "word-counts", total=F.sum("n"))
    top = _hot_words(counts.df)
    words = top["word"].to_numpy().view(np.uint64)
    n, grp = top["n"].to_numpy(), top["grp"].to_numpy()
    order = np.argsort(words)
    units = np.zeros(len(words), dtype=np.int64)
    named = np.flatnonzero(grp >= 0)[:UNIT_WORDS]
    units[named] = 2 + np.arange(len(named))
    pairs = _unit_pairs(docs, words[order], units[order])
    of = exchange(pairs)
    hot = np.zeros((len(of), CLASSES))
    hot[np.arange(len(of)), of] = 1
    table = hot.T @ pairs @ hot
    size = pairs.sum(axis=0)
    class_size = table.sum(axis=0)
    share = (class_size + 1) / (class_size.sum() + CLASSES)
    steps = (table + PRIOR * share) / (table.sum(axis=1, keepdims=True) + PRIOR)
    per_class = hot.sum(axis=0)
    unit_given_class = (size + 1) / (class_size + per_class)[of]
    kinds = np.zeros(GROUPS)
    for r in counts.df.where("grp >= 0").groupBy("grp").agg(F.count(F.lit(1)).alias("k")).collect():
        kinds[r["grp"]] = r["k"]
    np.subtract.at(kinds, grp[named], 1)
    word_given_unit = np.ones(len(of))
    word_given_unit[1 + UNIT_WORDS :] = 1 / (size[1 + UNIT_WORDS :] + kinds + 1)
    return ClassModel(
        words[order], n[order], units[order], int(counts.seen["total"] or 0), counts.rows, of,
        np.log10(steps), np.log10(unit_given_class), np.log10(word_given_unit),
    ), counts.df


def log_probabilities(docs: DataFrame, folds: int = 7, held: int = 2) -> DataFrame:
    """Every document with its log10 probability under the class model and a base model.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity``, one row for each row of ``docs``. Learned from are the rows
    outside fold ``held`` whose doc_id is not null. A null text counts as an
    empty one: its only token is the end. Without training texts the base score
    of every token is log10(1). Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), "text")
    model, counts = train(texts.where(fold("doc_id", folds) != held))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    base_unit = np.log10(max(model.total + model.types + 1, 1))

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for begin, end in blocks(texts, 1 << 21):
                hashes, groups, sizes = _tokens(texts[begin:end])
                units, at = units_of(m.hot, m.hot_units, hashes, groups)
                first = np.cumsum(sizes) - sizes
                last = np.concatenate(([0], units[:-1]))
                value = m.steps[m.classes[last], m.classes[units]] + m.unit_given_class[units]
                value += m.word_given_unit[units]
                hot = at >= 0
                seen = np.where(hot, np.log10((m.hot_counts[at] if len(m.hot) else 0) + 1.0), 0.0)
                value += np.where(units > UNIT_WORDS, seen, 0.0)
                base = np.add.reduceat(seen, first) - sizes * base_unit
                rest = hashes[~hot]
                rest_sizes = np.add.reduceat((~hot).astype(np.int64), first)
                offsets = np.concatenate(([0], np.cumsum(rest_sizes))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(begin, end - begin),
                        batch.column("doc_id").slice(begin, end - begin),
                        pa.array(sizes),
                        pa.array(np.add.reduceat(hot.astype(np.int64), first)),
                        pa.array(base),
                        pa.array(np.add.reduceat(value, first)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(rest.view(np.int64))),
                    ],
                    ["row", "doc_id", "n_tokens", "known", "base", "value", "rest"],
                )

    kind = (
        "row bigint, doc_id bigint, n_tokens bigint, known bigint, base double, value double, "
        "rest array<bigint>"
    )
    numbered = texts.withColumn("row", F.monotonically_increasing_id())
    local = store(numbered.mapInArrow(run, kind), "scored").df
    # Rare words only: none of them has more rows than the rarest hot word.
    rare = local.select("row", F.explode("rest").alias("word")).join(counts.select("word", "n"), "word")
    rare = rare.groupBy("row").agg(
        F.count(F.lit(1)).alias("more"), F.sum(F.log10(F.col("n") + 1)).alias("seen")
    )
    more, seen = F.coalesce("more", F.lit(0)), F.coalesce("seen", F.lit(0.0))
    score = F.col("value") + seen
    return local.join(rare, "row", "left").select(
        "doc_id",
        (fold("doc_id", folds) == held).alias("held_out"),
        "n_tokens",
        (F.col("known") + more).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base") + seen).alias("base_score"),
        score.alias("score"),
        F.pow(F.lit(10.0), -score / F.col("n_tokens")).alias("perplexity"),
    )
