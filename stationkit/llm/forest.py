"""Near-duplicate embeddings with a forest of random-projection trees.

Every tree splits the vectors again and again at the median of a random
projection; vectors near the split go to both sides. Vectors are compared only
within the leaves they share. The upper part of the trees is fitted on a bounded
sample, through which every vector then goes; crowded leaves are split on with
trees fitted on a sample of their own.

A split must not tear neighbours apart: of several directions the one is taken
that separates the fewest linked pairs of the sample, and where all separate too
many, the node stays a leaf. Trees are added until pairs made at the limit
angle are almost sure to meet.

Large dense groups never enter the forest. Around the dense places of the sample
balls are laid whose radius is half the limit angle, so that any two vectors of
a ball are linked for certain and need only be counted. A vector outside can
link into a ball only if it is within one and a half limit angles of its centre;
these few visitors are compared with its members.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationkit.llm.components import components
from stationkit.plans.stored import store

# Share of the vectors of a node that goes to both sides.
SPILL = 0.08
# Wanted vectors in a leaf; leaves above CROWDED are split on.
LEAF = 256
CROWDED = 4096
# Share of the linked sample pairs of a node that a split may separate: in a node of up to LARGE
# vectors, and above (more trees make up for it). Directions tried for each split.
TORN, TORN_LARGE, LARGE = 0.05, 0.15, 8192
TRIES = 8
# Trees are added until at most this share of pairs at the limit shares no leaf.
MISSED = 0.001
LEAST_TREES = 4
MOST_TREES = 48
# The trees are fitted on a sample of at most this many numbers, a crowded leaf's on so many vectors.
SAMPLE_VALUES = 1 << 20
LEAF_SAMPLE = 2048
# Sampled vectors that make a dense place.
DENSE = 8
# Vectors in a block; a task compares two blocks.
BLOCK = 2048
# Rows of a crowded leaf that one task takes through its tree.
SLICE = 100_000
# Leaves are compared in this many rounds, so that only a part of the copies is on disk at a time.
ROUNDS = 3


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1; dividing by the largest entry first keeps extreme numbers in range."""
    largest = np.abs(matrix).max(axis=1, keepdims=True, initial=0)
    scaled = matrix / np.where(largest > 0, largest, 1)
    norm = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
    return scaled / np.where(norm > 0, norm, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return unit_rows(flat.reshape(len(column), -1))


def direction(seed: int, number: int, d: int) -> np.ndarray:
    """A random unit vector that depends on two numbers only."""
    value = np.random.default_rng((seed & 0xFFFFFFFFFFFFFFFF, number)).standard_normal(d)
    return value / np.linalg.norm(value)


@dataclass
class Tree:
    """Split directions (by number), thresholds, margins and children; a child below 0 is leaf -1-k."""

    seed: int
    numbers: list[int] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)
    margins: list[float] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    _directions: np.ndarray | None = None

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs: every row with every leaf it reaches."""
        row, node = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
        if not self.children or not len(vectors):
            return row, node
        if self._directions is None:
            d = vectors.shape[1]
            self._directions = np.array([direction(self.seed, k, d) for k in self.numbers])
        thresholds, margins = np.array(self.thresholds), np.array(self.margins)
        children = np.array(self.children)
        rows, found = [], []
        while len(row):
            offset = np.einsum("ij,ij->i", vectors[row], self._directions[node]) - thresholds[node]
            left, right = offset < margins[node], offset >= -margins[node]
            to = np.concatenate((children[node[left], 0], children[node[right], 1]))
            row = np.concatenate((row[left], row[right]))
            done = to < 0
            rows.append(row[done])
            found.append(-1 - to[done])
            row, node = row[~done], to[~done]
        return np.concatenate(rows), np.concatenate(found)


def linked_pairs(vectors: np.ndarray, least: float, most: int = 1 << 16) -> np.ndarray:
    """Pairs of rows with a cosine of at least ``least``: all, or an even choice of about ``most``."""
    found = []
    for begin in range(0, len(vectors), 1024):
        i, j = np.nonzero(vectors[begin : begin + 1024] @ vectors.T >= least)
        own = i + begin < j
        found.append(np.stack((i[own] + begin, j[own]), axis=1))
        if sum(map(len, found)) > 4 * most:
            found = [np.concatenate(found)[::2]]
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pairs[:: max(1, -(-len(pairs) // most))]


def grow(sample: np.ndarray, expected: float, seed: int, pairs: np.ndarray) -> Tree:
    """A tree on a sample that stands for ``expected`` vectors, with some of its linked pairs."""
    tree = Tree(seed)
    scale = expected / max(len(sample), 1)
    leaves = number = 0
    waiting = [(np.arange(len(sample)), np.arange(len(pairs)), None)]
    inside = np.zeros((2, len(sample)), dtype=bool)
    while waiting:
        rows, own, place = waiting.pop()
        best = None
        if len(rows) * scale > LEAF and len(rows) >= 16:
            for _ in range(TRIES):
                value = sample[rows] @ direction(seed, number, sample.shape[1])
                middle = float(np.median(value))
                margin = float(np.quantile(np.abs(value - middle), SPILL))
                sides = value - middle < margin, value - middle >= -margin
                number += 1
                if max(sides[0].sum(), sides[1].sum()) > 0.9 * len(rows):
                    continue
                inside[:, rows] = sides
                a, b = pairs[own].T
                kept = [inside[s][a] & inside[s][b] for s in (0, 1)]
                inside[:, rows] = False
                torn = 1 - (kept[0] | kept[1]).mean() if len(own) else 0.0
                if best is None or torn < best[0]:
                    best = torn, number - 1, middle, margin, sides, kept
                if torn == 0:
                    break
        if best is None or best[0] > (TORN if len(rows) * scale <= LARGE else TORN_LARGE):
            if place:
                tree.children[place[0]][place[1]] = -1 - leaves
            leaves += 1
            continue
        _, chosen, middle, margin, sides, kept = best
        me = len(tree.children)
        if place:
            tree.children[place[0]][place[1]] = me
        tree.numbers.append(chosen)
        tree.thresholds.append(middle)
        tree.margins.append(margin)
        tree.children.append([0, 0])
        waiting += [(rows[sides[s]], own[kept[s]], (me, s)) for s in (0, 1)]
    return tree


def dense_balls(sample: np.ndarray, least: float) -> np.ndarray:
    """Centres of the places where at least ``DENSE`` sampled vectors lie within half the limit angle.

    There are at most a ``DENSE``-th as many as sampled vectors.
    """
    near = math.cos(math.acos(least) / 2 - 1e-6)
    crowd = np.zeros(len(sample), np.int64)
    for begin in range(0, len(sample), 1024):
        crowd[begin : begin + 1024] = (sample[begin : begin + 1024] @ sample.T >= least).sum(axis=1)
    free = np.ones(len(sample), dtype=bool)
    centres = []
    for i in np.argsort(-crowd, kind="stable"):
        if crowd[i] < DENSE:
            break
        if not free[i]:
            continue
        close = free & (sample @ sample[i] >= least)
        for _ in range(3):
            if close.any():
                centre = unit_rows(sample[close].mean(axis=0)[None, :])[0]
                close = free & (sample @ centre >= near)
        if close.sum() >= DENSE:
            centres.append(centre)
            free &= ~close
    return np.array(centres).reshape(-1, sample.shape[1])


def _probes(sample: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Sampled vectors, and for each a made partner whose cosine with it is ``least``."""
    random = np.random.default_rng(9)
    first = sample[: 1 << 12]
    away = random.standard_normal(first.shape)
    away = unit_rows(away - np.einsum("ij,ij->i", away, first)[:, None] * first)
    return first, least * first + math.sqrt(max(1 - least * least, 0)) * away


def plant(sample: np.ndarray, expected: float, least: float) -> list[Tree]:
    """Trees until the probes, and the linked pairs of the sample, share a leaf almost all."""
    if expected <= LEAF:
        return [Tree(0)]
    pairs = linked_pairs(sample, least)
    first, second = _probes(sample, least)
    probed = np.concatenate((first, sample[pairs[:, 0]], second, sample[pairs[:, 1]]))
    half = len(probed) // 2
    apart = np.ones(half, dtype=bool)
    forest: list[Tree] = []
    while len(forest) < MOST_TREES:
        tree = grow(sample, expected, len(forest), pairs)
        forest.append(tree)
        if not tree.children:
            break
        row, leaf = tree.leaves(probed)
        key = leaf * half + row % half
        same = np.intersect1d(key[row < half], key[row >= half])
        apart[same % half] = False
        if len(forest) >= LEAST_TREES and apart.mean() <= MISSED:
            break
    return forest


def _code(seed: int, leaf: np.ndarray) -> np.ndarray:
    """One number for a leaf of a tree."""
    x = leaf.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(30))) >> np.uint64(1)).astype(np.int64)


def _lists(row: np.ndarray, value: np.ndarray, n: int) -> pa.Array:
    order = np.argsort(row, kind="stable")
    ends = np.searchsorted(row[order], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(value[order]))


def _placed(classes: DataFrame, kind: str, forest: list[Tree], centres: np.ndarray, least: float):
    """Every class with its ball (-1: none), the foreign balls it may link into, and its leaves.

    Members of a ball have no leaves. Of two balls only members of the first
    visit the second, so a pair is met once.
    """
    held = classes.sparkSession.sparkContext.broadcast((forest, centres))
    limit = math.acos(least)
    within = math.cos(limit / 2 - 1e-6)
    reach = math.cos(min(1.5 * limit + 1e-6, math.pi))

    def run(batches):
        forest, centres = held.value
        for whole in batches:
            for begin in range(0, whole.num_rows, 8192):
                batch = whole.slice(begin, 8192)
                vectors = _matrix(batch.column("vector"))
                n = len(vectors)
                ball = np.full(n, -1, np.int64)
                visits = np.zeros((n, 0), dtype=bool)
                if len(centres):
                    cosine = vectors @ centres.T
                    nearest = cosine.argmax(axis=1)
                    ball = np.where(cosine[np.arange(n), nearest] >= within, nearest, -1)
                    visits = (cosine >= reach) & (np.arange(len(centres)) > ball[:, None])
                outside = np.flatnonzero(ball < 0)
                rows, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for tree in forest:
                    row, leaf = tree.leaves(vectors[outside])
                    rows.append(outside[row])
                    codes.append(_code(tree.seed, leaf))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(ball), _lists(*np.nonzero(visits), n),
                     _lists(np.concatenate(rows), np.concatenate(codes), n)],
                    ["id", "size", "vector", "ball", "visits", "leaves"],
                )

    kind = f"id bigint, size bigint, vector {kind}, ball bigint, visits array<bigint>, leaves array<bigint>"
    return classes.select("id", "size", "vector").mapInArrow(run, kind)


def _subtree(least: float):
    """The tree of one crowded leaf from a sample of its vectors, packed into arrays."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        leaf, n = group["leaf"][0].as_py(), group["n"][0].as_py()
        order = np.argsort(group["id"].to_numpy())
        sample = _matrix(group["vector"].chunk(0))[order]
        tree = grow(sample, n, leaf, linked_pairs(sample, least))
        if not tree.children:
            return pa.table({"leaf": pa.array([], pa.int64()), "numbers": pa.array([], pa.list_(pa.int64())),
                             "splits": pa.array([], pa.list_(pa.float64()))})
        children = [c for pair in tree.children for c in pair]
        return pa.table(
            {"leaf": pa.array([leaf], pa.int64()),
             "numbers": pa.array([[*tree.numbers, *children]], pa.list_(pa.int64())),
             "splits": pa.array([[*tree.thresholds, *tree.margins]], pa.list_(pa.float64()))}
        )

    return run


def _through_subtrees(batches):
    """Take sorted rows through the tree that comes first for their leaf: ``id, leaf, into``."""
    tree, at = Tree(0), None
    for batch in batches:
        if not batch.num_rows:
            continue
        leaf, part = batch.column("leaf").to_numpy(), batch.column("slice").to_numpy()
        new = (leaf[1:] != leaf[:-1]) | (part[1:] != part[:-1])
        edges = np.flatnonzero(np.concatenate(([True], new, [True])))
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            part = batch.slice(begin, end - begin)
            if part.column("id")[0].as_py() is None:
                numbers, splits = part.column("numbers")[0].as_py(), part.column("splits")[0].as_py()
                n, at = len(splits) // 2, int(leaf[begin])
                children = [numbers[i : i + 2] for i in range(n, len(numbers), 2)]
                tree = Tree(at, numbers[:n], splits[:n], splits[n:], children)
                part = part.slice(1)
            if not part.num_rows or at != leaf[begin]:
                continue
            row, into = tree.leaves(_matrix(part.column("vector")))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("leaf"), _lists(row, _code(at, into + 1), part.num_rows)],
                ["id", "leaf", "into"],
            )


def _split_crowded(placed: DataFrame, kind: str, least: float) -> DataFrame:
    """Split crowded leaves with trees fitted on a sample of their own, until none can be.

    Rows of a leaf are dealt out in slices; each slice gets the leaf's tree as
    its first row, so a task holds one tree and a batch of rows.
    """
    tried = None
    while True:
        counts = (
            placed.select(F.explode("leaves").alias("leaf")).groupBy("leaf")
            .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED)
        )
        if tried is not None:
            counts = counts.join(tried, "leaf", "left_anti")
        crowded = store(counts, "crowded")
        if not crowded.rows:
            return placed
        tried = crowded.df.select("leaf") if tried is None else tried.union(crowded.df.select("leaf"))
        rows = placed.select("id", "vector", F.explode("leaves").alias("leaf")).join(crowded.df, "leaf")
        share = F.pmod(F.xxhash64("id", "leaf"), F.lit(1 << 30)) / (1 << 30)
        sampled = rows.where(share * F.col("n") < LEAF_SAMPLE)
        trees = store(
            sampled.groupBy("leaf").applyInArrow(
                _subtree(least), "leaf bigint, numbers array<bigint>, splits array<double>"
            ), "leaf-trees",
        )
        if not trees.rows:
            return placed
        slices = crowded.df.select("leaf", F.ceil(F.col("n") / SLICE).alias("slices"))
        heads = trees.df.join(slices, "leaf").select(
            F.lit(None).cast("bigint").alias("id"), F.lit(None).cast(kind).alias("vector"), "leaf",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"),
            "numbers", "splits",
        )
        split = rows.join(trees.df.select("leaf"), "leaf").join(slices, "leaf").select(
            "id", "vector", "leaf", F.pmod(F.xxhash64("id"), F.col("slices")).alias("slice"),
            F.lit(None).cast("array<bigint>").alias("numbers"),
            F.lit(None).cast("array<double>").alias("splits"),
        )
        dealt = (
            heads.unionByName(split).repartition("leaf", "slice")
            .sortWithinPartitions("leaf", "slice", F.col("id").asc_nulls_first())
        )
        moved = dealt.mapInArrow(_through_subtrees, "id bigint, leaf bigint, into array<bigint>")
        # A vector is in few leaves, so these lists are short.
        new = moved.groupBy("id").agg(
            F.collect_set("leaf").alias("gone"), F.flatten(F.collect_list("into")).alias("come")
        )
        leaves = F.when(
            F.col("gone").isNotNull(),
            F.array_union(F.array_except("leaves", "gone"), "come"),
        ).otherwise(F.col("leaves"))
        placed = store(
            placed.join(new, "id", "left").withColumn("leaves", leaves).drop("gone", "come"), "placed"
        ).df


def _tied(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest row each row is tied to by the links (i, j)."""
    root = np.arange(n)
    while True:
        before = root.copy()
        np.minimum.at(root, i, root[j])
        np.minimum.at(root, j, root[i])
        root = root[root]
        if (root == before).all():
            return root


def _compare(least: float, leafwise: bool):
    """Compare two blocks. In a leaf, a pair counts only if it shares no leaf of a smaller number."""

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        ids, sizes = group["id"].to_numpy(), group["size"].to_numpy()
        side = group["side"].to_numpy()
        vectors = _matrix(group["vector"].chunk(0))
        first = np.flatnonzero(side == 0)
        alone = leafwise and group["low"][0].as_py() == group["high"][0].as_py()
        second = first if alone else np.flatnonzero(side == 1)
        near = vectors[first] @ vectors[second].T >= least
        if first is second:
            near = np.triu(near, 1)
        up, down = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        near = near[np.ix_(up, down)]
        first, second = first[up], second[down]
        if leafwise and near.any():
            leaf = group["leaf"][0].as_py()
            lists = group["leaves"].chunk(0)
            parts = [lists.take(pa.array(r)) for r in (first, second)]
            codes = [p.flatten().to_numpy() for p in parts]
            owner = [np.repeat(np.arange(len(p)), np.diff(p.offsets.to_numpy())) for p in parts]
            smaller = [c < leaf for c in codes]
            codes = [c[s] for c, s in zip(codes, smaller, strict=True)]
            owner = [o[s] for o, s in zip(owner, smaller, strict=True)]
            both = np.intersect1d(*codes)
            for begin in range(0, len(both), 4096):
                some = both[begin : begin + 4096]
                marks = []
                for c, o, rows in zip(codes, owner, near.shape, strict=True):
                    mine = np.isin(c, some)
                    mark = np.zeros((rows, len(some)), dtype=np.float32)
                    mark[o[mine], np.searchsorted(some, c[mine])] = 1
                    marks.append(mark)
                near &= ~(marks[0] @ marks[1].T > 0)
        count = np.zeros(len(ids), dtype=np.int64)
        np.add.at(count, first, near @ sizes[second])
        np.add.at(count, second, near.T @ sizes[first])
        i, j = np.nonzero(near)
        root = _tied(first[i], second[j], len(ids))
        linked = np.flatnonzero(count)
        return pa.table(
            {"id": pa.array(ids[linked]), "links": pa.array(count[linked]),
             "head": pa.array(ids[root[linked]])}
        )

    return run


_FOUND = "id bigint, links bigint, head bigint"


def _blocks(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """How many blocks the rows of a key make."""
    return rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias(name))


def _upto(name: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(name) - 1))


def _in_leaves(placed: DataFrame, least: float) -> list[DataFrame]:
    """Links between vectors outside the balls, found within the leaves."""
    found = []
    for number in range(ROUNDS):
        ids = placed.select("id", F.explode("leaves").alias("leaf")).where(
            F.pmod("leaf", F.lit(ROUNDS)) == number
        )
        blocks = _blocks(ids, ["leaf"], "blocks")
        own = F.pmod(F.xxhash64("id"), F.col("blocks"))
        pairs = (
            placed.select("id", "size", "vector", "leaves", F.explode("leaves").alias("leaf"))
            .where(F.pmod("leaf", F.lit(ROUNDS)) == number)
            .join(blocks, "leaf").withColumn("own", own).withColumn("other", _upto("blocks"))
            .select(
                "leaf", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                F.when(F.col("own") == F.least("own", "other"), 0).otherwise(1).alias("side"),
                "id", "size", "vector", "leaves",
            )
        )
        part = pairs.groupBy("leaf", "low", "high").applyInArrow(_compare(least, True), _FOUND)
        found.append(store(part, "leaf-links").df)
    return found


def _into_balls(placed: DataFrame, least: float) -> DataFrame:
    """Links between the members of a ball and vectors outside it that are near enough."""
    visitors = placed.select("id", "size", "vector", F.explode("visits").alias("ball"))
    # At most one row for each ball, and balls are bounded by the sample.
    guests = store(_blocks(visitors, ["ball"], "guests"), "ball-guests").df
    visited = placed.where("ball >= 0").join(F.broadcast(guests), "ball", "left_semi")
    hosts = _blocks(visited, ["ball"], "hosts")
    sized = F.broadcast(store(guests.join(hosts, "ball"), "ball-blocks").df)
    members = visited.join(sized, "ball").select(
        "ball", F.pmod(F.xxhash64("id"), F.col("hosts")).alias("host"), _upto("guests").alias("guest"),
        F.lit(0).alias("side"), "id", "size", "vector",
    )
    outside = visitors.join(sized, "ball").select(
        "ball", _upto("hosts").alias("host"), F.pmod(F.xxhash64("id"), F.col("guests")).alias("guest"),
        F.lit(1).alias("side"), "id", "size", "vector",
    )
    return members.unionByName(outside).groupBy("ball", "host", "guest").applyInArrow(
        _compare(least, False), _FOUND
    )


def _in_balls(placed: DataFrame) -> DataFrame:
    """Links within the balls, which are counted and not compared."""
    members = placed.where("ball >= 0")
    balls = members.groupBy("ball").agg(F.sum("size").alias("all"), F.min("id").alias("head"))
    # At most one row for each ball, and balls are bounded by the sample.
    return members.join(F.broadcast(balls), "ball").select(
        "id", (F.col("all") - F.col("size")).alias("links"), "head"
    )


def _usable(embedding: str):
    """A vector with at least one number, all finite, not all zero."""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(embedding).isNotNull() & ~odd & F.exists(embedding, lambda x: x != 0)


def near_vectors(vectors: DataFrame, least: float = 0.9) -> DataFrame:
    """Links between vectors whose cosine is at least ``least`` (above 0, below 1).

    Returns one row for each row of ``vectors``: ``vec_id, n_links`` (other
    vectors linked directly), ``component_id`` (smallest vec_id reachable) and
    ``kept`` (vec_id = component_id). Equal vectors form one class and link with
    each other. Vectors that are null, empty, zero or hold null or non-finite
    numbers link with nothing; so do null ids (component null, kept true).
    Vectors of different length are never compared. Other columns are not read.
    Very large and very small numbers are scaled before they are squared.

    Cosines are exact, in doubles. Links with a member of a ball are all found.
    Of other links, only those whose ends share no leaf are missed: at most
    ``MISSED`` (0.1 %) of pairs exactly at the limit by the measure of ``plant``,
    fewer of closer ones. Splits of crowded leaves, which only tables of many
    millions of vectors have, add to that.
    """
    kind = dict(vectors.dtypes)["embedding"]
    kind = "array<float>" if kind == "array<float>" else "array<double>"
    read = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast(kind).alias("vector")
    )
    good = read.where(_usable("vector") & F.col("vec_id").isNotNull())
    classes = store(
        good.groupBy("vector").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("size")),
        "vector-classes",
    ).df
    found = []
    for row in classes.groupBy(F.size("vector").alias("d")).count().orderBy("d").collect():
        own = classes.where(F.size("vector") == row["d"])
        wanted = max(64, SAMPLE_VALUES // row["d"])
        share = F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1 << 30)) / (1 << 30)
        picked = own.where(share * row["count"] < wanted).orderBy("id").limit(2 * wanted)
        sample = _matrix(picked.select("vector").toArrow()["vector"].combine_chunks())
        centres = dense_balls(sample, least)
        free = sample
        if len(centres):
            free = sample[(sample @ centres.T).max(axis=1) < math.cos(math.acos(least) / 2 - 1e-6)]
        forest = plant(free, row["count"] * len(free) / max(len(sample), 1), least)
        placed = store(_placed(own, kind, forest, centres, least), "placed").df
        placed = _split_crowded(placed, kind, least)
        found += [*_in_leaves(placed, least), _into_balls(placed, least), _in_balls(placed)]
    if not found:
        return read.select(
            "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    every = found[0]
    for part in found[1:]:
        every = every.unionByName(part)
    every = store(every, "vector-links").df
    links = every.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(every.select("id", "head"))
    heads = (
        classes.join(links, "id", "left")
        .join(groups.select(F.col("node").alias("id"), "component"), "id", "left")
        .select(
            F.col("vector").alias("same"), F.col("size"),
            F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce("component", "id").alias("component"),
        )
    )
    joined = read.join(heads, (F.col("vector") == F.col("same")) & F.col("vec_id").isNotNull(), "left")
    component = F.coalesce("component", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("size") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


# All pairs of the table, then components by repeated spreading.
SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reached AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION
  SELECT links.b, reached.root FROM reached JOIN links ON links.a = reached.node
  WHERE reached.root < links.b),
groups AS (SELECT node, min(root) AS component_id FROM reached GROUP BY node),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, g.component_id, e.vec_id = g.component_id AS kept
FROM embeddings e JOIN groups g ON g.node = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id"""
