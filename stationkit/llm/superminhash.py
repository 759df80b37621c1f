"""MinHash near-duplicates with SuperMinHash signatures.

Every shingle of a text walks through a random permutation of the signature
slots and offers step + random fraction to the slot it stands on. Because a
shingle visits each slot once, the slots of one signature are negatively
correlated, which lowers the variance of the similarity estimate. The walk stops
early: once all slots of a text hold a value below the next step, nothing later
can win.

Signatures are banded. Texts in one bucket are first compared with one member of
it, then, only where several groups remain in a bucket, with every member that
could still be similar. Each comparison is made on the full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.llm.arrays import blocks, long_lists, mix, salts, shingles, split_words, text_bytes
from stationkit.llm.components import components
from stationkit.plans.stored import store

SLOTS = 128
# A list of document numbers up to this many rows (8 MB) is broadcast, a longer one joined.
BROADCAST_ROWS = 1 << 20
# Shingles worked on at once, for memory.
_PART = 1 << 17
# Texts in a block of a cluster, and columns of a matrix, that one task compares at once.
_BLOCK = 256
_COLUMNS = 1 << 13
_HALF = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def band_rows(threshold: float, slots: int = SLOTS, miss: float = 1e-6) -> int:
    """Most rows for a band with which a pair at the threshold is missed in at most ``miss``."""
    rows = 1
    while rows < slots and (1 - threshold ** (rows + 1)) ** (slots // (rows + 1)) <= miss:
        rows += 1
    return rows


def _draw(hashes: np.ndarray, step: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Random fraction (32 bits) and a place from ``step`` to the last slot."""
    x = mix(hashes + salts(slots, 3)[step])
    place = np.uint64(step) + (((x >> _HALF) * np.uint64(slots - step)) >> _HALF)
    return x & _LOW, place.astype(np.int64)


def superminhash(
    hashes: np.ndarray, owner: np.ndarray, texts: int, slots: int = SLOTS
) -> np.ndarray:
    """Signatures (texts x slots) of sets: element hashes and the text each belongs to."""
    signature = np.full(texts * slots, np.iinfo(np.uint64).max, dtype=np.uint64)
    table = signature.reshape(texts, slots)
    order: np.ndarray | None = None
    first = None
    for step in range(slots):
        if not len(hashes):
            break
        value, place = _draw(hashes, step, slots)
        if step == 0:
            slot = first = place
        elif step == 1:
            slot = np.where(place == first, 0, place)
        else:
            row = np.arange(len(hashes))
            if order is None:
                order = np.tile(np.arange(slots, dtype=np.uint8), (len(hashes), 1))
                for j, k in enumerate(earlier):
                    order[row, k], order[:, j] = order[:, j].copy(), order[row, k]
            slot = order[row, place].astype(np.int64)
            order[row, place] = order[:, step]
        np.minimum.at(signature, owner * slots + slot, value + (np.uint64(step) << _HALF))
        if step == 0:
            earlier = [place]
        elif step == 1:
            earlier.append(place)
        open_texts = table.max(axis=1) >= np.uint64(step + 1) << _HALF
        left = open_texts[owner]
        if not left.all():
            hashes, owner = hashes[left], owner[left]
            first = first[left]
            if step <= 1:
                earlier = [k[left] for k in earlier]
            if order is not None:
                order = order[left]
    return table


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    begin = held = 0
    for i, n in enumerate(sizes):
        if i > begin and held + n > _PART:
            yield begin, i
            begin, held = i, 0
        held += n
    yield begin, len(sizes)


def _band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = signature.shape[1] // rows
    cut = signature[:, : bands * rows].reshape(len(signature), bands, rows)
    return mix((mix(cut) * salts(rows, 4)).sum(axis=2, dtype=np.uint64) + salts(bands, 5))


def signatures(docs: DataFrame, width: int, rows: int, slots: int = SLOTS) -> DataFrame:
    """Columns ``doc_id, n_shingles, key1, key2, bands``.

    The keys are a 128-bit hash of the whole shingle set. A text without words
    has no bands.
    """

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for begin, end in blocks(texts):
                found, sizes = shingles(split_words(texts[begin:end]), width)
                owner = np.repeat(np.arange(end - begin), sizes)
                edges = np.concatenate(([0], np.cumsum(sizes)))
                keys = np.zeros((end - begin, slots // rows), np.uint64)
                for a, b in _parts(sizes):
                    own = slice(edges[a], edges[b])
                    signed = superminhash(found[own], owner[own] - a, b - a, slots)
                    keys[a:b] = _band_keys(signed, rows)
                full = sizes > 0
                seals = np.zeros((2, end - begin), np.uint64)
                for seal, salt in zip(seals, salts(2, 6), strict=True):
                    if len(found):
                        seal[full] = np.add.reduceat(mix(found ^ salt), edges[:-1][full])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, end - begin),
                        pa.array(sizes),
                        pa.array(seals[0].view(np.int64)),
                        pa.array(seals[1].view(np.int64)),
                        long_lists(keys[full].ravel(), full * (slots // rows)),
                    ],
                    ["doc_id", "n_shingles", "key1", "key2", "bands"],
                )

    kind = "doc_id bigint, n_shingles bigint, key1 bigint, key2 bigint, bands array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, kind)


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """Columns ``doc_id, items``: the sorted distinct shingle hashes of each text."""

    def run(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for begin, end in blocks(texts):
                found, sizes = shingles(split_words(texts[begin:end]), width)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(begin, end - begin), long_lists(found, sizes)],
                    ["doc_id", "items"],
                )

    kind = "doc_id bigint, items array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, kind)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose sets have the wanted similarity, in whole numbers."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    either = F.size("x") + F.size("y") - both
    return pairs.join(left, "a").join(right, "b").where(both * 100 >= either * percent).select("a", "b")


def _only(docs: DataFrame, ids: DataFrame, rows: int, how: str = "left_semi") -> DataFrame:
    """Documents in a stored list of numbers (or not in it), broadcasting only a short list."""
    return docs.join(F.broadcast(ids) if rows <= BROADCAST_ROWS else ids, "doc_id", how)


def _second_look(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between texts of one bucket that still lie in different groups.

    ``members`` has ``key, id, n, component`` of all buckets with several groups.
    A pair can share only shingles that at least two of these texts have. If s
    of the n shingles of a text are of that kind, its similarity with a text of
    m shingles is at most s / (n + m - s), and m is at least the threshold times
    n and the smallest set in the bucket. Texts below the threshold are done.
    That ends the large buckets of texts that share one passage, and of loose
    copies, without looking at pairs. The few texts left are compared in blocks.
    """
    ids = members.select(F.col("id").alias("doc_id")).distinct()
    items = sets.join(ids, "doc_id", "left_semi").select(
        "doc_id", F.explode("items").alias("item")
    )
    shared = items.groupBy("item").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    bound = (
        items.join(shared.select("item"), "item", "left_semi")
        .groupBy("doc_id").agg(F.count(F.lit(1)).alias("s"))
        .select(F.col("doc_id").alias("id"), "s")
    )
    rows = members.join(bound, "id")
    least = rows.groupBy("key").agg(F.min("n").alias("m"))
    m = F.greatest(F.col("m"), F.ceil(F.col("n") * percent / 100))
    alive = rows.join(least, "key").where(
        F.col("s") * 100 >= (F.col("n") + m - F.col("s")) * percent
    )
    alive = store(alive.select("key", "id", "n", "s", "component"), "alive").df
    mixed = (
        alive.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high").select("key")
    )
    open_rows = alive.join(mixed, "key", "left_semi")
    heads = open_rows.groupBy("key").agg(F.min("id").alias("head"))
    near = components(open_rows.join(heads, "key").select("id", "head"))
    texts = (
        open_rows.select("id", "component").distinct()
        .join(near.select(F.col("node").alias("id"), F.col("component").alias("cluster")), "id")
        .join(sets.select(F.col("doc_id").alias("id"), "items"), "id")
    )
    return _compared_in_blocks(texts, percent)


def _compared_in_blocks(texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different components of a cluster, enough to join them.

    A cluster is dealt out in blocks of about ``_BLOCK`` texts, and each pair of
    blocks is compared as one matrix product. Only a spanning forest of the
    links leaves a task, never all pairs.
    """
    sizes = texts.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).alias("blocks"))
    dealt = texts.join(sizes, "cluster").withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("blocks"))
    )
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        "id", "component", "items",
    )

    def compare(group: pa.Table) -> pa.Table:
        rows = group.select(["id", "component", "items"]).combine_chunks().to_pydict()
        ids, items = rows["id"], [np.asarray(x, dtype=np.int64) for x in rows["items"]]
        n = np.array([len(x) for x in items])
        _, column = np.unique(np.concatenate(items), return_inverse=True)
        row = np.repeat(np.arange(len(ids)), n)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(ids), len(ids)), dtype=np.float32)
        for begin in range(0, int(column[-1]) + 1, _COLUMNS):
            a, b = np.searchsorted(column, [begin, begin + _COLUMNS])
            part = np.zeros((len(ids), _COLUMNS), dtype=np.float32)
            part[row[a:b], column[a:b] - begin] = 1
            both += part @ part.T
        linked = both * 100 >= (n[:, None] + n[None, :] - both) * percent
        root = {c: c for c in rows["component"]}

        def top(c):
            while root[c] != c:
                c = root[c]
            return c

        out = []
        for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
            x, y = top(rows["component"][i]), top(rows["component"][j])
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((ids[i], ids[j]))
        return pa.table(
            {"a": pa.array([a for a, _ in out], pa.int64()),
             "b": pa.array([b for _, b in out], pa.int64())}
        )

    return paired.groupBy("cluster", "low", "high").applyInArrow(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, slots: int = SLOTS
) -> DataFrame:
    """Groups of near-duplicate documents.

    Words are runs without white space, lower-cased in A-Z; the set of a text is
    its distinct shingles of ``width`` words (all words, if fewer). Two documents
    are linked if 100 * intersection >= ``percent`` * union. Returns one row for
    each row of ``docs``: ``doc_id, n_shingles, component_id`` (smallest doc_id
    reachable, itself included) and ``kept`` (doc_id = component_id). Documents
    with equal sets are one class, of which one row is compared.

    Null or empty texts have no shingles and link with nothing. A null doc_id
    links with nothing and gives a null component and kept = true. Rows that
    repeat a doc_id count as one document with the links of each of them. Other
    columns are not read. A pair at the threshold stays unfound with a chance
    below 1e-6, as ``band_rows`` computes it; pairs found are exact.
    """
    signed = store(signatures(docs, width, band_rows(percent / 100, slots), slots), "signed").df
    real = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    class_key = ["n_shingles", "key1", "key2"]
    first = F.min(F.struct("doc_id", "bands"))
    classes = real.groupBy(*class_key).agg(first.alias("f"))
    classes = store(classes.select(*class_key, "f.doc_id", "f.bands"), "classes").df

    rows = classes.select(
        F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key")
    )
    crowded = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"), F.min("id").alias("head")
    ).where("size > 1")
    members = store(rows.join(crowded.select("key", "head"), "key"), "buckets").df
    pairs = members.where("id > head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    pairs = store(pairs.distinct(), "pairs").df

    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    wanted = store(ids, "candidates")
    sets = store(
        shingle_sets(_only(docs.where("doc_id IS NOT NULL"), wanted.df, wanted.rows), width)
        .dropDuplicates(), "sets",
    ).df
    links = store(_verified(pairs, sets, percent).distinct(), "verified").df

    groups = components(links).select(F.col("node").alias("id"), "component")
    held = members.join(groups, "id", "left").select(
        "key", "id", "n", F.coalesce("component", "id").alias("component")
    )
    held = store(held, "held").df
    mixed = (
        held.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high").select("key")
    )
    again = _second_look(store(held.join(mixed, "key", "left_semi"), "mixed").df, sets, percent)
    links = links.union(again)
    # Rows that repeat a doc_id tie the classes they are in.
    same = (
        real.join(classes.select(*class_key, F.col("doc_id").alias("b")), class_key)
        .where("doc_id != b").select(F.col("doc_id").alias("a"), "b")
    )
    twice = real.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    same = same.join(twice.select(F.col("doc_id").alias("a")), "a", "left_semi")
    groups = components(links.union(same)).select(F.col("node").alias("head"), "component")

    heads = (
        classes.select(*class_key, F.col("doc_id").alias("head")).join(groups, "head", "left")
        .select(*class_key, F.coalesce("component", "head").alias("component_id"))
    )
    joined = signed.join(
        heads,
        on=[signed[c] == heads[c] for c in class_key] + [signed["doc_id"].isNotNull()],
        how="left",
    )
    component = F.coalesce(heads["component_id"], signed["doc_id"])
    return joined.select(
        signed["doc_id"], signed["n_shingles"], component.alias("component_id"),
        signed["doc_id"].eqNullSafe(component).alias("kept"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near-duplicates (smallest doc_id), with all columns."""
    found = near_duplicates(docs, width, percent)
    gone = store(found.where("NOT kept").select("doc_id").distinct(), "duplicates")
    return _only(docs, gone.df, gone.rows, "left_anti")
