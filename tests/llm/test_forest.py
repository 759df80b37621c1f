"""Near-duplicate vectors: exact links of large dense groups, sparse recall, odd and extreme input."""

import math

import numpy as np
import pytest
from stationkit.llm import forest

KIND = "vec_id bigint, embedding array<double>, links string, head string, leaf string, size string"


def brute(matrix, least=0.9):
    """Links and smallest reachable row of every row, by all cosines in blocks."""
    m = forest.unit_rows(matrix)
    links, root = np.zeros(len(m), np.int64), np.arange(len(m))
    near = [np.nonzero(m[b : b + 2000] @ m.T >= least) for b in range(0, len(m), 2000)]
    for b, (i, j) in enumerate(near):
        own = i + 2000 * b != j
        np.add.at(links, i[own] + 2000 * b, 1)
    while True:
        before = root.copy()
        for b, (i, j) in enumerate(near):
            np.minimum.at(root, i + 2000 * b, root[j])
        root = root[root]
        if (root == before).all():
            return links, root


def found(spark, matrix, ids=None, **options):
    rows = [(int(i), v.tolist(), "a", "b", "c", "d") for i, v in enumerate(matrix)]
    table = spark.createDataFrame(rows, KIND).repartition(6)
    got = forest.near_vectors(table, **options).toPandas().set_index("vec_id").sort_index()
    assert len(got) == len(matrix) and (got.kept == (got.index == got.component_id)).all()
    return got.n_links.to_numpy(), got.component_id.to_numpy()


@pytest.mark.parametrize("group,spread", [(500, 0.05), (5_000, 0.05), (5_000, 0.1), (500, 0.2)])
def test_dense_groups_lose_nothing(spark, group, spread):
    """Background of random vectors, one large group and some pairs; all links against brute force."""
    random = np.random.default_rng(group)
    base = random.normal(size=(4_000, 64))
    centre = random.normal(size=64)
    near = centre + spread * np.linalg.norm(centre) * random.normal(size=(group, 64)) / 8 * 2
    pairs = base[:200] + 0.2 * random.normal(size=(200, 64))
    matrix = random.permutation(np.concatenate((base, near, pairs)))
    links, root = brute(matrix)
    got, component = found(spark, matrix)
    assert (got <= links).all() and got.sum() >= 0.999 * links.sum()
    assert (component == root).mean() > 0.999


def test_very_large_group(spark):
    random = np.random.default_rng(1)
    near = random.normal(size=16) + 0.1 * random.normal(size=(50_000, 16))
    got, component = found(spark, near.astype(np.float32).astype(np.float64))
    assert (got == 49_999).mean() > 0.99 and (component == 0).mean() > 0.99


def test_one_dense_direction(spark):
    random = np.random.default_rng(2)
    matrix = np.ones(8) + 0.25 * random.normal(size=(3_000, 8))
    links, root = brute(matrix)
    got, component = found(spark, matrix)
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum()


def test_sparse_recall(spark):
    """Pairs exactly at and just above the limit, in a table of several levels of splits."""
    random = np.random.default_rng(3)
    base = forest.unit_rows(random.normal(size=(8_000, 32)))
    away = random.normal(size=base.shape)
    away = forest.unit_rows(away - (away * base).sum(1)[:, None] * base)
    cosine = random.uniform(0.9001, 0.97, (8_000, 1))
    partner = cosine * base + np.sqrt(1 - cosine**2) * away
    links, _ = brute(np.concatenate((base, partner)))
    got, _ = found(spark, np.concatenate((base, partner)))
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum()


def test_crowded_leaves_and_small_blocks(spark, monkeypatch):
    """A tiny sample, so that leaves are split on over tables; blocks, slices and rounds in use."""
    for name, value in (("SAMPLE_VALUES", 64), ("CROWDED", 300), ("LEAF", 100), ("BLOCK", 64), ("SLICE", 90)):
        monkeypatch.setattr(forest, name, value)
    random = np.random.default_rng(6)
    base = random.normal(size=(1_500, 16))
    matrix = np.concatenate((base, base * 1.5, base[:300] + 0.05 * random.normal(size=(300, 16)),
                             random.normal(size=16) + 0.05 * random.normal(size=(400, 16))))
    links, root = brute(matrix)
    got, component = found(spark, matrix)
    assert (got <= links).all() and got.sum() >= 0.99 * links.sum()
    assert (component == root).mean() > 0.99


def test_extreme_numbers_ties_and_lengths(spark):
    rows = [(1, [1e-200] * 4), (2, [3e-200] * 4), (3, [1e200] * 4), (4, [2e200] * 4), (5, [5e-324, 0, 0, 0]),
            (6, [7.0, 0, 0, 0]), (6, [7.0, 0, 0, 0]), (8, [-1.0] * 4), (9, [0.0, -0.0, 0, 0]), (10, None), (11, []),
            (12, [math.nan, 1, 1, 1]), (13, [None, 1.0, 1, 1]), (14, [1.0] * 3), (15, [2.0] * 3),
            (None, [1.0] * 4), (16, [1.0] * 100_000), (17, [1.0] * 99_999 + [1.5]), (18, [math.inf, 1, 1, 1])]
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "", "", "", "") for i, v in rows]
    got = [(r.vec_id, r.n_links, r.component_id, r.kept)
           for r in forest.near_vectors(spark.createDataFrame(rows, KIND)).collect()]
    assert sorted(got, key=str) == sorted([
        (1, 3, 1, True), (2, 3, 1, False), (3, 3, 1, False), (4, 3, 1, False), (5, 2, 5, True),
        (6, 2, 5, False), (6, 2, 5, False), (8, 0, 8, True), (9, 0, 9, True), (10, 0, 10, True),
        (11, 0, 11, True), (12, 0, 12, True), (13, 0, 13, True), (14, 1, 14, True), (15, 1, 14, False),
        (None, 0, None, True), (16, 1, 16, True), (17, 1, 16, False), (18, 0, 18, True)], key=str)
    assert forest.near_vectors(spark.createDataFrame([], KIND)).count() == 0


def test_trees_meet_the_stated_recall():
    """Fresh pairs at the limit, not those the trees were measured with."""
    random = np.random.default_rng(8)
    base = forest.unit_rows(random.normal(size=(6_000, 64)))
    trees = forest.plant(base, 6_000, 0.9)
    away = random.normal(size=base.shape)
    away = forest.unit_rows(away - (away * base).sum(1)[:, None] * base)
    partner = 0.9 * base + math.sqrt(0.19) * away
    apart = np.ones(6_000, dtype=bool)
    for tree in trees:
        one, two = ({*zip(*(x.tolist() for x in tree.leaves(v)), strict=True)} for v in (base, partner))
        apart[[row for row, _ in one & two]] = False
    assert apart.mean() < 0.005


def test_sql_meets_links(spark, tmp_path):
    """The query's SQL on a table with groups, copies and odd vectors, which the given tables lack."""
    import oracle
    from stationkit.llm.queries import QUERIES

    random = np.random.default_rng(12)
    base = random.normal(size=(300, 24))
    matrix = np.concatenate((base, base[:80] + 0.15 * random.normal(size=(80, 24)), base[:9],
                             random.normal(size=24) + 0.1 * random.normal(size=(60, 24))))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(matrix)] + [(900, None, 1), (901, [0.0] * 24, 1)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    table.coalesce(1).write.parquet(str(tmp_path / "parts"))
    next((tmp_path / "parts").glob("*.parquet")).rename(tmp_path / "embeddings.parquet")
    got = oracle.actual(QUERIES["op9_projection_forest"](spark, str(tmp_path)))
    assert got == oracle.expected(oracle.connect(str(tmp_path)), forest.SQL)
    assert sum(int(r[2]) for r in got[1]) > 2_000
