"""Version differences, triangles, hops against plain loops, with hubs, copies and long chains."""

import itertools
import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from stationkit.operators import paths, versions

KIND = "a string, b double, c int"


def test_snapshot_diff(spark):
    rnd = random.Random(2)
    row = lambda: (rnd.choice(["x", "y", None]), rnd.choice([1.0, 2.5, None]), rnd.randrange(4))
    before = [row() for _ in range(300)] + [("hot", 1.0, 1)] * 500
    after = before[40:] + [row() for _ in range(60)] + [("new", None, None)] * 3
    old, new = Counter(before), Counter(after)
    expected = sorted(
        ((*r, old[r], new[r], "added" if not old[r] else "removed" if not new[r] else
          "more" if new[r] > old[r] else "fewer")
         for r in {*old, *new} if old[r] != new[r]), key=str,
    )
    got = versions.snapshot_diff(
        spark.createDataFrame(before, KIND), spark.createDataFrame(after, KIND).select("c", "a", "b").repartition(7)
    )
    assert got.columns == ["a", "b", "c", "copies_before", "copies_after", "change"]
    assert sorted(map(tuple, got.collect()), key=str) == expected


def test_equal_versions_are_not_shuffled_row_by_row(spark):
    df = spark.range(5_000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).alias("b"))
    assert versions.changed_parts(df, df.repartition(9)).count() == 0
    assert versions.snapshot_diff(df, df).count() == 0
    one = df.withColumn("b", F.when(F.col("a") == "77", 99).otherwise(F.col("b")))
    assert versions.changed_parts(df, one).count() <= 2
    assert versions.snapshot_diff(df, one).count() == 2
    moved = spark.createDataFrame([(None, "x")], "a string, b string")
    swapped = spark.createDataFrame([("x", None)], "a string, b string")
    assert versions.snapshot_diff(moved, swapped).count() == 2
    assert {r.change for r in versions.snapshot_diff(moved.limit(0), moved).collect()} == {"added"}
    with pytest.raises(ValueError, match="c"):
        versions.snapshot_diff(df, df.withColumnRenamed("b", "c"))


def graph(spark, edges):
    return spark.createDataFrame(edges, "src bigint, dst bigint, extra string")


def test_triangles(spark):
    rnd = random.Random(3)
    pairs = {tuple(sorted(rnd.sample(range(40), 2))) for _ in range(160)}
    hub = {(v, 99) for v in range(40)}
    near = {v: set() for v in [*range(40), 99]}
    for a, b in pairs | hub:
        near[a].add(b)
        near[b].add(a)
    odd = [(5, 5, ""), (None, 3, ""), (7, None, "")]
    rows = [(a, b, "") for a, b in pairs] + [(b, a, "x") for a, b in hub] + [(a, b, "") for a, b in hub] + odd
    got = {r.vertex: (r.degree, r.triangles, r.clustering) for r in paths.triangles(graph(spark, rows)).collect()}
    for v, own in near.items():
        n = sum(b in near[a] for a, b in itertools.combinations(own, 2))
        share = n / (len(own) * (len(own) - 1) / 2) if len(own) > 1 else None
        assert got[v] == (len(own), n, pytest.approx(share) if share is not None else None)
    assert len(got) == len(near)


def test_a_hub_makes_no_wedges(spark):
    """A star of 2,000 rays and one triangle at its centre: the centre has no edge going out."""
    rows = [(0, i, "") for i in range(1, 2_001)] + [(1, 2, "")]
    directed = paths.upward(graph(spark, rows))
    assert directed.groupBy("low").count().agg(F.max("count")).first()[0] <= 2
    got = paths.triangles(graph(spark, rows)).where("triangles > 0")
    assert sorted((r.vertex, r.triangles) for r in got.collect()) == [(0, 1), (1, 1), (2, 1)]
    assert paths.triangles(graph(spark, [])).count() == 0


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_triangles_in_groups_of_colours(spark, monkeypatch, kind):
    """Paths in small parts and many groups, each triangle counted in one; only edges cross the network."""
    monkeypatch.setattr(paths, "PATHS_AT_ONCE", 5)
    monkeypatch.setattr(paths, "GROUP_EDGES", 10)
    n = 14
    whole = spark.createDataFrame([(a, b) for a in range(n) for b in range(a)], "src bigint, dst bigint")
    found = paths.triangles(whole.select(*(F.col(c).cast(kind).alias(c) for c in whole.columns)))
    assert {(r.degree, r.triangles, r.clustering) for r in found.collect()} == {(n - 1, (n - 1) * (n - 2) // 2, 1.0)}
    assert found.count() == n and found.schema["vertex"].dataType.simpleString() == kind
    shuffled = found._jdf.queryExecution().executedPlan().toString()
    assert "_other" not in shuffled and "MapInArrow" in shuffled


def test_edges_of_a_group_come_in_few_sorted_lists():
    """Ten batches are dealt out together; numbers of a list rise, so that they pack well."""
    rnd = random.Random(6)
    edges = [(rnd.randrange(100), rnd.randrange(100, 200)) for _ in range(300)]
    batches = [
        pa.RecordBatch.from_pydict({"low": [a for a, _ in some], "high": [b for _, b in some],
                                    "_i": [a % 6 for a, _ in some], "_j": [b % 6 for _, b in some]})
        for some in itertools.batched(edges, 30)
    ]
    dealt = [row for batch in paths._deal(6)(iter(batches)) for row in batch.to_pylist()]
    assert len({row["group"] for row in dealt}) == len(dealt)
    lists = [list(zip(row["low"], row["high"], strict=True)) for row in dealt]
    assert all(some == sorted(some) for some in lists)
    assert Counter(itertools.chain(*lists)) == {e: 6 * n for e, n in Counter(edges).items()}


@pytest.mark.parametrize("shift", [0, 1 << 40, -(1 << 40)])
def test_triangles_of_small_and_large_numbers(spark, shift):
    rows = [(a + shift, b + shift, "") for a, b in ((1, 2), (2, 3), (1, 3), (3, 4))]
    got = {tuple(r)[:3] for r in paths.triangles(graph(spark, rows)).collect()}
    assert got == {(v + shift, d, t) for v, d, t in ((1, 2, 1), (2, 2, 1), (3, 3, 1), (4, 1, 0))}


def breadth_first(near, source):
    reached, front = {source: 0}, [source]
    while front:
        front = [w for v in front for w in sorted(near.get(v, ())) if w not in reached and not reached.update({w: reached[v] + 1})]
    return reached


@pytest.mark.parametrize("directed", [False, True])
def test_hops(spark, directed):
    rnd = random.Random(4)
    rows = [(rnd.randrange(60), rnd.randrange(60), "") for _ in range(70)] + [(3, 3, ""), (None, 1, "")]
    near = {}
    for a, b, _ in rows:
        if a is not None:
            near.setdefault(a, set()).add(b)
            if not directed:
                near.setdefault(b, set()).add(a)
    sources = spark.createDataFrame([(1,), (2,), (2,), (None,), (500,)], "s int")
    got = paths.hops(graph(spark, rows), sources, directed).collect()
    expected = {(s, v, n) for s in (1, 2, 500) for v, n in breadth_first(near, s).items()}
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_a_long_chain_and_a_limit(spark):
    chain = graph(spark, [(i, i + 1, "") for i in range(40)])
    sources = spark.createDataFrame([(0,)], "s bigint")
    got = {r.vertex: r.hops for r in paths.hops(chain, sources, True).collect()}
    assert got == {i: i for i in range(41)}
    assert paths.hops(chain, sources, True, most=3).count() == 4
    assert paths.hops(chain.limit(0), sources).count() == 1


def test_hops_from_more_sources_than_a_block_holds(spark, monkeypatch):
    """A ring with a spoke to each vertex; rounds hold a row for many sources."""
    monkeypatch.setattr(paths, "WORDS", 2)
    n = 300
    rows = [(i, (i + 1) % n, "") for i in range(n)] + [(i, n, "") for i in range(n)]
    near = {}
    for a, b, _ in rows:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    got = paths.hops(graph(spark, rows), spark.range(n)).collect()
    expected = {(s, v, d) for s in range(n) for v, d in breadth_first(near, s).items()}
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_sources_travel_together(spark, monkeypatch):
    """128 sources with the same way to go make one row a vertex and round, not 128."""
    folders = []
    monkeypatch.setattr(paths, "fresh_path", lambda s, label, f=paths.fresh_path: folders.append(f(s, label)) or folders[-1])
    rows = [(i, 500, "") for i in range(128)] + [(500, 501, ""), (501, 502, "")]
    got = paths.hops(graph(spark, rows), spark.range(128), True)
    assert got.count() == 128 * 4
    assert spark.read.parquet(f"{folders[0]}/round=*").where("vertex >= 500").count() == 3


def scattered_parts(n=260):
    """A dense part, a long chain with falling numbers, many pairs, and sources in each and in none."""
    rnd = random.Random(5)
    rows = [(rnd.randrange(60), rnd.randrange(60), "") for _ in range(200)]
    rows += [(1_000 - i, 999 - i, "") for i in range(12)] + [(2_000 + 2 * i, 2_001 + 2 * i, "") for i in range(n)]
    sources = [*range(0, 60, 2), 1_000, 990, 5_000, 5_001, *range(2_000, 2_000 + 2 * n, 3)]
    near = {}
    for a, b, _ in rows:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    return rows, sources, near


def test_components(spark):
    rows, _, near = scattered_parts()
    both = spark.createDataFrame([(a, b) for a, own in near.items() for b in own], "vertex bigint, _next bigint")
    found = {r.vertex: r.component for r in paths.components(paths.store(both, "steps")).df.collect()}
    assert found.keys() == near.keys()
    least = {v: min(breadth_first(near, v)) for v in near}
    pairs = {(least[v], found[v]) for v in near}
    assert len(pairs) == len(set(least.values())) == len({c for _, c in pairs})
    empty = paths.components(paths.store(both.limit(0), "steps"))
    assert empty.rows == 0 and empty.df.columns == ["vertex", "component"]


@pytest.mark.parametrize("edges,bits,pairs", [(1 << 22, 1 << 22, 1 << 22), (80, 60, 200)])
def test_hops_by_component(spark, monkeypatch, edges, bits, pairs):
    """Components whole, in bundles, or too large for a task; few sources and places at a time."""
    monkeypatch.setattr(paths, "COMPONENT_EDGES", edges)
    monkeypatch.setattr(paths, "BITS_AT_ONCE", bits)
    monkeypatch.setattr(paths, "PAIRS_AT_ONCE", pairs)
    rows, sources, near = scattered_parts()
    given = spark.createDataFrame([(s,) for s in sources], "s bigint")
    got = paths.hops(graph(spark, rows), given).collect()
    expected = {(s, v, d) for s in sources for v, d in breadth_first(near, s).items()}
    assert len(got) == len(expected) and {tuple(r) for r in got} == expected


def test_components_are_walked_without_rounds(spark, monkeypatch):
    """No round of vertices and sources is stored where components fit in a task."""
    monkeypatch.setattr(paths, "_rounds", lambda *_: pytest.fail("rounds"))
    rows, sources, near = scattered_parts(20)
    given = spark.createDataFrame([(s,) for s in sources], "s bigint")
    assert paths.hops(graph(spark, rows), given).count() == sum(len(breadth_first(near, s)) for s in sources)


def test_hops_takes_all_orders(spark, tmp_path):
    """Two customers with one order each, of keys that the query once left out."""
    from stationkit.catalog import QUERIES

    def put(name, rows, kind):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")

    put("lineitem", [(1, 1, 1, 9.0), (1, 2, 2, 5.0), (2, 2, 1, 1.0)],
        "l_orderkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double")
    put("orders", [(1, 10), (2, 10)], "o_orderkey bigint, o_custkey bigint")
    put("supplier", [(1,), (2,)], "s_suppkey bigint")
    got = {tuple(r) for r in QUERIES["hops"].run(spark, str(tmp_path)).collect()}
    assert got == {(3, 3, 0), (3, 20, 1), (3, 5, 2), (5, 5, 0), (5, 20, 1), (5, 3, 2)}
