"""As-of join, overlapping intervals and episodes against plain loops, with hot keys and odd rows."""

import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from stationkit.operators import temporal
from stationkit.plans import keyed, ordered


def at(seconds):
    return None if seconds is None else datetime.fromtimestamp(seconds, UTC)


def table(spark, rows, kind, *times):
    df = spark.createDataFrame(rows, kind)
    return df.withColumns({c: F.timestamp_micros((F.col(c) * 1e6).cast("bigint")) for c in times})


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables would else be put into one range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(params=[2, 13])
def parts(spark, request):
    spark.conf.set("spark.sql.shuffle.partitions", request.param)


def asof_rows(seed, n=600):
    rnd = random.Random(seed)
    key = lambda: "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", "c", None])
    time = lambda: None if rnd.random() < 0.03 else float(rnd.randrange(400))
    left = [(key(), time(), i) for i in range(n)]
    right = [(key(), time(), rnd.choice([None, 1.0, 2.0, 3.0])) for _ in range(n // 3)]
    return left, right


def asof_brute(left, right, tolerance):
    out = []
    for k, t, i in left:
        fits = [
            (s, (v is not None, v or 0.0), v) for q, s, v in right
            if None not in (k, t, s) and q == k and s <= t and (tolerance is None or t - s <= tolerance)
        ]
        best = max(fits, default=None, key=lambda x: x[:2])
        out.append((i, best[0] if best else None, best[2] if best else None))
    return sorted(out)


@pytest.mark.parametrize("tolerance", [None, 5, 0])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_asof_join(spark, parts, tolerance, how):
    left, right = asof_rows(1)
    l = table(spark, left, "key string, t double, i int", "t")  # noqa: E741
    r = table(spark, right, "key string, s double, v double", "s")
    got = temporal.asof_join(l, r, ["key"], "t", "s", tolerance, how)
    assert got.columns == ["key", "t", "i", "s", "v"]
    expected = asof_brute(left, right, tolerance)
    if how == "inner":
        expected = [x for x in expected if x[1] is not None]
    found = [(x.i, x.s and x.s.timestamp(), x.v) for x in got.collect()]
    assert sorted(found, key=lambda x: x[0]) == expected


def test_asof_value_is_carried_over_many_ranges(spark):
    """One right row at the start of a key that fills every range."""
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    left = spark.range(20_000).select(F.lit("k").alias("key"), F.timestamp_seconds("id").alias("t"))
    right = table(spark, [("k", 5.0, 1.0), ("j", 3.0, 2.0)], "key string, s double, v double", "s")
    got = temporal.asof_join(left, right, ["key"], "t", "s").groupBy("v").count().collect()
    assert {r.v: r["count"] for r in got} == {None: 5, 1.0: 19_995}
    # No range is much larger than the others, though all rows share one key.
    both = left.withColumns({"_at": F.col("t"), "_tie": F.xxhash64("t")})
    sizes = [r["count"] for r in ordered.range_blocks(both, ["key", "_at", "_tie"], "t").groupBy("_block").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 4 * 20_000 / 16


def test_asof_odd_tables(spark):
    l = table(spark, [("a", 1.0, 1)], "key string, t double, i int", "t")  # noqa: E741
    r = table(spark, [], "key string, s double, v double", "s")
    assert [tuple(x)[2:] for x in temporal.asof_join(l, r, ["key"], "t", "s").collect()] == [(1, None, None)]
    assert temporal.asof_join(l.limit(0), r, ["key"], "t", "s").count() == 0
    with pytest.raises(ValueError, match="rename"):
        temporal.asof_join(l, l, ["key"], "t", "t")
    with pytest.raises(ValueError, match="how"):
        temporal.asof_join(l, r, ["key"], "t", "s", how="outer")


def spans(seed, n, longest):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        begin = rnd.choice([None, *[rnd.uniform(0, 5_000) for _ in range(30)]])
        length = rnd.choice([rnd.uniform(0, 3), rnd.uniform(0, 300), longest, 0.0, -5.0, 64.0])
        out.append((rnd.choice(["hot", "hot", "a", None]), begin, None if begin is None else begin + length, i))
    return out


def overlap_brute(left, right):
    return sorted(
        (i, j) for k, b, e, i in left for q, c, f, j in right
        if None not in (k, b, c) and k == q and b < e and c < f and b < f and c < e
    )


@pytest.mark.parametrize("cell", [1.0, 16.0, 100_000.0])
def test_overlap_join(spark, cell):
    left, right = spans(1, 250, 4_000.0), spans(2, 200, 2.5)
    left, right = ([(k, b and round(b, 3), e and round(e, 3), i) for k, b, e, i in x] for x in (left, right))
    l = table(spark, left, "key string, start double, end double, i int", "start", "end")  # noqa: E741
    r = table(spark, right, "key string, start2 double, end2 double, j int", "start2", "end2")
    got = temporal.overlap_join(l, r, ["key"], ("start", "end"), ("start2", "end2"), cell)
    assert got.columns == ["key", "start", "end", "i", "start2", "end2", "j"]
    expected = overlap_brute(left, right)
    assert len(expected) > 1_000
    assert sorted((x.i, x.j) for x in got.collect()) == expected


def test_overlap_without_broadcast_and_long_intervals(spark, monkeypatch):
    """A year against seconds: the year is repeated a few times, not once per cell."""
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 0)
    year = 365 * 86_400.0
    left = [("k", 0.0, year, 0)] + [("k", 10.0 * i, 10.0 * i + 3, i) for i in range(1, 900)]
    right = [("k", 10.0 * i + 1, 10.0 * i + 2, i) for i in range(900)]
    l = table(spark, left, "key string, start double, end double, i int", "start", "end")  # noqa: E741
    r = table(spark, right, "key string, start2 double, end2 double, j int", "start2", "end2")
    got = temporal.overlap_join(l, r, ["key"], ("start", "end"), ("start2", "end2"), 1.0).collect()
    assert sorted((x.i, x.j) for x in got) == sorted([(0, j) for j in range(900)] + [(i, i) for i in range(1, 900)])
    leveled = l.select(F.unix_micros("start").alias("_begin"), F.unix_micros("end").alias("_end"),
                       F.lit(25).alias("_level"))
    assert temporal._in_cells(leveled, [1, 25], 1_000_000).where("_end - _begin > 1e9").count() <= 2
    assert temporal.overlap_join(l.limit(0), r, ["key"], ("start", "end"), ("start2", "end2")).count() == 0


def episodes_brute(rows, gap):
    out, last = [], {}
    for key, t, v in sorted((r for r in rows if r[1] is not None), key=lambda r: (str(r[0]), r[1])):
        own = last.get(key)
        if own is None or t - own[1] > gap:
            own = [t, t, 0, []]
            last[key] = own
            out.append((key, own))
        own[1], own[2] = t, own[2] + 1
        own[3].append(v)
    known = [(k, s, e, n, [v for v in vs if v is not None]) for k, (s, e, n, vs) in out]
    return sorted(((k, s, e, n, max(vs, default=None), round(sum(vs) / len(vs), 6) if vs else None)
                   for k, s, e, n, vs in known), key=str)


@pytest.mark.parametrize("gap", [0.0, 2.0, 1_000.0])
def test_episodes(spark, parts, gap):
    rnd = random.Random(4)
    rows = [
        ("hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None]),
         None if rnd.random() < 0.02 else float(rnd.randrange(3_000)), rnd.choice([None, 1.0, 5.5, 7.0]))
        for _ in range(900)
    ]
    df = table(spark, rows, "key string, last_updated double, value double", "last_updated")
    got = [
        (r.key, r.episode_start.timestamp(), r.episode_end.timestamp(), r.num_readings, r.peak_value,
         None if r.mean_value is None else round(r.mean_value, 6))
        for r in temporal.episodes(df, gap, ["key"]).collect()
    ]
    assert sorted(got, key=str) == episodes_brute(rows, gap)


def test_one_episode_over_all_ranges(spark):
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    df = spark.range(30_000).select(
        F.lit("k").alias("key"), F.timestamp_seconds("id").alias("last_updated"), F.lit(1.0).alias("value")
    )
    got = temporal.episodes(df, 1, ["key"]).collect()
    assert [(r.num_readings, r.episode_end.timestamp()) for r in got] == [(30_000, 29_999.0)]
    assert temporal.episodes(df.limit(0), 1, ["key"]).count() == 0
