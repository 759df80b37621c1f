"""Whitening against numpy's eigenvectors, exact integers, and odd input."""

import math

import numpy as np
import pytest
from stationkit.llm import whitening
from stationkit.llm.queries import QUERIES

KIND = "vec_id bigint, embedding array<double>, n bigint, component string, x string"


def brute(rows, components=16):
    """Everything by plain numpy and Python integers over (vec_id, vector)."""
    usable = [
        (i, v) for i, v in rows
        if v and all(c is not None and math.isfinite(c) and abs(c) < 2**40 for c in v)
    ]
    xs = [(i, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, v in usable]
    fit = sorted(set(x for _, x in xs))
    n, d = len(fit), len(fit[0])
    sums = [sum(x[j] for x in fit) for j in range(d)]
    y = np.array([[float(n * x[j] - sums[j]) / n for j in range(d)] for x in fit])
    cov = y.T @ y / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    out = []
    for i, x in xs:
        dev = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        w = (np.array([float(n * a - s) / n for a, s in zip(x, sums)]) @ v)[:components]
        out.append((i, dev, w / np.sqrt(np.maximum(e[:components], 1e-300))))
    return n, out, e[:components] / np.trace(cov)


def check(rows, got):
    n, expected, explained = brute(rows)
    k = len(explained)
    table = {}
    for r in got:
        table.setdefault(r.vec_id, []).append(r)
    assert len(got) == k * len(expected)
    sign = {}
    for i, dev, w in expected:
        for r in table[i]:
            assert r.n == n and r.deviation == dev
            c = r.component - 1
            assert abs(r.explained - explained[c]) <= 1e-9 * explained[0]
            if abs(w[c]) > 1e-3:
                s = sign.setdefault(c, math.copysign(1, w[c]) * math.copysign(1, r.whitened))
                assert abs(s * w[c] - r.whitened) < 1e-6 * max(1, abs(w[c]))
    assert {r.identity_error for r in got} and max(r.identity_error for r in got) < 1e-8


@pytest.mark.parametrize("d", [2, 3, 20])
def test_against_numpy(spark, d):
    random = np.random.default_rng(d)
    m = random.normal(size=(400, d)) * np.linspace(1, 9, d) @ random.normal(size=(d, d)) + 5
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(m)]
    rows += [(i + 400, v) for i, v in rows[:50]]
    table = spark.createDataFrame([(i, v, 0, "c", "x") for i, v in rows], KIND).repartition(5)
    check(rows, whitening.whiten(table).collect())


def test_given_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = [
        (r.vec_id, [float(c) for c in r.embedding])
        for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ]
    check(rows, QUERIES["op13_qdwh_whitening"](spark, folder).collect())


def test_odd_input(spark):
    good = [(1, [1.0, 2.0, 3.0]), (2, [-1.0, 0.5, 3.0]), (2, [-1.0, 0.5, 3.0]), (None, [4.0, 2.0, 3.0]),
            (5, [0.0, 7.25, 3.0]), (6, [0.001, 7.251, 3.0])]
    bad = [(7, None), (8, []), (9, [None, 1.0, 2.0]), (10, [math.nan, 0.0, 0.0]), (11, [math.inf, 0.0, 0.0]),
           (12, [1e200, 0.0, 0.0]), (13, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, 0, "c", "x") for i, v in good + bad], KIND)
    got = whitening.whiten(table).collect()
    assert len(got) == 18 and {r.vec_id for r in got} == {1, 2, 5, 6, None}
    assert {r.n for r in got} == {4}
    assert all(r.whitened is None and r.explained == 0 for r in got if r.component == 3)
    assert all(r.whitened is not None for r in got if r.component < 3)
    assert whitening.whiten(table.limit(0)).count() == 0
    assert whitening.whiten(table.where("vec_id > 6 AND vec_id < 13")).count() == 0
    one = whitening.whiten(table.where("vec_id = 1")).collect()
    assert [(r.deviation, r.whitened, r.identity_error) for r in one] == [(0, None, 0.0)] * 3


def test_deviation_beyond_63_bits(spark):
    rows = [(i, [2.0**38 * i, 1.0 * i]) for i in range(4)]
    table = spark.createDataFrame([(i, v, 0, "c", "x") for i, v in rows], KIND)
    got = whitening.whiten(table).collect()
    assert len(got) == 8 and all(r.deviation is None for r in got)


@pytest.mark.parametrize("kind", ["spread", "close", "equal", "diagonal", "negative", "low rank"])
def test_spectrum(kind):
    random = np.random.default_rng(3)
    d = 60
    values = {
        "spread": 10.0 ** -np.linspace(0, 12, d), "close": 1 + 1e-6 * np.arange(d),
        "equal": np.repeat([5.0, 2.0, 1.0], 20), "diagonal": np.arange(d) + 1.0,
        "negative": np.linspace(-3, 3, d), "low rank": np.concatenate((np.arange(1.0, 11), np.zeros(50))),
    }[kind]
    q = np.eye(d) if kind == "diagonal" else np.linalg.qr(random.normal(size=(d, d)))[0]
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    e, v = whitening.spectrum(a)
    size = np.abs(values).max()
    assert np.allclose(e, np.sort(values)[::-1], atol=1e-13 * d * size)
    assert np.abs(v.T @ v - np.eye(d)).max() < 1e-12
    assert np.abs(a @ v - v * e).max() < 1e-12 * size * d
    assert np.abs(whitening.polar(a + 1e-3 * np.eye(d)) @ whitening.polar(a + 1e-3 * np.eye(d)) - np.eye(d)).max() < 1e-9
