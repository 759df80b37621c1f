"""Divergence of sources against brute force, the trees against plain sums, odd input."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from stationkit.llm import divergence

KIND = "doc_id bigint, text string, lang string, source string, value bigint, rank string, term string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    """Plain Python over (text, lang, source)."""
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(LOWER))
        groups.add((lang, source))
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang, source in groups:
        kept = [w for w, n in docs[lang].items() if n >= least]

        def shares(own):
            n = sum(own[w] for w in kept)
            return {w: 1 + 10**9 * (own[w] + 5) // (n + 5 * len(kept)) for w in kept}

        p = shares(counts[lang, source])
        whole = sum((counts[g] for g in groups if g[0] == lang), Counter())
        q = shares(whole)
        pairs = []
        for other in (s for g, s in groups if g == lang and s != source):
            r = shares(counts[lang, other])
            pairs.append((other, sum(abs(p[w] - r[w]) for w in kept)))
        terms = [(w, p[w] - q[w]) for w in kept if counts[lang, source][w] and p[w] > q[w]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            for rank, (item, value) in enumerate(items, 1):
                if part == "pair" or rank <= top:
                    out.append((lang, source, part, item, value, rank))
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(1, t, l, s, 0, "r", "w") for t, l, s in rows], KIND)


@pytest.mark.parametrize("block,chunk", [(1800, 24), (4, 2), (1, 1)])
def test_against_brute_force(spark, block, chunk):
    random = np.random.default_rng(block)
    words = [f"{'ABCdefé文'[i % 8]}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    rows = []
    for i in range(150):
        text = " ".join(random.choice(words, random.integers(0, 30), p=None))
        rows.append((text, ["en", "de", None, ""][i % 4], ["a", "b", "c", "ü", None][i % 5]))
    rows += [("same same", "xx", f"s{i}") for i in range(4)] + [("few", "yy", "only"), (None, "en", "empty")]
    rows += [("x1y--z's " * 3, "en", "a"), ("", None, None)]
    got = divergence.divergence(table(spark, rows).repartition(4), 5, 7, block, chunk)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 7)


def test_long_texts_and_flushes(spark, monkeypatch):
    long = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{'q' * (i % 3)}" for i in range(900_000))
    rows = [(long, "en", "a"), (long[5:], "en", "b"), ("x" * 3_000_000, "en", "c"), ("x " + long[:4000], "en", "a")]
    monkeypatch.setattr(divergence, "HELD", 10)
    monkeypatch.setattr(divergence, "_CUT", 1000)
    got = divergence.divergence(table(spark, rows), 2, 50)
    assert sorted(map(tuple, got.collect())) == brute(rows, 2, 50)


def test_nothing_kept_and_empty(spark):
    rows = [("one two", "en", s) for s in "abc"] + [("alone", "de", "a")]
    got = divergence.divergence(table(spark, rows), 30)
    assert sorted(map(tuple, got.collect())) == brute(rows, 30, 50)
    assert {r.value for r in got.collect()} == {0} and got.count() == 6
    assert divergence.divergence(table(spark, rows).where("false")).count() == 0


def test_trees_share_nodes_and_price_as_plain_sums():
    random = np.random.default_rng(1)
    counts = random.integers(0, 3, (7, 64))
    counts[3:] = 0
    counts[4, 40:44] = [1, 2, 1, 2]
    counts[5] = counts[4]
    counts[:, 60:] = -1
    trees = divergence.Forest(counts)
    assert trees.roots[4] == trees.roots[5] != trees.roots[3]
    # One stretch of zeros is one node of its level, wherever it stands.
    assert len(trees.levels[0][0]) <= 10
    wholes = np.array([900, 1000, 1100, 300, 310, 310, 10**15])
    a, b = (x.ravel() for x in np.meshgrid(range(7), range(7)))
    got = trees.distances(a, b, wholes)
    for i, j, value in zip(a, b, got, strict=True):
        p, q = ([1 + 10**9 * (int(c) + 5) // int(wholes[g]) for c in counts[g, :60]] for g in (i, j))
        assert value == sum(abs(x - y) for x, y in zip(p, q, strict=True))


def test_price(spark):
    cases = [(0, 5), (7, 12), (10**12, 3 * 10**12), (3, 8 * 10**15), (8 * 10**15, 8 * 10**15 + 5)]
    df = spark.createDataFrame(cases, "c bigint, w bigint")
    got = [r.p for r in df.select(divergence.price(F.col("c"), F.col("w")).alias("p")).collect()]
    assert got == [1 + 10**9 * (c + 5) // w for c, w in cases]
