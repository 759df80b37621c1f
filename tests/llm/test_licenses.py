"""License scans against plain alignments and on texts that repeat a license many times."""

import random
import time

import numpy as np
import pytest

from stationkit.llm import licenses

COMMON = "the of and a to in is you that it for on are as with this be at".split()


def plain(template, text, begin, low, high):
    """(score, matched) of the best banded alignment, cell by cell."""
    width, best = 2 * licenses.BAND + 1, (0, 0)
    above = [(0, 0)] * (width + 1)
    for i, word in enumerate(template):
        row = []
        for o in range(width):
            j = begin + i + o - licenses.BAND
            if not low <= j < high:
                row.append((0, 0))
                continue
            score, hits = above[o]
            options = [(score + 2, hits + 1) if text[j] == word else (score - 1, hits)]
            options.append((above[o + 1][0] - 1, above[o + 1][1]))
            if o:
                options.append((row[-1][0] - 1, row[-1][1]))
            cell = max(options)
            row.append(cell if cell[0] > 0 else (0, 0))
        # Within a step more matches decide between equal scores; of steps the first counts.
        best = max(best, max(row), key=lambda c: c[0])
        above = [*row, (0, 0)]
    return best


def test_alignment_equals_plain_form():
    pick = np.random.default_rng(5)
    for _ in range(40):
        size, n = int(pick.integers(2, 30)), int(pick.integers(1, 60))
        template = pick.integers(1, 6, size).astype(np.uint64)
        text = pick.integers(1, 6, n).astype(np.uint64)
        begin = pick.integers(-size, n, 7)
        low, high = np.zeros(7, np.int64), np.full(7, n)
        hits, first, last = licenses.banded_alignment(template, text, begin, low, high)
        for g in range(7):
            score, matched = plain(template, text, begin[g], 0, n)
            assert (score, matched) == (0, 0) or hits[g] == matched
            if hits[g]:
                assert 0 <= first[g] <= last[g] < n
                assert text[first[g]] in template and text[last[g]] in template


def edited(words, share, pick):
    """A copy in which some words are changed, left out or doubled."""
    out = []
    for word in words:
        roll = pick.random()
        if roll < share / 3:
            out.append(f"x{pick.randrange(1000)}")
        elif roll < 2 * share / 3:
            out += [word, f"y{pick.randrange(1000)}"]
        elif roll >= share:
            out.append(word)
    return out


@pytest.fixture(scope="module")
def corpus():
    """Documents that hold one template, exact or edited, between common words; and some that hold none."""
    pick = random.Random(7)
    rows = []
    for name, text in licenses.TEMPLATES.items():
        for share in (0.0, 0.08):
            inner = text.split()
            inner = edited(inner, share, pick) if len(inner) >= 16 else inner
            around = [pick.choice(COMMON) for _ in range(120)]
            rows.append((len(rows), " ".join(around[:60] + inner + around[60:])))
    for _ in range(20):
        own = [pick.choice(COMMON + ["license", "software", "rights", "under"]) for _ in range(300)]
        rows.append((len(rows), " ".join(own)))
    return rows


def test_query_equals_alignment_of_every_place(spark, corpus):
    """Every (document, template) that an alignment at any place finds, and no other."""
    docs = spark.createDataFrame(corpus, "doc_id bigint, text string").repartition(3)
    got = {(r.doc_id, r.template): r for r in licenses.license_spans(docs).collect()}
    index = licenses.build_index(licenses.TEMPLATES)
    want = {}
    for doc_id, text in corpus:
        words = licenses.plain_words([text.encode()]).hashes
        for name, own in zip(index.names, index.words, strict=True):
            begin = np.arange(-len(own), len(words))
            low, high = np.zeros(len(begin), np.int64), np.full(len(begin), len(words))
            hits, _, _ = licenses.banded_alignment(own, words, begin, low, high)
            if hits.max() >= licenses.LEAST_COVERAGE * len(own):
                want[doc_id, name] = int(hits.max())
    assert set(got) == set(want)
    assert all(got[k].matched >= 0.97 * n for k, n in want.items())
    exact = [r for r in got.values() if r.coverage == 1]
    assert len(exact) >= len(licenses.TEMPLATES)


def test_a_text_that_repeats_a_notice(spark):
    notice = "All rights reserved. "
    docs = spark.createDataFrame([(1, notice * 20_000)], "doc_id bigint, text string")
    start = time.monotonic()
    got = licenses.license_spans(docs).collect()
    assert time.monotonic() - start < 60
    assert sorted((r.first_word, r.last_word) for r in got) == [
        (3 * i, 3 * i + 2) for i in range(20_000)
    ]


def test_result_does_not_depend_on_neighbours(corpus):
    index = licenses.build_index(licenses.TEMPLATES)
    texts = [text.encode() for _, text in corpus[:12]]
    alone = [(i, *found[1:]) for i, t in enumerate(texts) for found in licenses.scan(index, [t])]
    assert sorted(alone) == sorted(licenses.scan(index, texts))


def test_templates_from_a_table(spark, monkeypatch):
    table = spark.createDataFrame(
        [("own", "one two three four"), ("own", "one two three four"), (None, "x y"), ("none", None)],
        "name string, text string",
    )
    docs = spark.createDataFrame(
        [(1, "Zero one, two - three four five", "k"), (None, "one two three four", "k")],
        "doc_id bigint, text string, template string",
    )
    got = licenses.license_spans(docs, table).collect()
    assert {(r.doc_id, r.template, r.first_word, r.last_word) for r in got} == {
        (1, "own", 1, 4), (None, "own", 0, 3)
    }
    assert licenses.license_spans(docs, table.limit(0)).count() == 0
    assert licenses.license_spans(docs, {"word": "one"}).count() == 0
    with pytest.raises(ValueError, match="several texts"):
        licenses.read_templates(table.union(spark.createDataFrame([("own", "other")], table.schema)))
    monkeypatch.setattr(licenses, "TEMPLATE_CHARS", 5)
    with pytest.raises(ValueError, match="characters"):
        licenses.read_templates(table)
