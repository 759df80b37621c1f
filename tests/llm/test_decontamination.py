"""Decontamination against an alignment of every item with every text."""

import random
import tracemalloc

import numpy as np
import pytest

from stationkit.llm import decontamination

COMMON = "the of and a to in is you that it for on are as with this be at have from".split()
RARE = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("lm", "rn", "st", "x")]


def best_score(item, text):
    """Smith-Waterman, cell by cell."""
    above, best = [0] * (len(text) + 1), 0
    for word in item:
        row = [0]
        for j, other in enumerate(text):
            row.append(max(0, above[j] + (2 if word == other else -1), above[j + 1] - 1, row[j] - 1))
        above, best = row, max(best, *row)
    return best / (2 * len(item))


@pytest.fixture(scope="module")
def tables():
    pick = random.Random(11)
    items = [(k, " ".join(pick.choice(RARE + COMMON) for _ in range(12 + k))) for k in range(12)]
    docs = []
    for number in range(60):
        words = [pick.choice(COMMON) for _ in range(80)]
        if number % 2:
            inner = items[number % 12][1].split()
            for _ in range(number % 5):
                inner[pick.randrange(len(inner))] = "changed"
            words[40:40] = inner if number % 3 else inner[:3]
        docs.append((number, " ".join(words)))
    return docs, items


def test_query_equals_alignment_of_all(spark, tables, monkeypatch):
    """Every pair that scores half and holds a seed of four words; and nothing else.

    All n-grams count as rare here, since a thousandth of sixty documents is none.
    """
    monkeypatch.setattr(decontamination, "RARE_SHARE", 1.0)
    docs, items = tables
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    got = {(r.doc_id, r.item_id): r.score for r in found.collect()}
    want = {}
    for doc_id, text in docs:
        text = text.split()
        grams = {tuple(text[i : i + 4]) for i in range(len(text) - 3)}
        for item_id, item in items:
            item = item.split()
            score = best_score(item, text)
            if score >= 0.5 and grams & {tuple(item[i : i + 4]) for i in range(len(item) - 3)}:
                want[doc_id, item_id] = score
    assert len(want) > 10 and got == want


def test_repeated_items_and_clashing_columns(spark, tables):
    docs, items = tables
    docs = [(*d, "x", 1) for d in [*docs, *docs[:10], (None, items[0][1]), (99, None)]]
    kind = "doc_id bigint, text string, score string, item_id bigint"
    more = [*items, *items, (None, items[1][1]), (50, None), (51, "")]
    plain = decontamination.contaminated(
        spark.createDataFrame(tables[0], "doc_id bigint, text string"),
        spark.createDataFrame(items, "item_id bigint, text string"),
    )
    odd = decontamination.contaminated(
        spark.createDataFrame(docs, kind), spark.createDataFrame(more, "item_id bigint, text string")
    )
    pairs = ["doc_id", "item_id", "score"]
    assert sorted(map(tuple, odd.select(pairs).collect())) == sorted(
        map(tuple, plain.select(pairs).collect())
    )


def test_a_text_that_repeats_an_item_takes_bounded_memory():
    """Fifty thousand times one item, beside many short texts that hold it."""
    item = " ".join(RARE[:12])
    texts = [(" ".join([item] * 50_000)).encode(), *[item.encode()] * 255]
    items = decontamination.item_block([(7, item.encode())])
    tracemalloc.start()
    got = decontamination.find_items(items, texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sorted(g[:5] for g in got) == [(t, 7, 1.0, 0, 11) for t in range(256)]
    assert peak < 100 * len(texts[0])


def test_pieces_of_a_long_window_miss_nothing(monkeypatch):
    """An exact copy anywhere in a long run of seeds is found whole."""
    pick = np.random.default_rng(3)
    item = RARE[:10]
    monkeypatch.setattr(decontamination, "CELLS", 64)
    items = decontamination.item_block([(1, " ".join(item).encode())])
    for _ in range(30):
        noise = [w for _ in range(40) for w in [*item[:5], "x"]]
        at = int(pick.integers(0, len(noise)))
        text = " ".join([*noise[:at], "y", *item, *noise[at:]]).encode()
        assert decontamination.find_items(items, [text])[0][2:5] == (1.0, at + 1, at + 10)
