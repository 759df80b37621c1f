"""The line field learns from documents of any length, and scores as plain sums do."""

import itertools
import math
import random

import numpy as np
import pytest

from stationkit.llm import quality


def page(good: bool, lines: int, pick: random.Random) -> str:
    clean = ["The river ran slowly past the old mill.", "She had never seen so many birds before."]
    waste = ["$$$ CLICK HERE !!! <<<>>> ###", "|||| 000 111 ||| ==== ~~~~ @@@@"]
    return "\n".join(pick.choice(clean if good else waste) for _ in range(lines))


@pytest.mark.parametrize("longer", [0, 1])
def test_a_class_of_long_documents_is_learned(spark, longer):
    """One class consists of documents of more lines than the fit takes of any."""
    pick = random.Random(3)
    rows = [(i, page(i % 2 == 1, 700 if i % 2 == longer else 6, pick)) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 120 and all(r.predicted == r.doc_id % 2 for r in got)
    assert any(r.held_out for r in got)


def test_a_repeated_document_counts_once(spark):
    pick = random.Random(4)
    rows = [(i, page(i % 2 == 1, 5, pick)) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, quality int")
    schema = "doc_id bigint, text string"
    once = quality.train(spark.createDataFrame(rows, schema), labels)
    often = quality.train(spark.createDataFrame(rows + rows[1:2] * 500, schema), labels)
    assert np.array_equal(once.weights, often.weights) and once.slope == often.slope


def test_keep_good_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, score string")
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 0


def test_query_equals_sum_over_labellings(spark):
    """Scores of short texts from all ways to label their lines."""
    pick = random.Random(5)
    rows = [(i, page(i % 2 == 1, 1 + i % 5, pick)) for i in range(60)] + [(60, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    field = quality.train(docs, labels)
    got = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    for doc_id, text in rows:
        shares, length, counts = quality.line_features([(text or "").encode()])
        bad = quality.with_neighbours(shares, counts) @ field.weights
        total, good = 0.0, np.zeros(len(bad))
        for marks in itertools.product((0, 1), repeat=len(bad)):
            value = sum(b for b, m in zip(bad, marks, strict=True) if m)
            value += sum(field.steps[a, b] for a, b in itertools.pairwise(marks))
            total += math.exp(value)
            good += math.exp(value) * (1 - np.array(marks))
        weight = length + 1e-9
        share = (good / total * weight).sum() / weight.sum()
        want = 1 / (1 + math.exp(-(field.slope * share + field.shift)))
        assert abs(got[doc_id] - want) < 1e-9
