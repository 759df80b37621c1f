"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad from shares of its characters and words and
those of the lines before and after it; neighbouring labels are tied by
transition weights. Forward-backward gives each line its chance to be bad, and
the mean over lines, weighted by their length, becomes the score of the document.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationkit.llm.arrays import blocks, split_words, text_bytes

# The field is fitted on at most this many labelled documents and so many lines of each.
TRAIN_DOCS = 4000
TRAIN_LINES = 200
# A document is kept from this score on.
KEEP = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:'\"?-()",
    "shout": b"!",
    "bar": b"|<>[]{}\\/_=+~^`@",
    "sign": b"#$%&*",
}
FEATURES = [*_CLASSES, "high", "words", "word_length", "length", "twin", "echo", "repeated", "any"]
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths, and the number of lines of each text.

    A text has one line more than line feeds, so an empty one has one line.
    Lengths count bytes that are not white space.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    edges = np.cumsum([len(t) + 1 for t in texts])
    counts = np.diff(np.searchsorted(ends, np.concatenate(([0], edges))))

    def per_line(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return (sums[ends] - sums[starts]).astype(np.float64)

    table = np.zeros(256, dtype=np.uint8)
    for number, chars in enumerate(_CLASSES.values(), 1):
        table[np.frombuffer(chars, dtype=np.uint8)] = number
    table[128:] = len(_CLASSES) + 1
    kind = table[data]
    space = _SPACES[data]
    length = per_line(~space)
    least = np.maximum(length, 1)
    shares = [per_line(kind == k) / least for k in range(1, len(_CLASSES) + 2)]
    found = split_words(texts)
    line = np.searchsorted(ends, found.starts)
    words = np.bincount(line, minlength=len(ends)).astype(np.float64)
    again = (found.hashes[1:] == found.hashes[:-1]) & (line[1:] == line[:-1])
    echo = np.bincount(line[1:][again], minlength=len(ends))
    twin = np.zeros(len(data), dtype=bool)
    twin[1:] = (data[1:] == data[:-1]) & ~space[1:] & (kind[1:] >= 4) & (kind[1:] <= 7)
    repeated = np.zeros(len(ends))
    sizes = ends - starts
    if len(ends) > 1:
        same = np.zeros(len(ends), dtype=bool)
        # A text's first line has none before it, whatever text comes before in the block.
        alike = (sizes[1:] == sizes[:-1]) & (sizes[1:] > 0)
        alike[np.cumsum(counts)[:-1] - 1] = False
        for i in np.flatnonzero(alike) + 1:
            same[i] = (
                data[starts[i] : ends[i]].tobytes() == data[starts[i - 1] : ends[i - 1]].tobytes()
            )
        repeated[same] = 1
    columns = [
        *shares,
        np.minimum(words / 20, 2),
        np.minimum(length / np.maximum(words, 1) / 10, 3),
        np.log1p(length) / 7,
        per_line(twin) / least,
        echo / np.maximum(words - 1, 1),
        repeated,
        (length > 0).astype(float),
    ]
    return np.stack(columns, axis=1), length, counts


def with_neighbours(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A constant, the features of the line itself, of the one before and of the one after."""
    first = np.cumsum(counts) - counts
    before, after = np.zeros_like(rows), np.zeros_like(rows)
    before[1:], after[:-1] = rows[:-1], rows[1:]
    before[first] = 0
    after[first + counts - 1] = 0
    return np.concatenate((np.ones((len(rows), 1)), rows, before, after), axis=1)


@dataclass(frozen=True)
class LineField:
    """Weights of the bad label, transition weights, and the line from field to score."""

    weights: np.ndarray
    steps: np.ndarray
    slope: float = 1.0
    shift: float = 0.0


def forward_backward(
    bad: np.ndarray, counts: np.ndarray, steps: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Chance of each line to be bad, and the expected transitions of each kind.

    All texts advance together, one line at a time. ``bad`` is the score of the
    bad label against that of the good one.
    """
    order = np.argsort(-counts, kind="stable")
    first = (np.cumsum(counts) - counts)[order]
    count = counts[order]
    alpha, beta = np.zeros((len(bad), 2)), np.zeros((len(bad), 2))
    going = [int(np.searchsorted(-count, -p, side="left")) for p in range(int(count[0]) + 1)]
    alpha[first, 1] = bad[first]
    for p in range(1, int(count[0])):
        at = first[: going[p]] + p
        last = alpha[at - 1]
        alpha[at] = np.logaddexp(last[:, :1] + steps[0], last[:, 1:] + steps[1])
        alpha[at, 1] += bad[at]
    for p in range(int(count[0]) - 1, 0, -1):
        at = first[: going[p]] + p
        then = beta[at] + np.stack((np.zeros(len(at)), bad[at]), axis=1)
        beta[at - 1] = np.logaddexp(then[:, :1] + steps[:, 0], then[:, 1:] + steps[:, 1])
    whole = np.logaddexp(*(alpha[first + count - 1].T))
    total = np.empty(len(counts))
    total[order] = whole
    lines = np.repeat(total, counts)
    chance = np.exp(alpha + beta - lines[:, None])
    inner = np.ones(len(bad), dtype=bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    moves = np.zeros((2, 2))
    then = beta[at] + np.stack((np.zeros(len(at)), bad[at]), axis=1)
    for i in range(2):
        for j in range(2):
            moves[i, j] = np.exp(alpha[at - 1, i] + steps[i, j] + then[:, j] - lines[at]).sum()
    return chance[:, 1] / chance.sum(axis=1), moves


def _fit_field(x, counts, wrong, rounds: int = 150, start: LineField | None = None) -> LineField:
    """Maximum likelihood with a small penalty, by gradient steps of adaptive size."""
    first = np.cumsum(counts) - counts
    inner = np.ones(len(x), dtype=bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (wrong[at - 1].astype(int), wrong[at].astype(int)), 1)
    weights = start.weights if start else np.zeros(x.shape[1])
    theta = np.concatenate((weights, (start.steps if start else np.zeros((2, 2))).ravel()))
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        w, steps = theta[:-4], theta[-4:].reshape(2, 2)
        chance, moves = forward_backward(x @ w, counts, steps)
        slope = np.concatenate((x.T @ (wrong - chance), (seen - moves).ravel()))
        slope = slope / len(x) - 1e-4 * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + 0.1 * (mean / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return LineField(theta[:-4], theta[-4:].reshape(2, 2))


def good_share(
    field: LineField, rows: np.ndarray, length: np.ndarray, counts: np.ndarray
) -> np.ndarray:
    """Length-weighted mean chance of a text's lines to be good."""
    chance, _ = forward_backward(with_neighbours(rows, counts) @ field.weights, counts, field.steps)
    first = np.cumsum(counts) - counts
    weight = length + 1e-9
    return np.add.reduceat((1 - chance) * weight, first) / np.add.reduceat(weight, first)


def fit(rows: np.ndarray, length: np.ndarray, counts: np.ndarray, quality: np.ndarray) -> LineField:
    """Fit the field to documents labelled 1 (good) or 0.

    At first all lines of a document bear its label. Then lines of bad documents
    that look good are relabelled, but never all lines of one, and the field is
    fitted again. With one class or none the score is the share of that class.
    """
    if len(set(quality.tolist())) < 2:
        share = 0.5 if not len(quality) else 0.01 + 0.98 * float(quality[0])
        return LineField(
            np.zeros(1 + 3 * len(FEATURES)), np.zeros((2, 2)), 0.0, np.log(share / (1 - share))
        )
    x = with_neighbours(rows, counts)
    bad_text = np.repeat(quality == 0, counts)
    first = np.cumsum(counts) - counts
    field = _fit_field(x, counts, bad_text.astype(float))
    for _ in range(2):
        chance, _ = forward_backward(x @ field.weights, counts, field.steps)
        worst = np.repeat(np.maximum.reduceat(chance, first), counts)
        wrong = bad_text & ((chance >= 0.5) | (chance == worst))
        field = _fit_field(x, counts, wrong.astype(float), 100, field)
    s = good_share(field, rows, length, counts)
    design = np.stack((s, np.ones(len(s))), axis=1)
    line = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ line))
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        line = line + np.linalg.solve(curve, design.T @ (quality - p) - 1e-3 * line)
    return LineField(field.weights, field.steps, max(float(line[0]), 0.0), float(line[1]))


def fold(number: str | Column, parts: int) -> Column:
    """Remainder of the CRC-32 of a document number written as text; null for a null one."""
    return F.pmod(F.crc32(F.col(number).cast("string").cast("binary")), F.lit(parts))


def train(docs: DataFrame, labels: DataFrame, folds: int = 5) -> LineField:
    """Fit the field on labelled documents outside fold 0.

    Rows without doc_id, text or label are left out; a document with several
    labels takes the smallest, one with several texts the smallest of those. The
    sample is the ``TRAIN_DOCS`` documents that come first in hash order. Of a
    document with more than ``TRAIN_LINES`` lines that many in a row are used,
    from a line that the hash of its text picks, so that no document is too long
    to be learned from.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(fold("doc_id", folds) != 0)
        .groupBy("doc_id").agg(F.min("quality").cast("double").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_DOCS)
    )
    picked = (
        docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(known), "doc_id")
        .groupBy("doc_id").agg(F.min("text").alias("text"), F.first("quality").alias("quality"))
    )

    def sampled(batches):
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            for begin, end in blocks(texts):
                rows, length, counts = line_features(texts[begin:end])
                begins = np.cumsum(counts) - counts
                used = np.minimum(counts, TRAIN_LINES)
                for i, (n, m) in enumerate(zip(counts, used, strict=True)):
                    begins[i] += crc32(texts[begin + i]) % int(n - m + 1)
                runs = [slice(a, a + m) for a, m in zip(begins, used, strict=True)]
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "quality": batch.column("quality")[begin + i].as_py(),
                            "lines": rows[run].ravel().tolist(),
                            "length": length[run].tolist(),
                        }
                        for i, run in enumerate(runs)
                    ],
                    pa.schema([("quality", pa.float64()), ("lines", pa.list_(pa.float64())),
                               ("length", pa.list_(pa.float64()))]),
                )

    sample = picked.mapInArrow(sampled, "quality double, lines array<double>, length array<double>")
    sample = sorted(sample.toArrow().to_pylist(), key=lambda r: (r["quality"], r["lines"]))
    counts = np.array([len(r["length"]) for r in sample], dtype=np.int64)
    lines = np.array([v for r in sample for v in r["lines"]], dtype=np.float64)
    length = np.array([v for r in sample for v in r["length"]], dtype=np.float64)
    quality = np.array([r["quality"] for r in sample], dtype=np.float64)
    return fit(lines.reshape(-1, len(FEATURES)), length, counts, quality)


def score(field: LineField, text: str | Column = "text") -> Column:
    """Quality score (0 to 1) of a text column; a null text counts as an empty one."""

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        texts = text_bytes(column)
        out = [np.zeros(0)]
        for begin, end in blocks(texts):
            share = good_share(field, *line_features(texts[begin:end]))
            out.append(1 / (1 + np.exp(-(field.slope * share + field.shift))))
        return pa.array(np.concatenate(out))

    return scored(text)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Every document with ``held_out``, ``score`` and ``predicted`` (1 from score 0.3 on).

    One row for each row of ``docs``, repeated ones included. Held out are the
    documents of fold 0, whose labels are never used. Null and empty texts are
    scored as one empty line. A null doc_id gives a null ``held_out``. Other
    columns, also ones named like those of the result, are not read.
    """
    field = train(docs, labels, folds)
    scored = docs.select(F.col("doc_id").cast("bigint"), score(field).alias("score"))
    return scored.select(
        "doc_id", (fold("doc_id", folds) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= KEEP, 1).otherwise(0).alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """The documents predicted good, with all their columns."""
    at_least = score(train(docs, labels, folds), F.col("text"))
    return docs.where(at_least >= KEEP)
