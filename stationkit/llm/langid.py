"""Language identification by cross-parsing with suffix automata.

For each language the suffix automaton of some labelled text accepts exactly the
substrings of that text. A new text is cut, from the left, into the longest
pieces that an automaton accepts, across words; the language whose automaton
needs the fewest pieces per letter wins. Texts are parsed in segments of up to
``SEGMENT`` bytes, many at once, so a piece ends where a segment does.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationkit.llm.arrays import blocks
from stationkit.llm.quality import fold
from stationkit.plans.stored import store

# Labelled text per language, and for all languages together, in bytes. This bounds the
# automata. It comes from up to SAMPLE_DOCS documents of any length per language; of a long one a
# run of up to TRAIN_CHARS characters from a place that a hash chooses is looked at.
TRAIN_BYTES = 32_000
TRAIN_BYTES_ALL = 128_000
TRAIN_CHARS = 1_000
SAMPLE_DOCS = 600
# Bytes that are parsed in one go; segments end between words where there are any.
SEGMENT = 512
# A table of languages with up to so many rows is broadcast.
BROADCAST_ROWS = 10_000
UNKNOWN = "und"
# Above this many pieces per letter no learned language fits.
MOST_PIECES = 0.75
_BLOCK = 1 << 21

_LETTERS = bytes(c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def letters_only(text: str | None) -> bytes:
    """Lower-case letters of a text as UTF-8, everything else replaced by spaces.

    Bytes above 127 count as letters in a text with any letter; a text without a
    letter gives no bytes.
    """
    out = (text or "").lower().encode("utf-8", "replace").translate(_LETTERS)
    if out.strip() and (text.isascii() or any(c.isalpha() for c in text)):
        return out
    return b""


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts the substrings of a text."""
    step: list[dict[int, int]] = [{}]
    link, size, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                size.append(size[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    return step


@dataclass(frozen=True)
class Automata:
    """The automata of all languages in one transition table; -1 where none."""

    languages: list[str]
    roots: np.ndarray
    table: np.ndarray
    codes: np.ndarray


def build(texts: dict[str, bytes]) -> Automata:
    """Automata of the text of each language. Byte 0 of the code table has no transitions."""
    languages = sorted(texts)
    used = sorted(set(b"".join(texts.values())))
    codes = np.zeros(256, dtype=np.int64)
    codes[used] = np.arange(1, len(used) + 1)
    parts, roots, base = [], [], 0
    for language in languages:
        steps = suffix_automaton(texts[language])
        table = np.full((len(steps), len(used) + 1), -1, dtype=np.int32)
        for state, out in enumerate(steps):
            for c, to in out.items():
                table[state, codes[c]] = to + base
        roots.append(base)
        base += len(steps)
        parts.append(table)
    whole = np.concatenate(parts) if parts else np.full((0, 1), -1, dtype=np.int32)
    return Automata(languages, np.array(roots, dtype=np.int64), whole, codes)


def _segments(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array of bytes, and the owner, begin and end of each segment.

    Each text is led in by a space, and runs of spaces are one. A segment keeps
    the space before its first word, so that beginnings of words count as such.
    """
    owners, starts, ends, parts, base = [], [], [], [], 0
    for i, text in enumerate(texts):
        text = b" ".join(text.split())
        if not text:
            continue
        text = b" " + text
        begin = 0
        while begin < len(text):
            end = begin + SEGMENT
            if end < len(text):
                space = text.rfind(b" ", begin + 1, end + 1)
                end = space if space > 0 else end
            end = min(end, len(text))
            owners.append(i)
            starts.append(base + begin)
            ends.append(base + end)
            begin = end
        parts.append(text)
        base += len(text)
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    return data, *(np.array(x, dtype=np.int64) for x in (owners, starts, ends))


def count_pieces(model: Automata, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces each automaton needs for each text, and the letters of the text."""
    letters = np.array([len(t) - t.count(b" ") for t in texts], dtype=np.float64)
    pieces = np.zeros((len(texts), len(model.languages)))
    data, owner, starts, ends = _segments(texts)
    if not len(owner) or not model.languages:
        return pieces, letters
    order = np.argsort(starts - ends, kind="stable")
    owner, starts, sizes = owner[order], starts[order], (ends - starts)[order]
    width = model.table.shape[1]
    flat = model.table.ravel()
    codes = model.codes[data]
    roots = model.roots[None, :]
    first = flat[roots * width + np.arange(width)[:, None]]
    state = np.repeat(roots, len(owner), axis=0)
    count = np.zeros(state.shape, dtype=np.int64)
    for p in range(int(sizes[0])):
        n = int(np.searchsorted(-sizes, -p, side="left"))
        code = codes[starts[:n] + p]
        to = flat[state[:n] * width + code[:, None]]
        # A failed step ends the piece before it; a letter no text has is a piece by itself.
        row, column = np.nonzero(to < 0)
        if len(row):
            count[row, column] += state[row, column] != model.roots[column]
            again = first[code[row], column]
            unknown = again < 0
            count[row, column] += unknown
            to[row, column] = np.where(unknown, model.roots[column], again)
        state[:n] = to
    count += state != roots
    for k in range(len(model.languages)):
        pieces[:, k] = np.bincount(owner, count[:, k], len(texts))
    return pieces, letters


def _excerpt(text: str, most: int) -> bytes:
    """Up to ``most`` bytes of the words of a text, whole ones unless the first is too long."""
    words = letters_only(text).split()
    if len(words) > 2:
        words = words[1:-1]  # The text may have been cut inside them.
    out = b""
    for word in words:
        if len(out) + 1 + len(word) > most:
            break
        out += b" " + word
    if not out and words and most > 1:
        out = b" " + words[0][: most - 1].decode("utf-8", "ignore").encode()
    return out


def shared_out(texts: list[str], most: int) -> bytes:
    """About ``most`` bytes of some texts, in equal parts; what short ones leave goes to the others."""
    by_size = sorted(range(len(texts)), key=lambda i: (len(texts[i].encode("utf-8", "replace")), i))
    out: dict[int, bytes] = {}
    left = most
    for done, i in enumerate(by_size):
        out[i] = _excerpt(texts[i], left // (len(texts) - done))
        left -= len(out[i])
    return b"".join(out[i] for i in range(len(texts)))


def train(docs: DataFrame, folds: int = 4, held: int = 2) -> Automata:
    """Automata from the texts and labels of documents outside fold ``held``.

    Rows with a null doc_id, text or lang, and empty texts, are left out. Of each
    language the documents that come first in hash order are taken, however long
    they are, and give equal parts of ``TRAIN_BYTES``.
    """
    known = (
        docs.select("doc_id", "text", "lang")
        .where("doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL AND text != ''")
        .where(fold("doc_id", folds) != held)
        .withColumn("place", F.xxhash64(F.lit("sample"), "doc_id", "text"))
    )
    counts = store(known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "languages")
    # One row for each language: where they are few, no text moves before the sample is drawn.
    per_language = F.broadcast(counts.df) if counts.rows <= BROADCAST_ROWS else counts.df
    # The share of rows that leaves a few times SAMPLE_DOCS of each language, then the first ones.
    share = F.pmod("place", F.lit(1 << 30)) / (1 << 30)
    few = known.join(per_language, "lang").where(share * F.col("rows") < 3 * SAMPLE_DOCS)
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    few = few.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_DOCS)
    room = F.greatest(F.length("text") - TRAIN_CHARS, F.lit(0)) + 1
    begin = F.pmod(F.xxhash64("place"), room.cast("bigint")).cast("int") + 1
    run = F.substring(F.col("text"), begin, F.lit(TRAIN_CHARS)).alias("text")
    texts: dict[str, list[str]] = {}
    rows = few.select("lang", "n", run).toArrow().to_pylist()
    for row in sorted(rows, key=lambda r: (r["lang"], r["n"])):
        texts.setdefault(row["lang"], []).append(row["text"])
    most = min(TRAIN_BYTES, TRAIN_BYTES_ALL // max(1, len(texts)))
    cut = {language: shared_out(parts, most) for language, parts in texts.items()}
    return build({language: text for language, text in cut.items() if text.strip()})


def identify(model: Automata, docs: DataFrame, text: str | Column = "text") -> Column:
    """Struct ``lang_pred, score, pieces`` for a text column.

    The score is how much fewer pieces the winner needs than the second, from 0
    to 1 (1 with a single language); ``pieces`` are the winner's per letter.
    Ties go to the first language by code point. A null text, one without a
    letter, or a model without languages gives ``und`` with score 0.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double, pieces double")
    def identified(column: pa.Array) -> pa.Array:
        model = held.value
        texts = [letters_only(t) for t in column.to_pylist()]
        names: list[str] = []
        scores, rates = [np.zeros(0)], [np.zeros(0)]
        for begin, end in blocks(texts, _BLOCK):
            pieces, letters = count_pieces(model, texts[begin:end])
            if not model.languages:
                pieces = np.zeros((end - begin, 1))
            best = pieces.argmin(axis=1)
            ranked = np.sort(pieces, axis=1)
            low = ranked[:, 0]
            second = ranked[:, 1] if pieces.shape[1] > 1 else np.full(len(low), np.inf)
            known = (letters > 0) & bool(model.languages)
            names += [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known, strict=True)]
            scores.append(np.where(known, 1 - low / np.maximum(second, 1), 0.0))
            rates.append(np.where(known, low / np.maximum(letters, 1), 1.0))
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.concatenate(scores)),
             pa.array(np.concatenate(rates))],
            ["lang_pred", "score", "pieces"],
        )

    return identified(text)


def languages(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """Every document with ``held_out, lang_pred, score`` and ``pieces`` per letter.

    One row for each row of ``docs``, repeated ones included; held out are those
    of fold ``held``, of which nothing is learned. A null doc_id gives a null
    ``held_out``. Of the other columns only ``lang`` is read, and only to train.
    """
    model = train(docs, folds, held)
    found = docs.select(F.col("doc_id").cast("bigint"), identify(model, docs).alias("found"))
    return found.select("doc_id", (fold("doc_id", folds) == held).alias("held_out"), "found.*")


def keep_known(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """The documents in a learned language, with all their columns.

    Rejected are texts without a letter and texts that no learned language parses
    into pieces of more than about one letter.
    """
    found = identify(train(docs, folds, held), docs, F.col("text"))
    known = (found["lang_pred"] != UNKNOWN) & (found["pieces"] <= MOST_PIECES)
    return docs.where(known)
