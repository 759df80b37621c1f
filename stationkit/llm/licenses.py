"""License scans: winnowed fingerprints pick templates, banded alignment measures them.

Texts and templates are cut into grams of five words. Winnowing keeps the smallest
hash of every three neighbours, so that any seven words in common leave a common
fingerprint. An inverted index from fingerprint to template places gives
candidates; those with enough prints along one band of diagonals are aligned with
the text, many at a time. Notices too short for that are found by their word
pairs: words that differ each cost two pairs at most, which tells how many pairs
of a notice must be left.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationkit.llm.arrays import Words, blocks, sequence_hash, text_bytes
from stationkit.llm.decontamination import plain_words

GRAM = 5
WINDOW = 3
# Templates of fewer words are found by all their pairs of neighbouring words.
SHORT = 32
PAIR = 2
# From so many words on, a template needs two prints along one band.
LONG = 40
# Diagonals on either side of a candidate's own that the alignment may use.
BAND = 6
LEAST_COVERAGE = 0.7
# Candidates are aligned so many at a time.
ROWS = 1 << 16
# Templates are known to every task, so a table of them may hold so many characters.
TEMPLATE_CHARS = 32_000_000

# Wording of common licenses and license notices.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the \"Software\"), to deal in the Software "
    "without restriction, including without limitation the rights to use, copy, modify, merge, "
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
    "persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this "
    "permission notice appear in all copies."
)
_BSD_GRANT = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:"
)
_BSD_TWO = (
    " 1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce "
    "the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_BSD_THIRD = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used "
    "to endorse or promote products derived from this software without specific prior written "
    "permission."
)
_BSD_DISCLAIMER = (
    " THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
    "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "mit": _MIT_GRANT,
    "mit-text": _MIT_GRANT + (
        " The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
        "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR "
        "IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the "
        "License for the specific language governing permissions and limitations under the "
        "License."
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "gpl-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version. This program is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details. You should have received a copy of the GNU "
        "General Public License along with this program. If not, see "
        "https://www.gnu.org/licenses/."
    ),
    "bsd": _BSD_GRANT,
    "bsd-2-clause-text": _BSD_GRANT + _BSD_TWO + _BSD_DISCLAIMER,
    "bsd-3-clause-text": _BSD_GRANT + _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER,
    "isc": _ISC_GRANT,
    "isc-text": _ISC_GRANT + (
        " THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD "
        "TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO "
        "EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL "
        "DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
        "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event "
        "will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions: 1. The origin of this software must not be misrepresented; you "
        "must not claim that you wrote the original software. If you use this software in a "
        "product, an acknowledgment in the product documentation would be appreciated but is not "
        "required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or "
        "altered from any source distribution."
    ),
}


def winnow(grams: np.ndarray) -> np.ndarray:
    """Places of the grams that are the last smallest of some window."""
    if len(grams) <= WINDOW:
        return np.flatnonzero(grams == grams.min())[-1:] if len(grams) else np.zeros(0, np.int64)
    table = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
    last = WINDOW - 1 - table[:, ::-1].argmin(axis=1)
    return np.unique(np.arange(len(table)) + last)


@dataclass(frozen=True)
class Prints:
    """Inverted index from sorted fingerprints to template numbers and places."""

    width: int
    values: np.ndarray
    owner: np.ndarray
    place: np.ndarray


@dataclass(frozen=True)
class Index:
    """Templates as word hashes, the prints each needs on one band, and the indexes."""

    names: list[str]
    words: list[np.ndarray]
    least: np.ndarray
    pairs: Prints
    grams: Prints


def build_index(templates: dict[str, str]) -> Index:
    """Index of all templates that have at least two words."""
    names = sorted(templates)
    found = plain_words([templates[n].encode("utf-8", "replace") for n in names])
    kept, words, least = [], [], []
    parts: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {PAIR: [], GRAM: []}
    for name, first, count in zip(names, found.firsts, found.counts, strict=True):
        if count < PAIR:
            continue
        own = found.hashes[first : first + count]
        width = PAIR if count < SHORT else GRAM
        grams = sequence_hash([own[i : count - width + 1 + i] for i in range(width)])
        at = np.arange(len(grams)) if count < SHORT else winnow(grams)
        parts[width].append((grams[at], np.full(len(at), len(kept)), at))
        changed = int(count) - math.ceil(LEAST_COVERAGE * count)
        least.append(max(1, count - 1 - 2 * changed) if count < SHORT else 1 + (count >= LONG))
        kept.append(name)
        words.append(own)

    def prints(width: int) -> Prints:
        none = np.zeros(0, np.int64)
        columns = zip(*parts[width], strict=True) if parts[width] else ([none],) * 3
        values, owner, place = map(np.concatenate, columns)
        order = np.argsort(values, kind="stable")
        return Prints(width, values[order].astype(np.uint64), owner[order], place[order])

    return Index(kept, words, np.array(least, np.int64), prints(PAIR), prints(GRAM))


# One number holds score, matched words and distance of the start from 2^24, so that
# the larger one is the better one: by score, then by matches, then the earlier start.
_SCORE, _HIT = 1 << 44, 1 << 24


def banded_alignment(
    template: np.ndarray, words: np.ndarray, begin: np.ndarray, low: np.ndarray, high: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matched words, first, last) of the best alignment at each place in ``words``.

    A place is where the template's first word would be, and may use words from
    ``low`` up to before ``high``. Matches count 2, gaps and changes -1; the
    template may begin and end anywhere. All places advance together, one word
    of the template at a time; the best gap along the text is a running maximum.
    """
    offsets = np.arange(2 * BAND + 1)
    slope = offsets * _SCORE
    above = np.zeros((len(begin), len(offsets) + 1), dtype=np.int64)
    best, last = np.zeros(len(begin), dtype=np.int64), np.zeros(len(begin), dtype=np.int64)
    rows = np.arange(len(begin))
    for i, word in enumerate(template):
        at = (begin + i - BAND)[:, None] + offsets
        inside = (at >= low[:, None]) & (at < high[:, None])
        same = inside & (words[np.clip(at, 0, len(words) - 1)] == word)
        diagonal = above[:, :-1]
        started = np.where(diagonal > 0, diagonal, _HIT - 1 - i - offsets)
        here = np.where(same, started + 2 * _SCORE + _HIT, diagonal - _SCORE)
        here = np.maximum(np.maximum(here, above[:, 1:] - _SCORE), 0)
        here = np.maximum.accumulate(here + slope, axis=1) - slope
        here[(here < _SCORE) | ~inside] = 0
        above[:, :-1] = here
        top = here.argmax(axis=1)
        value = here[rows, top]
        better = value // _SCORE > best // _SCORE
        best[better], last[better] = value[better], i + top[better]
    origin = begin - BAND
    return best % _SCORE // _HIT, origin + _HIT - 1 - best % _HIT, origin + last


def _spots(prints: Prints, words: Words, winnowed: bool) -> tuple[np.ndarray, ...]:
    """Template, text and place of its first word for every print that the texts share."""
    none = (np.zeros(0, np.int64),) * 3
    n = len(words.hashes) - prints.width + 1
    if n <= 0 or not len(prints.values):
        return none
    grams = sequence_hash([words.hashes[i : n + i] for i in range(prints.width)])
    first = np.searchsorted(prints.values, grams)
    first[first == len(prints.values)] = 0
    known = prints.values[first] == grams
    known &= words.texts[:n] == words.texts[prints.width - 1 :]
    if winnowed:
        # A text is winnowed on its own, and only where some gram is in the index at all.
        printed = np.zeros(n, dtype=bool)
        for t in np.unique(words.texts[:n][known]):
            begin = int(words.firsts[t])
            own = grams[begin : begin + int(words.counts[t]) - prints.width + 1]
            printed[begin + winnow(own)] = True
        known &= printed
    at = np.flatnonzero(known)
    first = first[at]
    many = np.searchsorted(prints.values, prints.values[first], side="right") - first
    pick = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    at = np.repeat(at, many)
    return prints.owner[pick], words.texts[at], at - prints.place[pick]


def _candidates(index: Index, words: Words) -> tuple[np.ndarray, ...]:
    """Template, text, place and prints of every place that has enough prints on its band."""
    found = zip(_spots(index.pairs, words, False), _spots(index.grams, words, True), strict=True)
    template, text, begin = map(np.concatenate, found)
    margin = max((len(w) for w in index.words), default=0) + 2 * BAND
    span = len(words.hashes) + 2 * margin
    key = np.sort((template * len(words.counts) + text) * span + begin + margin)
    spot, own = np.unique(key, return_counts=True)
    count = np.searchsorted(key, spot + BAND, side="right") - np.searchsorted(key, spot - BAND)
    template, text = np.divmod(spot // span, max(len(words.counts), 1))
    keep = count >= index.least[template] if len(spot) else np.zeros(0, bool)
    return template[keep], text[keep], (spot % span - margin)[keep], own[keep]


def scan(index: Index, texts: list[bytes]) -> list[tuple[int, str, int, int, float, int, int]]:
    """(text number, template, matched, template words, coverage, first word, last word).

    Of places near each other the one with more prints goes first, then the
    earlier one; a place that is found takes its words out for later ones.
    """
    words = plain_words(texts)
    templates, text, begin, count = _candidates(index, words)
    firsts, out = words.firsts, []
    for k in np.unique(templates):
        own = np.flatnonzero(templates == k)
        size = len(index.words[k])
        # Places further apart than this have no word in common.
        new = np.ones(len(own), dtype=bool)
        new[1:] = (text[own][1:] != text[own][:-1]) | (
            np.diff(begin[own]) > size + 2 * BAND
        )
        group = np.cumsum(new)
        own = own[np.lexsort((begin[own], -count[own], group))]
        rank = np.arange(len(own)) - np.searchsorted(group, group)
        own = own[np.argsort(rank, kind="stable")]
        turns = np.concatenate(([0], np.cumsum(np.bincount(rank))))
        free, taken = words.hashes.copy(), np.zeros(len(words.hashes), dtype=bool)
        for a, b in zip(turns[:-1], turns[1:], strict=True):
            for part in range(a, b, ROWS):
                now = own[part : min(part + ROWS, b)]
                while len(now):
                    low = firsts[text[now]]
                    high = low + words.counts[text[now]]
                    middle = np.clip(begin[now] + size // 2, low, high - 1)
                    hits, first, last = banded_alignment(
                        index.words[k], free, begin[now], low, high
                    )
                    good = np.flatnonzero((hits >= LEAST_COVERAGE * size) & ~taken[middle])
                    again = []
                    for g in good:
                        place = slice(int(first[g]), int(last[g]) + 1)
                        if taken[place].any():
                            continue
                        taken[place] = True
                        # A place found already must not hide the next one within the band.
                        free[place] = 0
                        start, h = int(low[g]), int(hits[g])
                        out.append((int(text[now[g]]), index.names[k], h, size, h / size,
                                    place.start - start, place.stop - 1 - start))
                        if not taken[middle[g]]:
                            again.append(now[g])
                    # A neighbour was found in place of the candidate itself.
                    now = np.array(again, dtype=np.int64)
    return out


def read_templates(table: DataFrame) -> dict[str, str]:
    """Templates from a table with ``name`` and ``text``.

    Rows without name or text are left out, equal rows count once. A name with
    several texts is an error, and so are more than ``TEMPLATE_CHARS`` characters,
    since every task holds the templates.
    """
    rows = table.select("name", "text").where("name IS NOT NULL AND text IS NOT NULL").distinct()
    chars = rows.agg(F.sum(F.length("name") + F.length("text") + 1).alias("n")).first()["n"] or 0
    if chars > TEMPLATE_CHARS:
        raise ValueError(f"templates of {chars} characters, at most {TEMPLATE_CHARS} are taken")
    found = rows.collect()
    templates = {r["name"]: r["text"] for r in found}
    if len(templates) < len(found):
        raise ValueError("a template name has several texts")
    return templates


def license_spans(
    docs: DataFrame, templates: dict[str, str] | DataFrame | None = None
) -> DataFrame:
    """Places where documents hold license templates.

    One row for each place: ``doc_id, template, matched, template_words, coverage``
    (matched / template words, at least 0.7) and ``first_word, last_word``, counted
    from 0 in words of letters and digits. Templates of 32 words and more need a
    common fingerprint, which any seven words in a row leave, and those of 40 and
    more two along one band; shorter ones need as many word pairs as are left
    when three of ten words differ. Templates of one word are not looked for.

    Null, empty or wordless texts hold nothing; equal rows each give their own
    result rows; a null doc_id is kept as null. ``templates`` is a small set by
    name, or a table that ``read_templates`` takes; an empty one finds nothing.
    """
    if isinstance(templates, DataFrame):
        templates = read_templates(templates)
    index = build_index(TEMPLATES if templates is None else templates)
    held = docs.sparkSession.sparkContext.broadcast(index)
    names = ["doc_id", "template", "matched", "template_words", "coverage", "first_word", "last_word"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]

    def run(batches):
        for batch in batches:
            texts, ids, rows = text_bytes(batch.column("text")), batch.column("doc_id"), []
            for begin, end in blocks(texts):
                rows += [
                    (ids[begin + t].as_py(), *found) for t, *found in scan(held.value, texts[begin:end])
                ]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run,
        "doc_id bigint, template string, matched bigint, template_words bigint, coverage double, "
        "first_word bigint, last_word bigint",
    )
