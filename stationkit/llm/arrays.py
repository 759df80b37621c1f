"""Numpy helpers over a block of texts, for use inside Arrow tasks.

Texts are handled as UTF-8 bytes. Words are maximal runs of bytes other than
space, tab, line feed, vertical tab, form feed and carriage return. A word is
known by a 64-bit hash of its bytes, so that a block of texts is worked on with
array operations instead of a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

# Texts are worked on in blocks of about this many bytes, which bounds memory.
BLOCK_BYTES = 1 << 20

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salts(n: int, seed: int = 0) -> np.ndarray:
    """Fixed odd multipliers."""
    steps = np.arange(1 + seed * 4096, n + 1 + seed * 4096, dtype=np.uint64)
    return mix(steps * _GOLDEN) | np.uint64(1)


@cache
def _byte_values() -> np.ndarray:
    return salts(256, 7)


@cache
def _space_table() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


_powers = np.ones(1, dtype=np.uint64)


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        base = np.full(max(n, 64), salts(1, 9)[0], dtype=np.uint64)
        base[0] = 1
        _powers = np.multiply.accumulate(base)
    return _powers


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column; a null text is an empty one."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts that hold about ``limit`` bytes."""
    begin = held = 0
    for i, text in enumerate(texts):
        if i > begin and held + len(text) > limit:
            yield begin, i
            begin, held = i, 0
        held += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


@dataclass(frozen=True)
class Words:
    """Words of a block of texts, in order: hash, text number, byte range in ``data``."""

    hashes: np.ndarray
    texts: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    data: np.ndarray

    @property
    def firsts(self) -> np.ndarray:
        """Number of the first word of each text."""
        return np.cumsum(self.counts) - self.counts


def sequence_hash(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each position from the hashes at its 1st, 2nd … part."""
    keys = salts(len(parts) + 1, len(parts))
    total = np.full(len(parts[0]), keys[-1], dtype=np.uint64)
    for part, key in zip(parts, keys[:-1], strict=True):
        total = total + part * key
    return mix(total)


def split_words(texts: list[bytes], lower: bool = True) -> Words:
    """Find and hash the words of some texts; ``lower`` maps A-Z to a-z first."""
    joined = b"\n".join(texts)
    data = np.frombuffer(joined.lower() if lower else joined, dtype=np.uint8)
    edges = np.cumsum([0] + [len(t) + 1 for t in texts])
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~_space_table()[data]
    change = np.diff(inside)
    starts, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    owner = np.searchsorted(edges, starts, side="right") - 1
    counts = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    if not len(starts):
        return Words(np.zeros(0, np.uint64), owner, starts, ends, counts, data)
    lengths = ends - starts
    first = np.cumsum(lengths) - lengths
    value = _byte_values()[data[inside[1:-1].astype(bool)]]
    place = np.arange(len(value)) - np.repeat(first, lengths)
    value *= _power_table(int(lengths.max()) + 1)[place]
    hashes = mix(np.add.reduceat(value, first) + lengths.astype(np.uint64))
    return Words(hashes, owner, starts, ends, counts, data)


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every text, one after the other, and their counts.

    A text with fewer than ``width`` words, but not none, has one shingle: all
    its words.
    """
    n = len(words.hashes)
    found = np.zeros(0, np.uint64)
    if n >= width:
        found = sequence_hash([words.hashes[i : n - width + 1 + i] for i in range(width)])
    out, sizes = [], np.zeros(len(words.counts), dtype=np.int64)
    for i, (first, count) in enumerate(zip(words.firsts, words.counts, strict=True)):
        if not count:
            continue
        if count < width:
            own = sequence_hash([words.hashes[j : j + 1] for j in range(first, first + count)])
        else:
            own = np.sort(found[first : first + count - width + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        out.append(own)
        sizes[i] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), sizes


def long_lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """An Arrow column of lists of longs."""
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))
