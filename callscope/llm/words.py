"""Words, word hashes and shingle hashes of whole Arrow columns, without a Python object per word.

A word's hash is a polynomial over its bytes, taken from one running sum over the bytes of many
rows and mixed afterwards, so it depends on the word alone. All hashes are unsigned 64-bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes handled at once; a longer row is handled alone.
CHUNK_BYTES = 1 << 21
_BASE = 0x9E3779B97F4A7C15
_GRAM = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Alphabet:
    """Which bytes separate words, and what each other byte counts as."""

    separator: np.ndarray
    folded: np.ndarray


def _alphabet(is_separator, lower: bool) -> Alphabet:
    folded = np.arange(256, dtype=np.uint8)
    if lower:
        folded[65:91] += 32
    return Alphabet(np.array([is_separator(b) for b in range(256)]), folded)


def _is_space(byte: int) -> bool:
    return byte == 0x20 or 0x09 <= byte <= 0x0D


def _is_mark(byte: int) -> bool:
    return byte < 0x80 and not chr(byte).isalnum()


#: Words end at ASCII white space.
SPACED = _alphabet(_is_space, lower=False)
SPACED_LOWER = _alphabet(_is_space, lower=True)
#: Words are ASCII letters, digits and all characters beyond ASCII.
PLAIN_LOWER = _alphabet(_is_mark, lower=True)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse, as many as the longest row so far needs."""

    def __init__(self) -> None:
        self.n = 0
        self.up = self.down = np.empty(0, np.uint64)

    def reach(self, n: int) -> None:
        if n > self.n:
            self.n = max(n, CHUNK_BYTES)
            for name, factor in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(self.n, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


_POWERS = _Powers()


@dataclass
class Words:
    """The words of some rows: word i is ``data[starts[i]:ends[i]]``, row r has words bounds[r] to bounds[r + 1]."""

    first_row: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))


def row_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_binary())
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _words(first_row: int, data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Words:
    n = len(data)
    if n == 0:
        none = np.empty(0, np.int64)
        return Words(first_row, data, none, none, np.zeros(len(offsets), np.int64), np.empty(0, np.uint64))
    live = ~alphabet.separator[data]
    before = np.zeros(n, bool)
    before[1:] = live[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = live[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(live & ~before)
    ends = np.flatnonzero(live & ~after) + 1
    _POWERS.reach(n)
    terms = alphabet.folded[data].astype(np.uint64)
    terms += np.uint64(1)
    terms *= _POWERS.up[:n]
    sums = np.cumsum(terms)
    hashes = (sums[ends - 1] - sums[starts] + terms[starts]) * _POWERS.down[starts]
    hashes += (ends - starts).astype(np.uint64) * _GRAM
    return Words(first_row, data, starts, ends, np.searchsorted(starts, offsets), mix(hashes))


def words_of(column, alphabet: Alphabet) -> Iterator[Words]:
    """The words of all rows of a string column, some rows at a time."""
    data, offsets = row_bytes(column)
    rows, at = len(offsets) - 1, 0
    while at < rows:
        upto = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1
        upto = min(max(upto, at + 1), rows)
        part = offsets[at : upto + 1]
        yield _words(at, data[part[0] : part[-1]], part - part[0], alphabet)
        at = upto


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """The hash of the k words from each position on."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= _GRAM
        out += hashes[j : j + n]
    return mix(out)


def whole_grams(words: Words, k: int) -> np.ndarray:
    """True for each position of ``grams`` whose k words are of one row."""
    row = words.row_of_word()
    return row[: max(len(row) - k + 1, 0)] == row[k - 1 :]
