"""Quality rules on repetition inside a document, from the suffix array of its words.

The suffix array is made by prefix doubling over all documents of a batch at once; a document's
number is part of its words' first ranks, so suffixes of different documents never share a prefix.
Only suffixes that still share their rank are sorted again. The ranks of each doubling are kept, and
the longest common prefix of two neighbours is read off them from the longest doubling down. A
stretch of neighbours with a common prefix is an interval; one that is not extended to the left by
the same word everywhere is a maximal repeated substring. Every place of a repeat is covered by the
innermost interval of its suffix, so the union of all repeats' spans takes one value per suffix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from callscope.llm.words import SPACED, Words, row_bytes, words_of

#: Fewer words are no text.
LEAST_WORDS = 50
#: A 3-word window that is found twice marks its words; more than this share of them fails the base rule.
WINDOW, WINDOW_PERCENT = 3, 50
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


@dataclass(frozen=True)
class Limits:
    """Repeats of ``least`` words and more may cover so many percent of a document, and none be longer than ``longest``."""

    least: int = 8
    percent: int = 30
    longest: int = 100


class SuffixArray:
    """Suffixes of the words of some documents in order, and what neighbours have in common."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray) -> None:
        self.bounds = bounds
        self.n = n = len(words)
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        order = np.lexsort((words, doc))
        new = np.ones(n, bool)
        new[1:] = (words[order][1:] != words[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        rank = np.empty(n + 1, np.int32)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1]
        rank[n] = -1
        ends = bounds[1:][doc]
        #: Ranks by the first 1, 2, 4, ... words; place n has none.
        self.levels = [rank]
        open_ = order[self._shared(new)]
        step = 1
        while len(open_):
            rank = rank.copy()
            then = np.where(open_ + step < ends[open_], rank[np.minimum(open_ + step, n)], -1)
            key = rank[open_].astype(np.int64) * (n + 1) + then + 1
            by = np.argsort(key, kind="stable")
            open_, key = open_[by], key[by]
            old = rank[open_]
            group = np.ones(len(open_), bool)
            group[1:] = old[1:] != old[:-1]
            new = np.ones(len(open_), bool)
            new[1:] = key[1:] != key[:-1]
            index = np.arange(len(open_))
            starts = np.maximum.accumulate(np.where(group, index, 0))
            firsts = np.maximum.accumulate(np.where(new, index, 0))
            rank[open_] = old + firsts - starts
            self.levels.append(rank)
            open_ = open_[self._shared(new)]
            step *= 2
        self.places = np.empty(n, np.int64)
        self.places[rank[:n]] = np.arange(n)

    @staticmethod
    def _shared(new: np.ndarray) -> np.ndarray:
        """Which entries are in a group of several; ``new`` marks each group's first."""
        after = np.append(new[1:], True)
        return ~(new & after)

    def common(self, least: int) -> np.ndarray:
        """For each suffix in order, the words it shares with the one before it; 0 where fewer than ``least``."""
        out = np.zeros(self.n, np.int64)
        if self.n < 2:
            return out
        # the level of at most ``least`` words leaves out most neighbours
        level = min(max(least, 1).bit_length() - 1, len(self.levels) - 1)
        rank = self.levels[level]
        at = np.flatnonzero(rank[self.places[1:]] == rank[self.places[:-1]]) + 1
        a, b = self.places[at], self.places[at - 1]
        length = np.zeros(len(at), np.int64)
        for i in range(len(self.levels) - 1, -1, -1):
            rank = self.levels[i]
            x, y = np.minimum(a + length, self.n), np.minimum(b + length, self.n)
            same = (rank[x] == rank[y]) & (x < self.n) & (y < self.n)
            length += np.where(same, 1 << i, 0)
        out[at] = np.where(length >= least, length, 0)
        return out

    def longest_at(self, common: np.ndarray) -> np.ndarray:
        """For each word, the longest repeat that starts there."""
        both = np.maximum(common, np.append(common[1:], 0))
        out = np.zeros(self.n, np.int64)
        out[self.places] = both
        return out

    def maximal(self, words: np.ndarray, common: np.ndarray) -> list[tuple[int, int, int]]:
        """(words, first, last): intervals of suffixes whose common prefix no word before all of them extends."""
        before = np.zeros(self.n, np.uint64)
        before[1:] = words[:-1]
        first_words = np.isin(self.places, self.bounds[:-1])
        own = before[self.places]
        differs = np.ones(self.n, bool)
        differs[1:] = (own[1:] != own[:-1]) | first_words[1:] | first_words[:-1]
        changes = np.cumsum(differs)
        out: list[tuple[int, int, int]] = []
        stack: list[tuple[int, int]] = []
        at = np.flatnonzero(common > 0)
        # intervals end wherever the next neighbours share nothing
        last = -2
        for i, length in zip(at.tolist(), common[at].tolist(), strict=True):
            if i != last + 1:
                self._close(stack, 0, last, changes, out)
            start = self._close(stack, length, i - 1, changes, out)
            if not stack or stack[-1][0] < length:
                stack.append((length, i - 1 if start is None else start))
            last = i
        self._close(stack, 0, last, changes, out)
        return out

    @staticmethod
    def _close(stack: list, length: int, last: int, changes: np.ndarray, out: list) -> int | None:
        """End the intervals with a longer prefix; the first suffix of the widest of them."""
        start = None
        while stack and stack[-1][0] > length:
            own, start = stack.pop()
            if changes[last] > changes[start]:
                out.append((own, start, last))
        return start


def covered(starts_at: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in one of the stretches."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, starts_at, 1)
    np.add.at(depth, starts_at + lengths, -1)
    return np.cumsum(depth)[:-1] > 0


def _per_row(words: Words, marks: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(marks)])
    return sums[words.bounds[1:]] - sums[words.bounds[:-1]]


def _copied_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r")]
    return len(lines) - len(set(lines))


def _figures(words: Words, offsets: np.ndarray, limits: Limits, with_repeats: bool) -> dict[str, list | np.ndarray]:
    """The columns of some documents; ``offsets`` are their places in ``words.data``."""
    data = words.data

    def per_text(of_byte: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(of_byte[data])])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    first_bytes = (np.arange(256) & 0xC0) != 0x80
    n = len(words.hashes)
    n_words = np.diff(words.bounds)
    suffixes = SuffixArray(words.hashes, words.bounds)
    common = suffixes.common(min(WINDOW, limits.least))
    longest = suffixes.longest_at(common)
    windows = np.flatnonzero(longest >= WINDOW)
    repeats = np.flatnonzero(longest >= limits.least)
    filled = n_words > 0
    most = np.zeros(words.rows, np.int64)
    if n:
        most[filled] = np.maximum.reduceat(longest, words.bounds[:-1][filled])
    raw = data.tobytes()
    out = {
        "n_words": n_words,
        "word_chars": per_text(first_bytes & ~SPACED.separator),
        "n_symbols": per_text(_SYMBOLS),
        "n_dup_lines": np.array([_copied_lines(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.int64),
        "n_repeat_words": _per_row(words, covered(windows, np.full(len(windows), WINDOW), n)),
        "n_covered": _per_row(words, covered(repeats, longest[repeats], n)),
        "longest_repeat": np.where(most >= limits.least, most, 0),
    }
    failed = (n_words < LEAST_WORDS) | (100 * out["n_repeat_words"] > WINDOW_PERCENT * n_words)
    too_much = (100 * out["n_covered"] > limits.percent * n_words) | (out["longest_repeat"] > limits.longest)
    out |= {"base_failed": failed, "kept": ~failed & ~too_much}
    if with_repeats:
        out["repeats"] = _listed(words, suffixes, np.where(common >= limits.least, common, 0))
    return out


def _listed(words: Words, suffixes: SuffixArray, common: np.ndarray) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(words.rows)]
    for length, first, last in suffixes.maximal(words.hashes, common):
        places = np.sort(suffixes.places[first : last + 1])
        row = int(np.searchsorted(words.bounds, places[0], side="right")) - 1
        out[row].append({"length": length, "times": last - first + 1, "start": int(places[0] - words.bounds[row])})
    return [sorted(r, key=lambda x: (x["start"], -x["length"])) for r in out]


_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat")
_FLAGS = ("base_failed", "kept")
_REPEAT = ("length", "times", "start")


def repetition_rules(
    docs: DataFrame, limits: Limits = Limits(), id_column: str = "doc_id", text: str = "text", with_repeats: bool = False
) -> DataFrame:
    """Per document: figures on repetition, ``base_failed``, and ``kept``.

    ``n_covered`` words lie in repeated substrings of ``limits.least`` words and more, first ones
    included; ``longest_repeat`` is the longest of them in words, 0 if there is none; occurrences may
    overlap. A document is kept unless the base rule fails, or they cover more than
    ``limits.percent`` of its words, or the longest has more than ``limits.longest`` words.
    ``with_repeats`` adds the maximal repeated substrings: words, occurrences, first word's number.

    Null, empty and blank texts have no words and fail the base rule. Equal rows each get their
    result; ids are passed on, null or not. An empty table gives no rows. Documents are independent:
    no shuffle, and a task holds the words of 2 MiB of texts, or of one longer text.
    """
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    kinds = [*((n, T.LongType()) for n in _LONGS), *((n, T.BooleanType()) for n in _FLAGS)]
    arrow = [*[pa.int64()] * len(_LONGS), *[pa.bool_()] * len(_FLAGS)]
    if with_repeats:
        kinds.append(("repeats", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in _REPEAT]))))
        arrow.append(pa.list_(pa.struct([(n, pa.int64()) for n in _REPEAT])))
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(n, k) for n, k in kinds)])

    def run(batches):
        for batch in batches:
            _, offsets = row_bytes(batch.column(1))
            for words in words_of(batch.column(1), SPACED):
                own = offsets[words.first_row : words.first_row + words.rows + 1]
                figures = _figures(words, own - own[0], limits, with_repeats)
                arrays = [pa.array(figures[n], k) for (n, _), k in zip(kinds, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(words.first_row, words.rows), *arrays], names=schema.names)

    return rows.mapInArrow(run, schema)
