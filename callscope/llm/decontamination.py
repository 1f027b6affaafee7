"""Benchmark decontamination with a generalised suffix automaton of the test items.

Documents stream through the automaton word by word. It holds the longest suffix of what was read
that occurs in an item; where that suffix has ``window`` words or more, the last ``window`` of them
are contaminated. An item of fewer words counts where it occurs whole. The items are split into
automata of at most ``MAX_AUTOMATON_WORDS`` words, and documents pass through one after the other,
so what is sent to the executors at once has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscope.llm.work import free_prefix
from callscope.llm.words import PLAIN_LOWER, Words, words_of

WINDOW = 10
MAX_AUTOMATON_WORDS = 500_000


class Automaton:
    """Suffix automaton of several word sequences, with the items in which each window occurs."""

    def __init__(self, items: list[tuple[object, np.ndarray]], window: int) -> None:
        self.window = window
        self.shortest = min((min(len(words), window) for _, words in items if len(words)), default=0)
        self.vocabulary = np.unique(np.concatenate([np.empty(0, np.uint64), *(w for _, w in items)]))
        coded = [(item, np.searchsorted(self.vocabulary, words)) for item, words in items if len(words)]
        self.pairs = np.unique(
            np.concatenate([np.empty(0, np.int64), *((c[:-1] << 32) | c[1:] for _, c in coded)])
        )
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, codes in coded:
            last = 0
            for code in codes.tolist():
                last = self._add(last, code)
        self._find_items(coded)

    def _add(self, last: int, code: int) -> int:
        to = self.next[last].get(code)
        if to is not None:
            return to if self.length[to] == self.length[last] + 1 else self._split(last, code, to)
        new = self._state({}, self.length[last] + 1, 0)
        at = last
        while at >= 0 and code not in self.next[at]:
            self.next[at][code] = new
            at = self.link[at]
        if at >= 0:
            to = self.next[at][code]
            whole = self.length[to] == self.length[at] + 1
            self.link[new] = to if whole else self._split(at, code, to)
        return new

    def _state(self, following: dict[int, int], length: int, link: int) -> int:
        self.next.append(following)
        self.length.append(length)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, at: int, code: int, to: int) -> int:
        """The shorter strings of state ``to`` get a state of their own."""
        copy = self._state(dict(self.next[to]), self.length[at] + 1, self.link[to])
        self.link[to] = copy
        while at >= 0 and self.next[at].get(code) == to:
            self.next[at][code] = copy
            at = self.link[at]
        return copy

    def _find_items(self, coded: list[tuple[object, np.ndarray]]) -> None:
        """For each state, the windows that are suffixes of its strings, with their items."""
        ends: dict[int, dict[int, set]] = {}
        for item, codes in coded:
            size, state = min(len(codes), self.window), 0
            for n, code in enumerate(codes.tolist(), 1):
                state = self.next[state][code]
                if n >= size:
                    at = state
                    while self.length[self.link[at]] >= size:
                        at = self.link[at]
                    ends.setdefault(at, {}).setdefault(size, set()).add(item)
        self.found: list[tuple[tuple[int, tuple], ...]] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            own = tuple((n, tuple(items)) for n, items in ends.get(state, {}).items())
            self.found[state] = self.found[self.link[state]] + own

    def stream(self, codes: list[int]) -> Iterator[tuple[int, int, tuple]]:
        """Position, length and items of every window that ends in the sequence."""
        state = matched = 0
        following, link, length, found = self.next, self.link, self.length, self.found
        for i, code in enumerate(codes):
            to = following[state].get(code)
            while to is None and state:
                state = link[state]
                matched = length[state]
                to = following[state].get(code)
            if to is None:
                continue
            state, matched = to, matched + 1
            for n, items in found[state]:
                if n <= matched:
                    yield i, n, items

    def hits(self, words: Words) -> tuple[np.ndarray, list[set]]:
        """Which words are in a window, and each row's items with occurring windows.

        Only runs of words that follow each other somewhere in the items reach the automaton.
        """
        hit = np.zeros(len(words.hashes), bool)
        items: list[set] = [set() for _ in range(words.rows)]
        if not len(self.vocabulary) or not len(hit):
            return hit, items
        codes = np.minimum(np.searchsorted(self.vocabulary, words.hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[codes] == words.hashes
        row = words.row_of_word()
        joined = known[:-1] & known[1:] & (row[:-1] == row[1:])
        if self.shortest > 1 and len(self.pairs):
            pair = (codes[:-1] << 32) | codes[1:]
            at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
            joined &= self.pairs[at] == pair
        starts = np.flatnonzero(known & np.r_[True, ~joined])
        ends = np.flatnonzero(known & np.r_[~joined, True]) + 1
        long = ends - starts >= self.shortest
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            for i, n, found in self.stream(codes[start:end].tolist()):
                hit[start + i - n + 1 : start + i + 1] = True
                items[row[start]].update(found)
        return hit, items


def _automata(benchmark: DataFrame, item: str, text: str, window: int) -> Iterator[Automaton]:
    """Automata of at most MAX_AUTOMATON_WORDS words, one at a time; a longer item has its own."""
    group: list[tuple[object, np.ndarray]] = []
    size = 0
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).cast("string").alias("t"))
    for r in rows.toLocalIterator():
        (words,) = words_of(pa.array([r.t], pa.string()), PLAIN_LOWER)
        if group and size + len(words.hashes) > MAX_AUTOMATON_WORDS:
            yield Automaton(group, window)
            group, size = [], 0
        group.append((r.i, words.hashes))
        size += len(words.hashes)
    yield Automaton(group, window)


def _marker(shared, text: str, n_words: str, hits: str, items: str, kind: pa.DataType):
    def mark(batches):
        automaton = shared.value
        for batch in batches:
            counts, bits, found = [], [], []
            earlier = batch.column(batch.schema.get_field_index(hits)).to_pylist() if hits in batch.schema.names else None
            for words in words_of(batch.column(batch.schema.get_field_index(text)), PLAIN_LOWER):
                hit, own = automaton.hits(words)
                counts.append(np.diff(words.bounds))
                found += own
                bits += [
                    np.packbits(hit[a:b]).tobytes() if own[i] else None
                    for i, (a, b) in enumerate(zip(words.bounds[:-1], words.bounds[1:], strict=True))
                ]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            if earlier is not None:
                before = columns[items].to_pylist()
                found = [own | set(old or ()) for own, old in zip(found, before, strict=True)]
                bits = [_either(a, b) for a, b in zip(bits, earlier, strict=True)]
            columns[n_words] = pa.array(np.concatenate(counts) if counts else [], pa.int64())
            columns[hits] = pa.array(bits, pa.binary())
            columns[items] = pa.array([list(x) for x in found], pa.list_(kind))
            yield pa.RecordBatch.from_pydict(columns)

    return mark


def _either(a: bytes | None, b: bytes | None) -> bytes | None:
    if a is None or b is None:
        return a or b
    return (np.frombuffer(a, np.uint8) | np.frombuffer(b, np.uint8)).tobytes()


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    prefix: str = "_",
) -> DataFrame:
    """The documents with ``_n_words``, ``_n_hit``, ``_items`` (sorted as strings) and ``_hits``.

    ``_hits`` has one bit per word, null if none is hit. Null and empty texts have no words and no
    hit; equal rows each get their own result; without benchmark rows nothing is hit, and items
    without an id or without words are passed over. Ids may be of any type that casts to a string. Columns of the documents keep their values;
    where one starts with ``_``, choose another prefix for the four.
    """
    spark = docs.sparkSession
    n_words, n_hit, items, hits = (prefix + n for n in ("n_words", "n_hit", "items", "hits"))
    whole = isinstance(benchmark.schema[item].dataType, T.IntegralType)
    kind, arrow = (T.LongType(), pa.int64()) if whole else (T.StringType(), pa.string())
    benchmark = benchmark.where(F.col(item).isNotNull()).withColumn(item, F.col(item).cast(kind))
    added = [(n_words, T.LongType()), (hits, T.BinaryType()), (items, T.ArrayType(kind))]
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, k) for n, k in added)])
    out = docs
    for automaton in _automata(benchmark, item, item_text, window):
        shared = spark.sparkContext.broadcast(automaton)
        out = out.mapInArrow(_marker(shared, text, n_words, hits, items, arrow), schema)
    ids = F.array_sort(F.transform(items, lambda i: i.cast("string")))
    return out.withColumns({items: ids, n_hit: _ones(F.col(hits))})


def _ones(bits):
    """Set bits of a binary column, zero for null."""
    digits = F.hex(bits)
    for digit, n in zip("0123456789ABCDEF", (bin(i).count("1") for i in range(16)), strict=True):
        digits = F.replace(digits, F.lit(digit), F.lit("|" * n)) if n else F.replace(digits, F.lit(digit), F.lit(""))
    return F.coalesce(F.length(digits), F.lit(0)).cast("long")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, max_coverage: float = 0.0, text: str = "text", **options
) -> DataFrame:
    """Documents without benchmark passages, with the columns they came with.

    A document in which more than ``max_coverage`` of the words are hit goes; of the others the hit
    words are removed, and what remains is joined by single spaces. Documents without a hit stay as
    they are, whatever their text. At 0, the default, every document with a hit goes.
    """
    prefix = free_prefix(docs.columns)
    marked = contamination(docs, benchmark, text=text, prefix=prefix, **options)
    kept = marked.where(F.col(prefix + "n_hit") <= F.col(prefix + "n_words") * F.lit(max_coverage))
    if max_coverage > 0:
        kept = kept.mapInArrow(_cutter(text, prefix + "hits"), kept.schema)
    return kept.select(*docs.columns)


def _cutter(text: str, hits: str):
    def cut(batches):
        for batch in batches:
            at = batch.schema.get_field_index(text)
            texts, bits = batch.column(at).to_pylist(), batch.column(hits).to_pylist()
            for i, hit in enumerate(bits):
                if hit:
                    (words,) = words_of(pa.array([texts[i]]), PLAIN_LOWER)
                    keep = ~np.unpackbits(np.frombuffer(hit, np.uint8), count=len(words.hashes)).astype(bool)
                    raw = words.data.tobytes()
                    parts = zip(words.starts[keep].tolist(), words.ends[keep].tolist(), strict=True)
                    texts[i] = b" ".join(raw[a:b] for a, b in parts).decode()
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return cut


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: words, hit words, items with occurring windows and their hash."""
    marked = contamination(docs.select("doc_id", "text"), benchmark)
    return marked.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        F.col("_n_hit").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
        (F.col("_n_hit") > 0).alias("contaminated"),
    )
