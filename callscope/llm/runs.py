"""Periodic runs of words, found on a grammar of each document.

Re-Pair replaces the most frequent pair of neighbouring symbols by a nonterminal until no pair of a
document occurs twice. What is left of a document is halved until one symbol derives it. A run lies
in some smallest node of that derivation and crosses the node's boundary, so it is enough to look at
the boundary of every nonterminal once: a run of exponent 4 or more has a square right of the
boundary or left of it, which is a comparison of two hashes for each period, and two searches give
how far the period reaches inside the nonterminal. What is found is translated to every place that
the nonterminal derives; intervals of one period that overlap by it are parts of one run.

All documents of a batch go through the same array operations. A round replaces every pair that is
more frequent than all pairs it overlaps with; that gives what replacing one pair after the other
would, since a replacement changes overlapping pairs only and never makes a pair more frequent.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscope.llm.words import SPACED, Words, mix, words_of

#: A run repeats its period at least so often, and has so many words.
EXPONENT = 4
LEAST_WORDS = 6
#: Comparisons made at once.
_AT_ONCE = 1 << 22
_PAIR, _DOC, _BASE = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93), 0xA24BAED4963EE407


@dataclass
class Nodes:
    """Nodes of derivations: words lo to mid and mid to hi; nodes with one key derive the same words."""

    key: np.ndarray
    lo: np.ndarray
    mid: np.ndarray
    hi: np.ndarray


def _concatenated(parts: list[Nodes]) -> Nodes:
    none = Nodes(np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
    return Nodes(*(np.concatenate([getattr(p, f) for p in [none, *parts]]) for f in ("key", "lo", "mid", "hi")))


class RePair:
    """The grammars of some documents; a symbol is a hash, of a word or of the pair it replaces."""

    def __init__(self, words: np.ndarray, bounds: np.ndarray) -> None:
        n = len(words)
        self.bounds = bounds
        self.doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.symbol = words.copy()
        #: Place n stands for "nothing here".
        self.following = np.arange(1, n + 2)
        self.before = np.concatenate([[n], np.arange(0, n)])
        filled = np.diff(bounds) > 0
        self.following[bounds[1:][filled] - 1] = n
        self.before[bounds[:-1][filled]] = n
        self.end = np.arange(1, n + 1)
        self.alive = np.ones(n + 1, bool)
        self.alive[n] = False
        self.made: list[Nodes] = []
        active = np.arange(n)
        while len(active):
            active = self._round(active[self.following[active] < n])

    def _round(self, at: np.ndarray) -> np.ndarray:
        """Replace what beats its neighbours among the pairs that start here; the pairs to look at next."""
        n = len(self.symbol)
        pair = mix(self.symbol[at] * _PAIR + self.symbol[self.following[at]])
        key = mix(pair ^ (self.doc[at].astype(np.uint64) * _DOC))
        order = np.argsort(key)
        ordered = key[order]
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(at) else np.empty(0, np.int64)
        sizes = np.diff(np.append(starts, len(at)))
        often = np.repeat(sizes > 1, sizes)
        if not often.any():
            return np.empty(0, np.int64)
        kept = order[often]
        group = np.repeat(np.arange(int((sizes > 1).sum())), sizes[sizes > 1])
        # groups are numbered by hash: a stable sort by size breaks ties by it
        rank = np.empty(group[-1] + 1, np.int64)
        rank[np.argsort(sizes[sizes > 1], kind="stable")] = np.arange(1, group[-1] + 2)
        at, pair, key, rank = at[kept], pair[kept], key[kept], rank[group]
        priority = np.zeros(n + 1, np.int64)
        priority[at] = rank
        beaten = (priority[self.before[at]] > rank) | (priority[self.following[at]] > rank)
        wins = np.bincount(group, beaten)[group] == 0
        by_place = np.flatnonzero(wins)[np.argsort(at[wins])]
        left = at[by_place]
        chained = np.concatenate([[False], self.following[left[:-1]] == left[1:]])
        index = np.arange(len(left))
        first = np.maximum.accumulate(np.where(chained, 0, index))
        taken = (index - first) % 2 == 0
        self._replace(left[taken], pair[by_place[taken]], key[by_place[taken]])
        left = left[taken]
        touched = np.concatenate([at, left, self.before[left]])
        return np.unique(touched[self.alive[touched]])

    def _replace(self, left: np.ndarray, pair: np.ndarray, key: np.ndarray) -> None:
        right = self.following[left]
        self.made.append(Nodes(key, left, right, self.end[right]))
        after = self.following[right]
        self.symbol[left] = pair
        self.end[left] = self.end[right]
        self.following[left] = after
        self.before[after] = left
        self.alive[right] = False

    def halved(self) -> list[Nodes]:
        """Nodes over the symbols that are left, halving each document's sequence."""
        lo = np.flatnonzero(self.alive)
        end, doc = self.end[lo], self.doc[lo]
        out: list[Nodes] = []
        while len(lo):
            n = np.bincount(doc, minlength=len(self.bounds) - 1)
            index = np.arange(len(lo)) - (np.cumsum(n) - n)[doc]
            left = np.flatnonzero((index % 2 == 0) & (index + 1 < n[doc]))
            if not len(left):
                break
            # every node is the only one of its kind
            key = mix((np.uint64(len(out) + 1) << np.uint64(48)) + lo[left].astype(np.uint64))
            out.append(Nodes(key, lo[left], lo[left + 1], end[left + 1]))
            end[left] = end[left + 1]
            stays = np.ones(len(lo), bool)
            stays[left + 1] = False
            lo, end, doc = lo[stays], end[stays], doc[stays]
        return out


class Stretches:
    """Equality of stretches of words by hash."""

    def __init__(self, words: np.ndarray) -> None:
        self.powers = np.full(len(words) + 1, _BASE, np.uint64)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * self.powers[:-1], dtype=np.uint64)])

    def equal(self, at: np.ndarray, shift: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n words from a place on are those ``shift`` later."""
        here = (self.sums[at + n] - self.sums[at]) * self.powers[shift]
        return here == self.sums[at + shift + n] - self.sums[at + shift]

    def forward(self, at: np.ndarray, shift: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many words from a place on, up to the limit, are those ``shift`` later."""
        low, high = np.zeros(len(at), np.int64), limit.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(at, shift, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def backward(self, at: np.ndarray, shift: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """The same for the words that end before a place."""
        low, high = np.zeros(len(at), np.int64), limit.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(at - middle, shift, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _periods(node: np.ndarray, most: np.ndarray):
    """Pairs of a node and each period up to its largest, some at a time."""
    upto = np.cumsum(most)
    start = 0
    while start < len(node):
        stop = max(int(np.searchsorted(upto, (upto[start - 1] if start else 0) + _AT_ONCE)), start + 1)
        sizes = most[start:stop]
        owner = np.repeat(node[start:stop], sizes)
        yield owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        start = stop


def _crossing(words: np.ndarray, stretches: Stretches, nodes: Nodes) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the runs inside each node that have a square at its boundary."""
    found = [[np.empty(0, np.int64)] * 4]
    every = np.arange(len(nodes.lo))
    whole = (nodes.hi - nodes.lo) // EXPONENT
    for right in (True, False):
        room = nodes.hi - nodes.mid if right else nodes.mid - nodes.lo
        most = np.minimum(room // 2, whole)
        able = most > 0
        for node, period in _periods(every[able], most[able]):
            mid = nodes.mid[node]
            at = mid if right else mid - period
            near = words[at] == words[at + period]
            node, period, at = node[near], period[near], at[near]
            square = stretches.equal(at if right else at - period, period, period)
            node, period, at = node[square], period[square], at[square]
            if not len(node):
                continue
            lo, hi = nodes.lo[node], nodes.hi[node]
            start = at - stretches.backward(at, period, at - lo)
            end = at + period + stretches.forward(at, period, hi - at - period)
            long = end - start >= np.maximum(EXPONENT * period, LEAST_WORDS)
            found.append([c[long] for c in (node, start, end, period)])
    node, start, end, period = (np.concatenate(c) for c in zip(*found, strict=True))
    # of the periods of one stretch the smallest is its period, the others are multiples of it
    order = np.lexsort((period, end, start, node))
    node, start, end, period = (c[order] for c in (node, start, end, period))
    new = np.ones(len(node), bool)
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return node[new], start[new], end[new], period[new]


def _translated(nodes: Nodes, first: np.ndarray, number: np.ndarray, found: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """What was found in the first node of each kind, at the places of all nodes of its kind."""
    kind, start, end, period = found
    sizes = np.bincount(kind, minlength=len(first))
    starts = np.cumsum(sizes) - sizes
    copies = sizes[number]
    node = np.repeat(np.arange(len(number)), copies)
    own = np.arange(len(node)) - np.repeat(np.cumsum(copies) - copies, copies) + starts[number[node]]
    moved = nodes.lo[node] - nodes.lo[first[number[node]]]
    return start[own] + moved, end[own] + moved, period[own]


def _merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """One interval for those of a period that overlap by it or more."""
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    if not len(start):
        return start, end, period
    # a step between periods that is larger than any place keeps them apart
    apart = np.concatenate([[0], np.cumsum(period[1:] != period[:-1])]) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + apart)
    new = np.ones(len(start), bool)
    new[1:] = (start + apart)[1:] + period[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return start[at], np.maximum.reduceat(end, at), period[at]


def _compared(words: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, int]]:
    """Runs of one document by comparing its words at every period."""
    out: dict[tuple[int, int], int] = {}
    for period in range(1, (hi - lo) // EXPONENT + 1):
        same = np.concatenate([[False], words[lo : hi - period] == words[lo + period : hi], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a + period >= max(EXPONENT * period, LEAST_WORDS):
                out.setdefault((lo + a, lo + b + period), period)
    return [(a, b, p) for (a, b), p in out.items()]


def runs_of(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(start, end, period) of all runs of some documents, by start and period.

    ``words`` are hashes; document d has words bounds[d] to bounds[d + 1].
    """
    grammar = RePair(words, bounds)
    nodes = _concatenated(grammar.made + grammar.halved())
    wide = nodes.hi - nodes.lo >= LEAST_WORDS
    nodes = Nodes(nodes.key[wide], nodes.lo[wide], nodes.mid[wide], nodes.hi[wide])
    _, first, number = np.unique(nodes.key, return_index=True, return_inverse=True)
    kinds = Nodes(nodes.key[first], nodes.lo[first], nodes.mid[first], nodes.hi[first])
    found = _crossing(words, Stretches(words), kinds)
    start, end, period = _merged(*_translated(nodes, first, number, found))
    # stretches were equal by their hashes; a run is one by its words
    wrong = {
        int(np.searchsorted(bounds, a, side="right")) - 1
        for a, b, p in zip(start.tolist(), end.tolist(), period.tolist(), strict=True)
        if not np.array_equal(words[a : b - p], words[a + p : b])
    }
    if wrong:
        again = [r for d in sorted(wrong) for r in _compared(words, int(bounds[d]), int(bounds[d + 1]))]
        right = ~np.isin(np.searchsorted(bounds, start, side="right") - 1, list(wrong))
        more = np.array(again, np.int64).reshape(-1, 3).T
        start, end, period = (np.concatenate([c[right], m]) for c, m in zip((start, end, period), more, strict=True))
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _strongest(runs: list[tuple[int, int, int]]) -> tuple:
    """The run of (start, length, period) with the greatest length / period; smallest start, then period, of equals."""
    if not runs:
        return (None,) * 4
    near = max(n / p for _, n, p in runs) * (1 - 1e-9)
    start, n, period = max((r for r in runs if r[1] / r[2] >= near), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
    return start, n, period, 1000 * n // period


#: A run of a document: its first word's number, its words, its period.
_RUN = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
_DIGEST = (
    *((n, T.LongType()) for n in ("n_runs", "start", "length", "period", "exponent_milli")),
    ("runs_sha256", T.StringType()),
    ("collapsed_sha256", T.StringType()),
)


def _rows(words: Words):
    """Per document: its runs, and its text without what runs repeat."""
    start, end, period = runs_of(words.hashes, words.bounds)
    repeated = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(repeated, start + period, 1)
    np.add.at(repeated, end, -1)
    kept = np.cumsum(repeated)[:-1] == 0
    cuts = np.searchsorted(start, words.bounds)
    raw = words.data.tobytes()
    runs = list(zip(start.tolist(), (end - start).tolist(), period.tolist(), strict=True))
    for d in range(words.rows):
        lo, hi = int(words.bounds[d]), int(words.bounds[d + 1])
        own = [(s - lo, n, p) for s, n, p in runs[cuts[d] : cuts[d + 1]]]
        if own:
            at = np.flatnonzero(kept[lo:hi]) + lo
            parts = zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)
            yield own, b" ".join([raw[a:b] for a, b in parts])
        else:
            yield own, b" ".join(raw[words.starts[lo] : words.ends[hi - 1]].split()) if hi > lo else b""


def collapse_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text", with_output: bool = False) -> DataFrame:
    """Per document: its runs, the strongest of them, and the hash of its text without repetition.

    A run is a stretch of words of smallest period q, of at least max(6, 4 q) words, that its
    neighbours do not extend. ``start``, ``length``, ``period`` and ``exponent_milli`` are those of
    the run with the greatest length / period, of equal ones the first; null without a run. A word
    in a run after its first period is dropped. ``runs_sha256`` is of the lines
    ``start,length,period``; ``with_output`` adds the runs and the collapsed text themselves.

    Null, empty and blank texts have no words and no run. Equal rows each get their result; ids are
    passed on, null or not. An empty table gives no rows. Documents are independent: no shuffle, and
    a task holds the words of one batch, or of one text beyond 2 MiB.
    """
    kinds = [*_DIGEST, *[("runs", _RUN), ("collapsed", T.StringType())] * with_output]
    rows = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(n, k) for n, k in kinds)])

    def run(batches):
        for batch in batches:
            columns: list[list] = [[] for _ in kinds]
            for words in words_of(batch.column(1), SPACED):
                for own, collapsed in _rows(words):
                    lines = "".join(f"{s},{n},{p}\n" for s, n, p in own)
                    hashes = hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed).hexdigest()
                    out = [len(own), *_strongest(own), *hashes]
                    if with_output:
                        out += [[dict(zip(("start", "length", "period"), r, strict=True)) for r in own], collapsed.decode()]
                    for column, value in zip(columns, out, strict=True):
                        column.append(value)
            longs, strings = [pa.int64()] * 5, [pa.string()] * 2
            run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
            types = [*longs, *strings, *[run_type, pa.string()] * with_output]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    return rows.mapInArrow(run, schema)


def with_periodic_tails(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every tenth one, by crc32 of its id, made to repeat from some word on.

    With h the crc32 of the decimal id and g = h div 10, a text of n > 0 words with h mod 10 = 0 has, from word
    a = g mod n on, word a + (i - a) mod p in place of word i, where p = 1 + (n - a) div (3 + g mod 8).
    Its words are then joined by one space. Rows without an id or words stay as they are.
    """
    words = F.filter(F.split(F.col(text), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    h = F.crc32(F.col(id_column).cast("string").cast("binary"))
    marked = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    n, g = F.size("w").cast("long"), F.expr("h div 10")
    a = F.when(n > 0, g % n)
    p = 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    placed = marked.select("doc_id", "text", "w", g.alias("g"), a.alias("a")).withColumn("p", p.cast("long"))
    # the head, then the period as often as it fits, and its beginning
    rest = n - F.col("a")
    period = F.slice("w", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    head = F.slice("w", F.lit(1), F.col("a").cast("int"))
    times = F.floor(rest / F.col("p")).cast("int")
    tail = F.slice(period, F.lit(1), (rest - times * F.col("p")).cast("int"))
    tailed = F.concat(head, F.flatten(F.array_repeat(period, times)), tail)
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(tailed, " ")).otherwise(F.col("text")).alias("text"))
