"""Katz back-off language model over the words of a corpus, trained and evaluated by Spark tasks.

    P(w | h) = g(h) d_c c(h w) / c(h)   where c(h w) reaches the order's cutoff,
               a(h) P(w | h')           elsewhere, h' being h without its first word.

d_c is the Good-Turing discount of counts up to ``GOOD_TURING``, from the order's counts of counts.
a(h) = (1 - sum of the discounted probabilities) / (1 - sum of P(w | h') over the same words), so
that every history's probabilities add up to 1; g(h) is c(h) / (c(h) + 1) where the discounts leave
nothing for other words, else 1. Below the words is the discounted unigram distribution, which
leaves its rest to one class of unknown words. Texts end with an end mark, a token like the others,
and start after start marks, which are history only.

Documents are dealt into groups. A group asks the owners of its different n-grams for their counts,
those of all orders but the longest at once, then sends the owners of its different histories its part of both sums, each n-gram being counted
by one group; answers are stored by owner, without n-gram keys, and come back in the order of the
question: they are answers to this corpus's questions, not a model that could score other texts.
With the answers a group evaluates the recursion above for each of its tokens. What is
asked, summed and answered grows with the corpus; no table is sent to all tasks but the few numbers
of ``Order``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.requests import dealt, grouped, groups_for, packed, unique, unpack, unpacked
from callscope.llm.words import SPACED_LOWER, mix, words_of
from callscope.llm.work import Scratch

#: Counts up to this are discounted.
GOOD_TURING = 5
#: n-grams of each order that count less are left to the back-off.
CUTOFFS = (1, 1, 2)
#: Text of one group of documents; a task holds some ten times as much in arrays.
GROUP_BYTES = 8 << 20
_START, _END = np.uint64(0x5BD1E9955BD1E995), np.uint64(0xC2B2AE3D27D4EB4F)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SHOWN = GOOD_TURING + 1


@dataclass(frozen=True)
class Order:
    """What is known of all n-grams of one order: tokens, types, discounts for counts 0 to GOOD_TURING."""

    tokens: int
    types: int
    discounts: tuple[float, ...]
    cutoff: int
    of_counts: tuple[int, ...]

    @property
    def mass(self) -> float:
        """The sum of all discounted counts."""
        return self.tokens - sum(r * n * (1 - self.discounts[r]) for r, n in enumerate(self.of_counts[:GOOD_TURING], 1))

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return counts * np.array([*self.discounts, 1.0])[np.minimum(counts, GOOD_TURING + 1)]


def discounts(of_counts: list[int], cutoff: int) -> tuple[float, ...]:
    """Good-Turing discounts from the number of n-grams that occur 1, 2, ... GOOD_TURING + 1 times.

    The range is shortened while a discount in it is not between 0 and 1; none may be left.
    """
    for k in range(GOOD_TURING, 0, -1):
        n = [0, *of_counts]
        if min(n[1 : k + 2]) == 0:
            continue
        rest = (k + 1) * n[k + 1] / n[1]
        if rest >= 1:
            continue
        d = [((r + 1) * n[r + 1] / n[r] / r - rest) / (1 - rest) for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d[cutoff - 1 :]):
            return (0.0, *(x if r >= cutoff else 0.0 for r, x in enumerate(d, 1)), *[1.0] * (GOOD_TURING - k))
    return (0.0, *(float(r >= cutoff) for r in range(1, GOOD_TURING + 1)))


class Tokens:
    """The tokens of a group of documents, with a key for each n-gram that ends there."""

    def __init__(self, table: pa.Table) -> None:
        tokens, sizes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for words in words_of(table.column("text"), SPACED_LOWER):
            n = np.diff(words.bounds)
            tokens.append(np.insert(words.hashes, words.bounds[1:], _END))
            sizes.append(n + 1)
        self.token = np.concatenate(tokens)
        self.sizes = np.concatenate(sizes)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        held = table.column("held").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        self.training = np.repeat(~held, self.sizes)

    def _back(self, j: int) -> np.ndarray:
        """The token j places before each, the start mark before a text."""
        if j == 0:
            return self.token
        out = np.empty(len(self.token), np.uint64)
        out[j:] = self.token[:-j]
        for i in range(j):
            out[self.starts[self.sizes > i] + i] = _START
        return out

    def ngram(self, n: int) -> np.ndarray:
        key = self.token + np.array([n], np.uint64) * _STEP
        for j in range(1, n):
            key = mix(key) * _STEP + self._back(j)
        return mix(key)

    def start_history(self, n: int) -> np.uint64:
        """The history of a text's first token: start marks."""
        key = np.full(1, np.uint64(n - 1), np.uint64)
        for _ in range(n - 1):
            key = mix(key * _STEP + _START)
        return key[0]


def _ask_counts(orders: list[int], owners: int):
    """The counts of n-grams of several orders, for which the texts are read and cut into tokens once."""

    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        tokens = Tokens(table)
        asked = []
        for n in orders:
            keys, _, number = unique(tokens.ngram(n))
            counts = np.bincount(number, tokens.training, minlength=len(keys)).astype(np.int64)
            part = dealt(key[0].as_py(), owners, keys, counts=counts)
            asked.append(part.append_column("n", pa.array(np.full(part.num_rows, n), pa.int32())))
        return pa.concat_tables(asked)

    return ask


_ANSWER = "bucket int, owner int, kind string, a binary, b binary, stats array<long>"


def _answers(table: pa.Table, owner: int, kind: str, a: np.ndarray, b: np.ndarray, row: np.ndarray, stats: list | None) -> pa.Table:
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=table.num_rows))])
    n = table.num_rows
    out = pa.table(
        {
            "bucket": table.column("bucket").combine_chunks(),
            "owner": pa.array([owner] * n, pa.int32()),
            "kind": pa.array([kind] * n, pa.string()),
            "a": packed(a, bounds),
            "b": packed(b, bounds),
            "stats": pa.nulls(n, pa.list_(pa.int64())),
        }
    )
    if stats is None:
        return out
    one = {"bucket": [-1], "owner": [owner], "kind": [kind], "a": [None], "b": [None], "stats": [stats]}
    return pa.concat_tables([out, pa.table(one, schema=out.schema)])


def _answer_counts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Whole counts, and for each n-gram one group that has it in training, to count it in sums."""
    owner, n = (k.as_py() for k in key)
    keys, row = unpacked(table.column("keys"), np.uint64, ascending=True)
    own, _ = unpacked(table.column("counts"), np.int64)
    different, _, number = unique(keys)
    totals = np.zeros(len(different), np.int64)
    np.add.at(totals, number, own)
    chosen = np.full(len(different), table.num_rows)
    # Rows ascend: the first is what is assigned last.
    training = np.flatnonzero(own)[::-1]
    chosen[number[training]] = row[training]
    stats = [int(totals.sum()), int((totals > 0).sum()), *np.bincount(totals[totals <= _SHOWN], minlength=_SHOWN + 1)[1:].tolist()]
    first = (chosen[number] == row).astype(np.uint8)
    return _answers(table, owner, f"count-{n}", totals[number], first, row, stats)


def _answer_sums(n: int):
    def answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Each history's a(h), and whether its discounts leave nothing, which makes g(h) less than 1."""
        keys, row = unpacked(table.column("keys"), np.uint64, ascending=True)
        times, _ = unpacked(table.column("times"), np.int64)
        needed, _ = unpacked(table.column("needed"), np.uint8)
        different, place, number = unique(keys)
        sums = []
        for name in ("seen", "lower"):
            own, _ = unpacked(table.column(name), np.float64)
            sums.append(np.bincount(number, own, minlength=len(different)))
        total = sums[0] / times[place]
        full = total > 1 - 1e-9
        scale = np.where(full, times[place] / (times[place] + 1.0), 1.0)
        back = ((1 - scale * total) / np.maximum(1 - sums[1], 1e-300))[number]
        told = np.where(needed > 0, back, 1.0)
        return _answers(table, key[0].as_py(), f"sum-{n}", told, full[number].astype(np.uint8), row, None)

    return answer


class Evaluation:
    """Counts and probabilities of each token of a group, from the answers that came back."""

    def __init__(self, docs: pa.Table, answers: pa.Table, owners: int, documents: int, orders: list[Order]) -> None:
        self.tokens, self.owners, self.documents, self.orders = Tokens(docs), owners, documents, orders
        self.answers: dict[str, list] = {}
        rows = zip(*(answers.column(c).to_pylist() for c in ("kind", "owner", "a", "b")), strict=True)
        for kind, owner, a, b in sorted(rows, key=lambda r: r[1]):
            self.answers.setdefault(kind, []).append((a, b))
        self._counts: dict[int, tuple] = {}
        self._numbered: dict[int, tuple] = {}
        self._of_history: dict[int, np.ndarray] = {}

    def _answer(self, kind: str, n: int, type_a, type_b) -> tuple[np.ndarray, np.ndarray]:
        parts = self.answers.get(kind, [])
        a = np.concatenate([np.empty(0, type_a), *(unpack(x, type_a) for x, _ in parts)])
        b = np.concatenate([np.empty(0, type_b), *(unpack(x, type_b) for _, x in parts)])
        if len(a) != n or len(b) != n:
            raise ValueError(f"{len(a)} answers to {n} questions of {kind}")
        return a, b

    def counts(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Each token's n-gram count, and a place of each n-gram that this group counts in sums."""
        if n not in self._counts:
            keys, place, number = unique(self.tokens.ngram(n))
            totals, first = self._answer(f"count-{n}", len(keys), np.int64, np.uint8)
            kept = (first > 0) & (totals >= self.orders[n - 1].cutoff)
            self._counts[n] = totals[number], place[kept]
            if n < len(self.orders):
                self._numbered[n] = keys, number.astype(np.int32)
        return self._counts[n]

    def of_history(self, n: int) -> np.ndarray:
        """How often the n-gram's history occurs in training."""
        if n not in self._of_history:
            out = np.empty(len(self.tokens.token), np.int64)
            out[1:] = self.counts(n - 1)[0][:-1]
            out[self.tokens.starts] = self.documents
            self._of_history[n] = out
        return self._of_history[n]

    def unigram(self) -> np.ndarray:
        order = self.orders[0]
        seen = order.discounted(self.counts(1)[0])
        rest = order.tokens - order.mass
        total = order.tokens if rest > 0 else order.tokens + 1
        return np.where(seen > 0, seen, rest if rest > 0 else 1) / total

    def kept(self, n: int) -> np.ndarray:
        """Discounted counts, 0 below the cutoff."""
        counts = self.counts(n)[0]
        return np.where(counts >= self.orders[n - 1].cutoff, self.orders[n - 1].discounted(counts), 0.0)

    def seen(self, n: int) -> np.ndarray:
        """Discounted relative frequency after the history, 0 below the cutoff."""
        return self.kept(n) / np.maximum(self.of_history(n), 1)

    def probability(self, n: int) -> np.ndarray:
        """P(token | history of n - 1), by recursion over shorter histories."""
        if n == 1:
            return self.unigram()
        lower, seen = self.probability(n - 1), self.seen(n)
        at, keys, number = self._histories(n)
        answered, full = self._answer(f"sum-{n}", len(keys), np.float64, np.uint8)
        back, scale = np.ones(len(seen)), np.ones(len(seen))
        back[at] = answered[number]
        times = self.of_history(n)[at]
        scale[at] = np.where(full[number] > 0, times / (times + 1.0), 1.0)
        return np.where(seen > 0, scale * seen, back * lower)

    def _histories(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places whose history has a sum, the different histories, and the number of each place's.

        A history that occurs less often than the cutoff has no n-gram that reaches it: its whole
        probability is left to the back-off, and nothing has to be asked.
        """
        at = np.flatnonzero(self.of_history(n) >= self.orders[n - 1].cutoff)
        # The history is the n-gram, one shorter, that ends a place before, numbered when it was counted.
        self.counts(n - 1)
        keys, number = self._numbered[n - 1]
        before = np.empty(len(number), np.int32)
        before[1:] = number[:-1]
        starts = self.tokens.starts
        start = self.tokens.start_history(n)
        before[starts] = place = np.searchsorted(keys, start)
        if len(starts) and (place == len(keys) or keys[place] != start):
            before[before >= place] += 1
            before[starts] = place
            keys = np.insert(keys, place, start)
        before = before[at]
        present = np.zeros(len(keys), bool)
        present[before] = True
        return at, keys[present], (np.cumsum(present, dtype=np.int32) - 1)[before]

    def sums(self, n: int, bucket: int) -> pa.Table:
        """This group's part of each history's sums, and which back-off weights it needs."""
        place = self.counts(n)[1]
        at, keys, number = self._histories(n)
        of_place = np.full(len(self.tokens.token), -1, np.int64)
        of_place[at] = number
        times = np.zeros(len(keys), np.int64)
        times[number] = self.of_history(n)[at]
        kept, lower = self.kept(n), self.probability(n - 1)
        parts = [np.bincount(of_place[place], x[place], minlength=len(keys)) for x in (kept, lower)]
        needed = np.zeros(len(keys), np.uint8)
        needed[number[kept[at] == 0]] = 1
        return dealt(bucket, self.owners, keys, seen=parts[0], lower=parts[1], times=times, needed=needed)


class Katz:
    """A model of the training documents and the scores it gives to all documents."""

    def __init__(self, docs: DataFrame, held_out, cutoffs: tuple[int, ...] = CUTOFFS, id_column: str = "doc_id", text: str = "text") -> None:
        self.spark = docs.sparkSession
        self.scratch = Scratch(self.spark, "katz")
        self.cutoffs = cutoffs
        self.owners = groups_for(self.spark, docs, text, GROUP_BYTES)
        marked = docs.withColumn("held", F.coalesce(held_out, F.lit(False)))
        self.rows = grouped(marked, id_column, text, self.owners, "held")
        self.documents = self.rows.where("NOT held").count()
        self.orders: list[Order] = []
        self.answers: DataFrame | None = None
        # The longest n-grams ask as much as all others; asked with them, they would not fit on the disk.
        *shorter, longest = range(1, len(cutoffs) + 1)
        for asked in filter(None, (shorter, [longest])):
            self._count(asked)
        for n in range(2, len(cutoffs) + 1):
            self._normalise(n)

    def _keep(self, answers: DataFrame, name: str) -> DataFrame:
        stored = self.scratch.store(answers, name)
        own = stored.where("bucket >= 0").select("bucket", "owner", "kind", "a", "b")
        self.answers = own if self.answers is None else self.answers.union(own)
        return stored

    def _count(self, orders: list[int]) -> None:
        asked = self.rows.groupBy("bucket").applyInArrow(
            _ask_counts(orders, self.owners), "owner int, bucket int, keys binary, counts binary, n int"
        )
        stored = self._keep(asked.groupBy("owner", "n").applyInArrow(_answer_counts, _ANSWER), f"count-{orders[-1]}")
        sums = [F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(_SHOWN + 2)]
        # One row per order.
        of = {r[0]: r[1:] for r in stored.where("bucket = -1").groupBy("kind").agg(*sums).collect()}
        for n in orders:
            cutoff = self.cutoffs[n - 1]
            tokens, types, *of_counts = of.get(f"count-{n}", (0,) * (_SHOWN + 2))
            self.orders.append(Order(tokens, types, discounts(of_counts, cutoff), cutoff, tuple(of_counts)))

    def _evaluated(self, run, schema: str) -> DataFrame:
        owners, documents, orders = self.owners, self.documents, list(self.orders)

        def apply(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
            return run(key[0].as_py(), docs, Evaluation(docs, answers, owners, documents, orders))

        return self.rows.groupBy("bucket").cogroup(self.answers.groupBy("bucket")).applyInArrow(apply, schema)

    def _normalise(self, n: int) -> None:
        asked = self._evaluated(
            lambda bucket, _, evaluation: evaluation.sums(n, bucket), "owner int, bucket int, keys binary, seen binary, lower binary, times binary, needed binary"
        )
        self._keep(asked.groupBy("owner").applyInArrow(_answer_sums(n), _ANSWER), f"sum-{n}")

    def scores(self) -> DataFrame:
        """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

        The base is the sum over tokens of log10((c + 1) / (N + V + 1)). Null, empty and blank texts
        have the end mark only. Rows with equal ids are documents of their own; a row without an id
        is scored like the others.
        """
        order, n_orders = self.orders[0], len(self.cutoffs)

        def run(bucket: int, docs: pa.Table, evaluation: Evaluation) -> pa.Table:
            tokens = evaluation.tokens
            counts = evaluation.counts(1)[0]
            logs = np.log10(evaluation.probability(n_orders))
            base = np.log10((counts + 1.0) / (order.tokens + order.types + 1.0))
            n = len(tokens.sizes)

            def per_doc(values: np.ndarray) -> np.ndarray:
                return np.bincount(tokens.doc, values, minlength=n)

            return pa.table(
                {
                    "doc_id": docs.column("doc_id"),
                    "held_out": docs.column("held"),
                    "n_tokens": pa.array(tokens.sizes, pa.int64()),
                    "n_known": pa.array(per_doc(counts > 0).astype(np.int64)),
                    "train_tokens": pa.array(np.full(n, order.tokens, np.int64)),
                    "base_score": pa.array(per_doc(base)),
                    "score": pa.array(per_doc(logs)),
                }
            )

        schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        return self._evaluated(run, schema)


def scored(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model of those whose crc32(doc_id as text) mod 7 is not 2."""
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return Katz(docs.select("doc_id", "text"), held).scores()
