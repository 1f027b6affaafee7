"""Quality classifier: ordinal cumulative-link regression on graded ratings.

P(grade > k | text) = sigmoid(w . x - t_k) with one weight vector w for all grades and ordered
thresholds t_0 < t_1 < ... . x marks which hashed words and style marks a text has. The expected
grade is the sum of the tail probabilities; P(grade >= selected grade) decides what is kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscope.llm.words import PLAIN_LOWER, SPACED, Words, mix, row_bytes, words_of

#: Hashed word buckets; style marks take places of their own behind them.
BUCKETS = 1 << 18
#: Rated rows that the model is fitted on, the first by a hash of their id: all that reaches the driver.
SAMPLE_ROWS = 8_000
#: Buckets in fewer sampled rows than this keep weight 0.
LEAST_ROWS = 6
STEPS = 150
_STYLE_LEVELS = 8
_STYLES = 7
STYLE_WEIGHT = 3


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for each row and k."""
        return _sigmoid(scores[:, None] - self.thresholds[None, :])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _levels(data: np.ndarray, offsets: np.ndarray, distinct: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """Style marks of each row: shares of bytes and words, cut into levels."""
    n = np.maximum(np.diff(offsets), 1)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / n

    upper = share((data >= 65) & (data <= 90))
    digit = share((data >= 48) & (data <= 57))
    mark = share((data > 32) & (data < 128) & ~(((data | 32) >= 97) & ((data | 32) <= 122)) & ~((data >= 48) & (data <= 57)))
    line = share(data == 10)
    words = np.maximum(n_words, 1)
    expected = words**0.9
    levels = [
        np.sqrt(upper) * _STYLE_LEVELS,
        np.sqrt(digit) * _STYLE_LEVELS,
        np.sqrt(mark) * _STYLE_LEVELS,
        np.sqrt(line) * _STYLE_LEVELS * 2,
        distinct / expected * _STYLE_LEVELS * 0.7,
        np.log2(n / words),
        np.log2(words) * 0.5,
    ]
    return np.stack([np.clip(x, 0, _STYLE_LEVELS - 1).astype(np.int64) for x in levels], axis=1)


def _edges(words: Words, folded: np.ndarray, size: int, at_end: bool, salt: int) -> np.ndarray:
    """Buckets of the first or last ``size`` bytes of each word."""
    packed = np.full(len(words.starts), salt, np.uint64)
    for j in range(size):
        at = words.ends - 1 - j if at_end else words.starts + j
        inside = (at >= words.starts) & (at < words.ends)
        byte = folded[words.data[np.where(inside, at, words.starts)]].astype(np.uint64)
        packed = packed * np.uint64(257) + np.where(inside, byte + np.uint64(1), np.uint64(0))
    return (mix(packed) & np.uint64(BUCKETS - 1)).astype(np.int64)


def features(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row starts, feature numbers, word counts): for each text the different features it has.

    Lower-case words, the first bytes of words, the last bytes of what stands between white space
    if it ends in a mark, and style levels, which count STYLE_WEIGHT times.
    """
    _, offsets = row_bytes(texts)
    starts, out, counts, at = [np.zeros(1, np.int64)], [], [], 0
    for words, tokens in zip(words_of(texts, PLAIN_LOWER), words_of(texts, SPACED), strict=True):
        whole = (words.hashes & np.uint64(BUCKETS - 1)).astype(np.int64)
        heads = _edges(words, PLAIN_LOWER.folded, 4, False, 1)
        tails = _edges(tokens, PLAIN_LOWER.folded, 3, True, 2)
        marked = PLAIN_LOWER.separator[tokens.data[tokens.ends - 1]]
        cuts = zip(words.bounds[:-1], words.bounds[1:], tokens.bounds[:-1], tokens.bounds[1:], strict=True)
        own = []
        for a, b, c, d in cuts:
            own.append((np.unique(whole[a:b]), np.unique(np.concatenate([heads[a:b], tails[c:d][marked[c:d]]]))))
        n_words = np.diff(tokens.bounds)
        part = offsets[words.first_row : words.first_row + words.rows + 1]
        distinct = np.array([len(x) for x, _ in own])
        levels = _levels(words.data, part - part[0], distinct, np.diff(words.bounds))
        style = np.repeat(BUCKETS + np.arange(_STYLES) * _STYLE_LEVELS + levels, STYLE_WEIGHT, axis=1)
        for i, (x, y) in enumerate(own):
            out += [x, y, style[i]]
        lengths = np.array([len(x) + len(y) for x, y in own], np.int64) + style.shape[1]
        starts.append(at + np.cumsum(lengths))
        at = int(starts[-1][-1])
        counts.append(n_words)
    none = np.empty(0, np.int64)
    return np.concatenate(starts), np.concatenate([none, *out]), np.concatenate([none, *counts])


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sum of each row, which depends on that row alone."""
    if len(starts) < 2:
        return np.empty(0)
    sums = np.add.reduceat(np.append(values, 0.0), starts[:-1])
    return np.where(np.diff(starts) > 0, sums, 0.0)


def fit(starts: np.ndarray, numbers: np.ndarray, grades: np.ndarray, penalty: float = 1.0) -> OrdinalModel:
    """Maximum likelihood with a quadratic penalty, by Adam steps of decreasing size.

    Thresholds are a first value and logarithms of gaps, so they stay in order. Without rated rows
    all weights are 0; a single grade is given to all texts.
    """
    size = BUCKETS + _STYLES * _STYLE_LEVELS
    top = int(grades.max(initial=0))
    n = len(grades)
    if top < 1 or n == 0:
        return OrdinalModel(np.zeros(size), np.full(max(top, 1), -20.0 if n and top else 20.0))
    seen = np.bincount(numbers, minlength=size)
    used = np.flatnonzero((seen >= LEAST_ROWS) & (seen < n))
    place = np.full(size, -1)
    place[used] = np.arange(len(used))
    row = np.repeat(np.arange(n), np.diff(starts))
    inside = place[numbers] >= 0
    columns, row = place[numbers][inside], row[inside]
    at_least = np.array([(grades > k).mean() for k in range(top)]).clip(1e-3, 1 - 1e-3)
    first = -np.log(at_least / (1 - at_least))
    gaps = np.log(np.maximum(np.diff(first), 0.1))
    params = np.concatenate([np.zeros(len(used)), first[:1], gaps])
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, t0, g = params[: len(used)], params[len(used)], params[len(used) + 1 :]
        cuts = np.concatenate([[t0], t0 + np.cumsum(np.exp(g))])
        scores = np.bincount(row, w[columns], minlength=n)
        tail = _sigmoid(scores[:, None] - cuts[None, :])
        # likelihood of a grade: difference of the tails on either side of it
        tails = np.hstack([np.ones((n, 1)), tail, np.zeros((n, 1))])
        slopes = np.hstack([np.zeros((n, 1)), tail * (1 - tail), np.zeros((n, 1))])
        i = np.arange(n)
        likely = np.maximum(tails[i, grades] - tails[i, grades + 1], 1e-9)
        d_score = -(slopes[i, grades] - slopes[i, grades + 1]) / likely
        d_cut = np.zeros((n, top + 2))
        d_cut[i, grades] += slopes[i, grades] / likely
        d_cut[i, grades + 1] -= slopes[i, grades + 1] / likely
        by_cut = d_cut.sum(0)[1:-1]
        grad = np.empty_like(params)
        grad[: len(used)] = np.bincount(columns, d_score[row], minlength=len(used)) + penalty * w
        grad[len(used)] = by_cut.sum()
        grad[len(used) + 1 :] = [np.exp(g[k]) * by_cut[k + 1 :].sum() for k in range(top - 1)]
        mean = 0.9 * mean + 0.1 * grad
        square = 0.99 * square + 0.01 * grad**2
        rate = 0.1 * min(1.0, 2 * (1 - step / (STEPS + 1)))
        params = params - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(size)
    weights[used] = params[: len(used)]
    cuts = params[len(used)] + np.concatenate([[0.0], np.cumsum(np.exp(params[len(used) + 1 :]))])
    return OrdinalModel(weights, cuts)


def _featurise(batches):
    for batch in batches:
        starts, numbers, _ = features(batch.column(1))
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(numbers, pa.int32()))
        yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["grade", "numbers"])


def train(docs: DataFrame, ratings: DataFrame, id_column: str = "doc_id", text: str = "text", grade: str = "grade") -> OrdinalModel:
    """A model from at most SAMPLE_ROWS ratings, chosen by a hash of their id.

    Ratings without id or grade, with a negative grade, or of unknown documents are passed over.
    """
    rated = (
        ratings.select(F.col(id_column).alias("i"), F.col(grade).cast("int").alias("grade"))
        .where(F.col("i").isNotNull() & (F.col("grade") >= 0))
    )
    chosen = rated.orderBy(F.xxhash64("i", F.lit(1)), "i", "grade").limit(SAMPLE_ROWS)
    texts = docs.select(F.col(id_column).alias("i"), F.col(text).alias("t"))
    rows = texts.join(F.broadcast(chosen), "i").orderBy(F.xxhash64("i", F.lit(1)), "i", "grade").limit(SAMPLE_ROWS)
    found = rows.select("grade", "t").mapInArrow(_featurise, "grade int, numbers array<int>").toArrow()
    numbers = found["numbers"].combine_chunks()
    grades = np.asarray(found["grade"].to_numpy(), np.int64)
    if len(grades) == 0:
        return fit(np.zeros(1, np.int64), np.empty(0, np.int64), grades)
    starts = np.asarray(numbers.offsets, np.int64)
    return fit(starts - starts[0], np.asarray(numbers.flatten(), np.int64), grades)


def _scorer(shared, text: str, names: tuple[str, str, str, str], keep: list[str], selected: int):
    def score(batches):
        model = shared.value
        for batch in batches:
            starts, numbers, counts = features(batch.column(batch.schema.get_field_index(text)))
            tails = model.tails(_sums(model.weights[numbers], starts))
            chosen = tails[:, selected - 1] if 0 < selected <= tails.shape[1] else np.full(len(tails), float(selected <= 0))
            added = (counts, tails.sum(1), chosen, chosen >= 0.5)
            columns = {c: batch.column(batch.schema.get_field_index(c)) for c in keep}
            yield pa.RecordBatch.from_pydict(columns | {n: pa.array(v) for n, v in zip(names, added, strict=True)})

    return score


def score(docs: DataFrame, model: OrdinalModel, selected: int, text: str = "text", keep: list[str] | None = None, prefix: str = "") -> DataFrame:
    """The columns ``keep`` (all by default) with n_words, expected_grade, tail_probability, selected.

    ``selected`` is true where a grade of at least ``selected`` has probability 0.5 or more. Null
    and empty texts have no words and get the grade that their style marks give. Equal rows get
    equal results. Columns of the new names, with their prefix, are replaced.
    """
    names = tuple(prefix + n for n in ("n_words", "expected_grade", "tail_probability", "selected"))
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    kinds = (T.LongType(), T.DoubleType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(*dict.fromkeys([*keep, text]))
    return rows.mapInArrow(_scorer(shared, text, names, keep, selected), schema)


def graded(labels: DataFrame) -> DataFrame:
    """Ratings from two marks: 0 toxic, 1 poor, 2 good; rows without quality mark have none."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade")).where(F.col("grade").isNotNull())
