"""Near-duplicate documents by HyperMinHash registers, banding and verification on full sets.

A document's shingles are dealt into ``BUCKETS`` buckets in each of ``ROUNDS`` independent rounds. A
register keeps the smallest hash of its bucket as a count of leading zeros and ``MANTISSA`` bits
behind them, 16 bits in all. ``ROWS`` registers make a band; documents with an equal band are
candidates. Their Jaccard similarity is estimated from equal registers, corrected for the registers
that agree by chance, and what may reach the threshold is verified on the full shingle sets.

Documents with the same words form one class, which its smallest id stands for. No bucket of equal
bands emits all its pairs. First every member is paired with one leader of its bucket. Buckets that
are then still in several components are compared a second time, in blocks: only members of
different components, by their registers and by ``WIDE`` more rounds of 8-bit registers, inside one
task; a pair is emitted for verification only if both estimates allow the threshold, and only by the
first of the bands that it shares.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.components import components
from callscope.llm.words import SPACED_LOWER, Words, grams, mix, whole_grams, words_of
from callscope.llm.work import Scratch, free_prefix, partitions_for

SHINGLE = 5
THRESHOLD = 75
ROUNDS, BUCKETS, ROWS = 8, 16, 4
MANTISSA = 10
#: Standard deviations below the threshold at which an estimate still leads to verification.
SLACK = 5.0
#: Rounds of the wide registers, and their standard deviations of slack.
WIDE, WIDE_SLACK = 64, 4.5
#: Members of a bucket that are compared with as many others in one task at once.
BLOCK = 2048
#: Of a register's collision probability at equal sizes, in units of 2**-MANTISSA.
_COLLISION = 0.169919487159739093975315012348
_SEEDS = mix(np.arange(1, ROUNDS + WIDE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(words: Words) -> list[np.ndarray]:
    """Each row's different shingles, sorted; a row of fewer words has its whole sequence as one."""
    hashes = grams(words.hashes, SHINGLE)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(hashes[a : b - SHINGLE + 1]))
        elif b > a:
            out.append(grams(words.hashes[a:b], b - a))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def registers(sets: list[np.ndarray], seeds: np.ndarray = _SEEDS[:ROUNDS]) -> np.ndarray:
    """One row of BUCKETS registers per set and seed; an empty bucket is 0."""
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate([np.empty(0, np.uint64), *sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    bits = BUCKETS.bit_length() - 1
    out = np.zeros((len(sets), len(seeds), BUCKETS), np.uint16)
    for r, seed in enumerate(seeds):
        dealt = mix(values ^ seed)
        place = row * BUCKETS + (dealt >> np.uint64(64 - bits)).astype(np.int64)
        least = np.full(len(sets) * BUCKETS, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, place, dealt << np.uint64(bits))
        out[:, r, :] = _compress(least).reshape(len(sets), BUCKETS)
    return out.reshape(len(sets), len(seeds) * BUCKETS)


def _compress(least: np.ndarray) -> np.ndarray:
    """Leading zeros plus one in the high bits, mantissa in the low ones; 0 for an empty bucket."""
    empty = least == np.iinfo(np.uint64).max
    bit = np.minimum(np.frexp(np.maximum(least, np.uint64(1)).astype(np.float64))[1] - 1, 63)
    bit -= (least >> bit.astype(np.uint64) == 0) & (bit > 0)  # where the double was rounded up
    zeros = np.minimum(63 - bit, 62)
    mantissa = (least >> np.maximum(bit - MANTISSA, 0).astype(np.uint64)) & np.uint64((1 << MANTISSA) - 1)
    packed = ((zeros + 1) << MANTISSA) | mantissa.astype(np.int64)
    return np.where(empty, 0, packed).astype(np.uint16)


def _band_matrix(regs: np.ndarray) -> np.ndarray:
    """The key of every band of every row."""
    bands = regs.reshape(len(regs), -1, ROWS).astype(np.uint64)
    keys = np.zeros(bands.shape[:2], np.uint64) + mix(np.arange(bands.shape[1], dtype=np.uint64) + np.uint64(1))
    for j in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, j])
    return keys


def band_keys(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of each band that has a filled register."""
    row, band = np.nonzero(regs.reshape(len(regs), -1, ROWS).any(axis=2))
    return row, _band_matrix(regs)[row, band]


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard similarity from registers less chance collisions, and the registers it rests on."""
    used = ((a != 0) | (b != 0)).sum(axis=1)
    equal = ((a == b) & (a != 0)).sum(axis=1)
    ratio = n_a / np.maximum(n_b, 1)
    chance = _COLLISION * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    share = equal / np.maximum(used, 1)
    return (share - chance) / (1 - chance), used


def _sketch(batches):
    for batch in batches:
        for words in words_of(batch.column(1), SPACED_LOWER):
            sets = shingle_sets(words)
            regs = registers(sets)
            n = np.array([len(s) for s in sets], np.int64)
            # the words in their order, as a polynomial of their hashes
            at = np.arange(len(words.hashes), dtype=np.uint64) - np.repeat(words.bounds[:-1], np.diff(words.bounds)).astype(np.uint64)
            keys = []
            for salt in (1, 2):
                place = mix(words.hashes + np.uint64(salt)) * mix(at * np.uint64(2) + np.uint64(salt))
                sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(place, dtype=np.uint64)])
                keys.append(mix(sums[words.bounds[1:]] - sums[words.bounds[:-1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(words.first_row, words.rows),
                    pa.array(n),
                    pa.array(keys[0]),
                    pa.array(keys[1]),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                ],
                names=["doc_id", "n", "key1", "key2", "regs"],
            )


def _bands(batches):
    for batch in batches:
        row, keys = band_keys(_matrix(batch.column(1)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(row)), pa.array(keys.view(np.int64))], names=["rep", "band"]
        )


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), ROUNDS * BUCKETS)


def _likely(batches):
    """Pairs whose sizes and registers allow the threshold."""
    least = THRESHOLD / 100
    for batch in batches:
        a, b, n_a, n_b, regs_a, regs_b = batch.columns
        n_a, n_b = n_a.to_numpy(), n_b.to_numpy()
        similar, used = estimate(_matrix(regs_a), _matrix(regs_b), n_a, n_b)
        slack = SLACK * np.sqrt(least * (1 - least) / np.maximum(used, 1))
        keep = (similar >= least - slack) & (100 * np.minimum(n_a, n_b) >= THRESHOLD * np.maximum(n_a, n_b))
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep))


def _sets(batches):
    for batch in batches:
        for words in words_of(batch.column(1), SPACED_LOWER):
            packed = pa.array([s.tobytes() for s in shingle_sets(words)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(words.first_row, words.rows), packed], names=["rep", "shingles"])


def _widen(batches):
    """The low bits of WIDE rounds of registers; 0 where both may be empty."""
    for batch in batches:
        sets = [np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()]
        wide = (registers(sets, _SEEDS[ROUNDS:]) & np.uint16(255)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([w.tobytes() for w in wide], pa.binary())], names=["rep", "wide"]
        )


def _alike(a: np.ndarray, b: np.ndarray, chance: float, slack: float) -> np.ndarray:
    """Whether registers of pairs agree so often that the threshold is possible."""
    least = THRESHOLD / 100
    used = np.maximum(((a != 0) | (b != 0)).sum(axis=1), 1)
    similar = (((a == b) & (a != 0)).sum(axis=1) / used - chance) / (1 - chance)
    return similar >= least - slack * np.sqrt(least * (1 - least) / used)


def _across(band: int, same_block: bool, block: np.ndarray, component, n, regs, wide) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a bucket's members that may be links between components."""
    first, second = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    keys = _band_matrix(regs).view(np.int64)
    left = np.arange(len(n)) if same_block else np.flatnonzero(block == block.min())
    right = np.arange(len(n)) if same_block else np.flatnonzero(block != block.min())
    for start in range(0, len(left), 64):
        rows = left[start : start + 64]
        fit = component[rows, None] != component[None, right]
        fit &= 100 * np.minimum(n[rows, None], n[None, right]) >= THRESHOLD * np.maximum(n[rows, None], n[None, right])
        if same_block:
            fit &= rows[:, None] < right[None, :]
        i, j = np.nonzero(fit)
        for at in range(0, len(i), 8192):
            a, b = rows[i[at : at + 8192]], right[j[at : at + 8192]]
            keep = _alike(regs[a], regs[b], _COLLISION * 2.0**-MANTISSA, SLACK)
            a, b = a[keep], b[keep]
            # a filled register is 0 in one case of 256 and then counts as empty
            keep = _alike(wide[a], wide[b], 1 / 256, WIDE_SLACK)
            a, b = a[keep], b[keep]
            # here, where a bounded number of pairs is held: a bucket may have millions that are alike
            own = _first_shared(regs[a], regs[b], keys[a]) == band
            first.append(a[own])
            second.append(b[own])
    return np.concatenate(first), np.concatenate(second)


def _first_shared(a: np.ndarray, b: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Key of the first filled band that each pair shares, out of the keys of all bands of its first member."""
    bands = (len(a), a.shape[1] // ROWS, ROWS)
    equal = (a == b).reshape(bands).all(axis=2)
    filled = (a != 0).reshape(bands).any(axis=2)
    return keys[np.arange(len(a)), (equal & filled).argmax(axis=1)]


def _compare(batches):
    """Pairs of members of different components; rows come in order of band and blocks."""
    key, held = None, []

    def pairs():
        columns = list(zip(*held, strict=True))
        rep, block, component, n = (np.array(columns[k], np.int64) for k in range(4))
        regs = np.frombuffer(b"".join(columns[4]), np.uint16).reshape(len(n), -1)
        wide = np.frombuffer(b"".join(columns[5]), np.uint8).reshape(len(n), -1)
        i, j = _across(key[0], key[1] == key[2], block, component, n, regs, wide)
        a, b = np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:3] != key:
                if len(held) > 1:
                    yield pairs()
                key, held = row[:3], []
            held.append(row[3:])
    if len(held) > 1:
        yield pairs()


def _verified(batches):
    """Pairs whose full sets reach the threshold."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            keep.append(100 * common >= THRESHOLD * (len(both) - common))
        yield pa.RecordBatch.from_arrays(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


class _Linker:
    """Candidate pairs to verified links."""

    def __init__(self, scratch: Scratch, reps: DataFrame, sets: DataFrame) -> None:
        self.scratch, self.reps, self.sets = scratch, reps, sets

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose registers allow the threshold."""
        a, b = self._side("a", self.reps, "n", "regs"), self._side("b", self.reps, "n", "regs")
        known = pairs.join(a, "a").join(b, "b").select("a", "b", "n_a", "n_b", "regs_a", "regs_b")
        return self.scratch.store(known.mapInArrow(_likely, "a long, b long"), "likely")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """Pairs whose full sets reach the threshold."""
        a, b = self._side("a", self.sets, "shingles"), self._side("b", self.sets, "shingles")
        whole = pairs.join(a, "a").join(b, "b").select("a", "b", "shingles_a", "shingles_b")
        return self.scratch.store(whole.mapInArrow(_verified, "a long, b long"), name)

    @staticmethod
    def _side(name: str, table: DataFrame, *columns: str) -> DataFrame:
        return table.select(F.col("rep").alias(name), *(F.col(c).alias(f"{c}_{name}") for c in columns))


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_components(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Texts without words (null, empty, white space) have no shingles and are linked with nothing.
    Rows with the same id are one document: what either of its texts links to, it links to. Rows
    without an id are linked with nothing; their component is null and they are kept.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dedup")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketch = scratch.store(
        rows.mapInArrow(_sketch, "doc_id long, n long, key1 long, key2 long, regs binary"), "sketch"
    )
    linked = sketch.where("n > 0 AND doc_id IS NOT NULL")
    classes = linked.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep"))
    reps = scratch.store(
        linked.join(classes, ["key1", "key2"])
        .where("doc_id = rep")
        .select("rep", "n", "regs", "key1", "key2")
        .dropDuplicates(["rep", "key1", "key2"]),
        "reps",
    ).drop("key1", "key2")
    bands = scratch.store(reps.select("rep", "regs").mapInArrow(_bands, "rep long, band long"), "bands")
    order = F.xxhash64("rep", "band")
    buckets = (
        bands.groupBy("band")
        .agg(F.count("*").alias("size"), F.min(F.struct(order.alias("o"), "rep"))["rep"].alias("leader"))
        .where("size > 1")
    )
    members = scratch.store(bands.join(buckets, "band"), "members")
    scratch.drop("bands")
    needed = members.select("rep").distinct()
    texts = rows.withColumnRenamed("doc_id", "rep").join(needed, "rep", "left_semi")
    texts = texts.withColumn("same", F.xxhash64("text")).dropDuplicates(["rep", "same"])
    sets = scratch.store(texts.select("rep", "text").mapInArrow(_sets, "rep long, shingles binary"), "sets")
    linker = _Linker(scratch, reps, sets)
    pairs = scratch.store(members.where("rep != leader").select(*_ordered("leader", "rep")).distinct(), "pairs-0")
    links = linker.verified(linker.likely(pairs), "links-0").union(_one_document(linked.join(classes, ["key1", "key2"])))
    found = components(links, scratch, "components-0")
    # buckets of which not every pair was compared, and which are not one component
    left = members.where("size > 2").select("band", "rep", "size")
    left = left.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    left = left.withColumn("component", F.coalesce("component", "rep"))
    several = left.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y")
    left = scratch.store(left.join(several.select("band"), "band", "left_semi"), "unresolved")
    pairs = scratch.store(_across_components(left, reps, sets).distinct(), "pairs-1")
    # components are joined by what is found between them
    fresh = linker.verified(pairs, "links-1")
    found = components(found.select(F.col("component").alias("a"), F.col("node").alias("b")).union(fresh), scratch, "components-1")
    by_class = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key1", "key2", F.coalesce("component", "rep").alias("component")
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        sketch.join(by_class, ["key1", "key2"], "left")
        .select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def _across_components(left: DataFrame, reps: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs to verify of buckets in several components, a bucket in blocks of BLOCK members."""
    wide = sets.join(left.select("rep").distinct(), "rep", "left_semi").mapInArrow(_widen, "rep long, wide binary")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int")
    rows = left.withColumn("block", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.join(reps, "rep").join(wide, "rep")
    keys = ["band", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")]
    rows = rows.select(*keys, "rep", "block", "component", "n", "regs", "wide")
    parts = partitions_for(left.sparkSession)
    ordered = rows.repartition(parts, "band", "x", "y").sortWithinPartitions("band", "x", "y")
    return ordered.mapInArrow(_compare, "a long, b long")


def _one_document(rows: DataFrame) -> DataFrame:
    """Links between the classes of an id that has several texts."""
    several = rows.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a != z")
    return rows.join(several, "doc_id").select("a", F.col("rep").alias("b")).distinct()


def drop_near_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the smallest id of their component, with the columns they came with."""
    gone = near_components(docs, id_column, text).where("NOT kept").select("doc_id").distinct()
    prefix = free_prefix(docs.columns)
    gone = gone.withColumnRenamed("doc_id", prefix + "id")
    return docs.join(gone, F.col(id_column).cast("long") == F.col(prefix + "id"), "left_anti")
