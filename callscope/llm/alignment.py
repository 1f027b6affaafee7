"""Alignment of two tokenizers over a corpus, counted by inverted bitmaps of token pairs.

A is a byte-level BPE vocabulary, B a sentencepiece one with byte fallback. Both read a text with a
space before it; where their token boundaries meet, groups end, and every A token is linked with
every B token that has a byte in common with it. Between a character that is not a space and a space
before a word both have a boundary, so a text is a row of units that are aligned once and remembered.

Documents are dealt into blocks. For every pair of ids a block has a posting: compressed bitmaps of
its documents, one for each binary digit of the number of the pair's links there. The union of these
planes is the bitmap of the documents with the pair; its bits give the document count, and the bits
of plane k, 2^k each, the link count. A posting is one row, so a pair that all texts have costs a
row per block. Blocks' counts are added up over the corpus, and the pairs' scores are joined to the
postings, which say for each document of the block what it gets.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm import bpe
from callscope.llm.token_counts import Counter
from callscope.llm.work import Scratch

#: Most documents of a block, and the bytes of text that end it.
BLOCK_DOCS, BLOCK_BYTES = 4096, 8 << 20
#: A bitmap of so many documents and more has a bit for each document of a block, others list them.
_DENSE = BLOCK_DOCS // 16
_BITMAP = BLOCK_DOCS // 8
#: Text whose new units are learnt at once, and different units a worker remembers before it starts anew.
SLICE_BYTES, CACHE_UNITS = 1 << 20, 300_000
#: Room for an id of the second vocabulary, and for a document's number, in one 64-bit key.
_ID_BITS, _DOC_BITS = 20, 12
_SPACE_MARK = "▁"
_ODD_SPACE = re.compile(r" (?:\s|$)")
_CUT = re.compile(r"(?<! ) (?=\S)")


def units_of(text: str) -> list[str]:
    """Parts of a text that both vocabularies encode apart, each without the one space before it."""
    whole = " " + text
    if not _ODD_SPACE.search(whole):
        return text.split(" ")
    units = _CUT.split(whole)
    return units[1:] if not units[0] else [units[0][1:], *units[1:]]


class Ragged:
    """Rows of an array that grows."""

    def __init__(self, kind) -> None:
        self.flat = np.empty(0, kind)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)

    def extend(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype, copy=False)])

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows one after the other, and the size of each."""
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[rows] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self.flat[at], sizes


class Aligner:
    """Aligns the tokens of two vocabularies, unit by unit."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a = bpe.Vocabulary(a_path)
        self.a_sizes = np.array([len(x) for x in self.a.bytes], np.int64)
        counter = Counter(b_path)
        if not counter.by_word:
            raise ValueError("a piece of the second vocabulary has a space after another character")
        self.b = counter.processor
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        if max(len(self.a.bytes), len(b_bytes)) > 1 << _ID_BITS:
            raise ValueError("more ids than a key has room for")
        self.b_bytes = Ragged(np.uint8)
        self.b_bytes.extend(np.frombuffer(b"".join(b_bytes), np.uint8), np.array([len(x) for x in b_bytes], np.int64))
        self.b_sizes = self.b_bytes.sizes
        shown = [str(i).encode() for i in range(max(len(self.a.bytes), len(b_bytes)))]
        self.digits = np.array(shown, f"S{len(shown[-1])}").view(np.uint8).reshape(len(shown), -1)
        self.n_digits = np.array([len(x) for x in shown], np.int64)
        self.space = self.b.piece_to_id(_SPACE_MARK)
        self.reset()

    def reset(self) -> None:
        self.slots = bpe._Slots()
        self.known = 0
        self.pairs = Ragged(np.int64)
        self.groups = Ragged(np.uint8)
        self.n_a, self.n_b, self.n_groups = (np.empty(0, np.int64) for _ in range(3))
        self.whole = np.empty(0, bool)

    def slots_of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all texts' units, and where each text's begin. Null and empty texts have none."""
        if len(self.slots) > CACHE_UNITS:
            self.reset()
        slot = self.slots.__getitem__
        used: list[int] = []
        bounds = np.zeros(len(texts) + 1, np.int64)
        for n, text in enumerate(texts, 1):
            if text:
                used += map(slot, units_of(text))
            bounds[n] = len(used)
        self._learn()
        return np.array(used, np.int64), bounds

    def _learn(self) -> None:
        new = list(self.slots)[self.known :]
        if not new:
            return
        a_ids, a_n = bpe.encode_parts([" " + u for u in new], self.a)
        a_ids = a_ids.astype(np.int64)
        b_rows = [x or [self.space] for x in self.b.encode(new, num_threads=1)]
        b_n = np.array([len(x) for x in b_rows], np.int64)
        b_ids = np.fromiter(itertools.chain.from_iterable(b_rows), np.int64, int(b_n.sum()))
        whole = self._reads_alike([b" " + u.encode() for u in new], a_ids, a_n, b_ids, b_n)
        unit_a, unit_b = np.repeat(np.arange(len(new)), a_n), np.repeat(np.arange(len(new)), b_n)
        # units that do not read alike have no tokens here: their texts have none either
        a_ids, unit_a = a_ids[whole[unit_a]], unit_a[whole[unit_a]]
        b_ids, unit_b = b_ids[whole[unit_b]], unit_b[whole[unit_b]]
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        ends = np.union1d(a_ends, b_ends)
        # every stretch between two ends of either kind is one link
        of_a, of_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        links = (a_ids[of_a] << _ID_BITS) | b_ids[of_b]
        self.pairs.extend(links, np.bincount(unit_a[of_a], minlength=len(new)))
        common = np.intersect1d(a_ends, b_ends, assume_unique=True)
        n_groups = np.bincount(unit_a[np.searchsorted(a_ends, common)], minlength=len(new))
        a_group, b_group = np.searchsorted(common, a_ends), np.searchsorted(common, b_ends)
        self.groups.extend(*self._fragments(a_ids, a_group, unit_a, b_ids, b_group, unit_b, len(new)))
        self.n_a = np.concatenate([self.n_a, np.bincount(unit_a, minlength=len(new))])
        self.n_b = np.concatenate([self.n_b, np.bincount(unit_b, minlength=len(new))])
        self.n_groups = np.concatenate([self.n_groups, n_groups])
        self.whole = np.concatenate([self.whole, whole])
        self.known = len(self.slots)

    def _reads_alike(self, raw: list[bytes], a_ids: np.ndarray, a_n: np.ndarray, b_ids: np.ndarray, b_n: np.ndarray) -> np.ndarray:
        """Of which units both vocabularies give every byte back. The first one's tokens are the unit's bytes, merged."""
        n = len(raw)
        sizes = np.array([len(r) for r in raw], np.int64)
        a_sizes = np.bincount(np.repeat(np.arange(n), a_n), self.a_sizes[a_ids], minlength=n)
        unit_b = np.repeat(np.arange(n), b_n)
        b_sizes = np.bincount(unit_b, self.b_sizes[b_ids], minlength=n)
        same = (a_sizes == sizes) & (b_sizes == sizes)
        # of units of equal size the bytes are side by side
        given, _ = self.b_bytes.take(b_ids[same[unit_b]])
        wanted = np.frombuffer(b"".join(itertools.compress(raw, same.tolist())), np.uint8)
        wrong = np.repeat(np.flatnonzero(same), sizes[same])[given != wanted]
        same[wrong] = False
        return same

    def _fragments(self, a_ids, a_group, unit_a, b_ids, b_group, unit_b, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Each unit's groups as text, ``a1,a2|b1;a3|b2,b3;``, and its size."""
        groups = int(a_group[-1]) + 1 if len(a_group) else 0
        a_cut, b_cut = (np.searchsorted(g, np.arange(groups + 1)) for g in (a_group, b_group))
        place_a = np.arange(len(a_ids)) + b_cut[a_group]
        place_b = np.arange(len(b_ids)) + a_cut[b_group + 1]
        ids = np.empty(len(a_ids) + len(b_ids), np.int64)
        marks, unit = np.full(len(ids), ord(","), np.uint8), np.empty(len(ids), np.int64)
        ids[place_a], ids[place_b] = a_ids, b_ids
        unit[place_a], unit[place_b] = unit_a, unit_b
        marks[place_a[a_cut[1:] - 1]] = ord("|")
        marks[place_b[b_cut[1:] - 1]] = ord(";")
        sizes = self.n_digits[ids]
        ends = np.cumsum(sizes + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        out[ends - 1] = marks
        for k in range(self.digits.shape[1]):
            has = sizes > k
            out[(ends - sizes - 1)[has] + k] = self.digits[ids[has], k]
        return out, np.bincount(unit, sizes + 1, minlength=n).astype(np.int64)


_LOADED: dict[tuple[str, str], Aligner] = {}


def loaded(a_path: str, b_path: str) -> Aligner:
    """The aligner of a worker, kept from one task to the next."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Aligner(a_path, b_path)
    return _LOADED[a_path, b_path]


def bit_planes(row: np.ndarray, doc: np.ndarray, times: np.ndarray, rows: int) -> pa.ListArray:
    """Per row a list of bitmaps of documents, one for each binary digit of ``times``.

    A bitmap is the 16-bit numbers of its documents in ascending order or, from ``_DENSE`` documents
    on, one bit for each document of a block. ``row`` and ``doc`` together are unique.
    """
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, row, times)
    digits = np.zeros(rows, np.int64)
    while (most > 0).any():
        digits += most > 0
        most >>= 1
    first = np.concatenate([[0], np.cumsum(digits)])
    plane, member = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in range(int(digits.max()) if rows else 0):
        has = (times >> k) & 1 > 0
        plane.append(first[row[has]] + k)
        member.append(doc[has])
    plane, member = np.concatenate(plane), np.concatenate(member)
    order = np.argsort(plane * BLOCK_DOCS + member)
    plane, member = plane[order], member[order].astype("<u2")
    sizes = np.bincount(plane, minlength=first[-1])
    n_bytes = np.where(sizes < _DENSE, 2 * sizes, _BITMAP)
    ends = np.cumsum(n_bytes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    sparse = (sizes < _DENSE)[plane]
    at = np.repeat(ends - n_bytes, sizes) + 2 * (np.arange(len(plane)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    values = member[sparse].view(np.uint8).reshape(-1, 2)
    out[at[sparse]] = values[:, 0]
    out[at[sparse] + 1] = values[:, 1]
    starts = np.cumsum(sizes) - sizes
    for p in np.flatnonzero(sizes >= _DENSE).tolist():
        bits = np.zeros(BLOCK_DOCS, np.uint8)
        bits[member[starts[p] : starts[p] + sizes[p]]] = 1
        out[ends[p] - _BITMAP : ends[p]] = np.packbits(bits, bitorder="little")
    offsets = np.concatenate([[0], ends])
    if offsets[-1] >= 1 << 31:
        raise ValueError("a block's bitmaps have more than 2 GiB")
    bitmaps = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(out)])
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), bitmaps)


def members(planes: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, digit, document) of all set bits."""
    lists = np.asarray(planes.value_lengths(), np.int64)
    bitmaps = planes.flatten().cast(pa.large_binary())
    of_row = np.repeat(np.arange(len(lists)), lists)
    digit = np.arange(len(of_row)) - np.repeat(np.cumsum(lists) - lists, lists)
    if not len(bitmaps):
        return (np.empty(0, np.int64),) * 3
    _, raw_offsets, raw = bitmaps.buffers()
    offsets = np.frombuffer(raw_offsets, np.int64)[bitmaps.offset : bitmaps.offset + len(bitmaps) + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    n_bytes = np.diff(offsets)
    sparse = np.flatnonzero(n_bytes < _BITMAP)
    sizes = n_bytes[sparse] // 2
    at = np.repeat(offsets[sparse], sizes) + 2 * (np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    which, docs = [np.repeat(sparse, sizes)], [data[at].astype(np.int64) | (data[at + 1].astype(np.int64) << 8)]
    for p in np.flatnonzero(n_bytes == _BITMAP).tolist():
        own = np.flatnonzero(np.unpackbits(data[offsets[p] : offsets[p + 1]], bitorder="little"))
        which.append(np.full(len(own), p))
        docs.append(own)
    which = np.concatenate(which)
    return of_row[which], digit[which], np.concatenate(docs)


_ALIGNED = "block long, ord int, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a int, b int, planes array<binary>"
_DOC_FIGURES = ("n_a", "n_b", "n_groups", "n_links")


class _Block:
    """Documents until there are enough of them for a block's postings."""

    def __init__(self) -> None:
        self.docs, self.n_bytes = 0, 0
        self.links: list[np.ndarray] = []

    def add(self, doc: np.ndarray, pair: np.ndarray) -> None:
        """Links of the next documents, counted from 0."""
        self.links.append((pair << _DOC_BITS) | (doc + self.docs))

    def postings(self, number: int, id_type: pa.DataType) -> pa.RecordBatch:
        links = np.concatenate([np.empty(0, np.int64), *self.links])
        self.links = []
        links.sort()
        firsts = np.flatnonzero(np.diff(links, prepend=-1))
        times = np.diff(firsts, append=len(links))
        links = links[firsts]
        pair, doc = links >> _DOC_BITS, links & (BLOCK_DOCS - 1)
        new = np.diff(pair, prepend=-1) != 0
        pairs, row = pair[new], np.cumsum(new) - 1
        n = len(pairs)
        columns = {
            "block": pa.array(np.full(n, number)),
            "a": pa.array((pairs >> _ID_BITS).astype(np.int32)),
            "b": pa.array((pairs & ((1 << _ID_BITS) - 1)).astype(np.int32)),
            "planes": bit_planes(row, doc, times, n),
        }
        return _batch(columns, n, id_type)


_TYPES = {
    "block": pa.int64(),
    "ord": pa.int32(),
    **dict.fromkeys(_DOC_FIGURES, pa.int64()),
    "groups_sha256": pa.string(),
    "a": pa.int32(),
    "b": pa.int32(),
    "planes": pa.list_(pa.binary()),
}


def _batch(columns: dict, n: int, id_type: pa.DataType) -> pa.RecordBatch:
    """All columns of the aligned table, null where none are given."""
    types = {"doc_id": id_type} | _TYPES
    return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(n, t) for c, t in types.items()], names=list(types))


def _align(a_path: str, b_path: str):
    def run(batches):
        aligner = loaded(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            at, id_type = 0, batch.column(0).type
            sizes = pc.binary_length(batch.column(1)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            while at < batch.num_rows:
                own = sizes[at : at + BLOCK_DOCS - block.docs]
                room = min(SLICE_BYTES, BLOCK_BYTES - block.n_bytes)
                upto = at + min(int(np.searchsorted(np.cumsum(own), room)) + 1, len(own))
                yield _documents(aligner, batch.slice(at, upto - at), number, block)
                block.docs += upto - at
                block.n_bytes += int(sizes[at:upto].sum())
                at = upto
                if block.docs == BLOCK_DOCS or block.n_bytes >= BLOCK_BYTES:
                    yield block.postings(number, id_type)
                    block, number = _Block(), number + 1
        if block.docs:
            yield block.postings(number, id_type)

    return run


def _documents(aligner: Aligner, batch: pa.RecordBatch, number: int, block: _Block) -> pa.RecordBatch:
    """Rows of some documents; their pairs go to the block."""
    slots, bounds = aligner.slots_of(batch.column(1).to_pylist())
    n = batch.num_rows
    doc = np.repeat(np.arange(n), np.diff(bounds))
    whole = np.bincount(doc, ~aligner.whole[slots], minlength=n) == 0
    doc, slots = doc[whole[doc]], slots[whole[doc]]

    def summed(of_unit: np.ndarray) -> pa.Array:
        return pa.array(np.bincount(doc, of_unit[slots], minlength=n).astype(np.int64))

    shown, sizes = aligner.groups.take(slots)
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(doc, np.arange(n + 1))].tolist()
    raw = memoryview(shown)
    hashes = [hashlib.sha256(raw[p : q - 1]).hexdigest() if q > p else "" for p, q in zip(ends[:-1], ends[1:], strict=True)]
    pairs, sizes = aligner.pairs.take(slots)
    block.add(np.repeat(doc, sizes), pairs)
    columns = {
        "doc_id": batch.column(0),
        "block": pa.array(np.full(n, number)),
        "ord": pa.array(np.arange(block.docs, block.docs + n, dtype=np.int32)),
        "n_a": summed(aligner.n_a),
        "n_b": summed(aligner.n_b),
        "n_groups": summed(aligner.n_groups),
        "n_links": summed(aligner.pairs.sizes),
        "groups_sha256": pa.array(hashes, pa.string()),
    }
    return _batch(columns, n, batch.column(0).type)


def _popcounts(batches):
    """Document and link counts of each posting."""
    for batch in batches:
        n = batch.num_rows
        row, digit, doc = members(batch.column(2))
        links = np.zeros(n, np.int64)
        np.add.at(links, row, np.int64(1) << digit)
        union = np.unique(row * BLOCK_DOCS + doc) // BLOCK_DOCS
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.bincount(union, minlength=n)), pa.array(links)],
            names=["a", "b", "n_docs", "n_links"],
        )


class Alignment:
    """The aligned corpus: a row per document, and the postings of its pairs."""

    def __init__(self, docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text") -> None:
        self.scratch = Scratch(docs.sparkSession, "alignment")
        rows = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
        id_type = rows.schema["doc_id"].dataType.simpleString()
        schema = f"doc_id {id_type}, {_ALIGNED}"
        aligned = self.scratch.store(rows.mapInArrow(_align(a_path, b_path), schema), "aligned")
        self.documents = aligned.where("ord IS NOT NULL").select("doc_id", "block", "ord", *_DOC_FIGURES, "groups_sha256")
        self.postings = aligned.where("ord IS NULL").select("block", "a", "b", "planes")

    def pair_counts(self) -> DataFrame:
        """Per pair of ids that are linked anywhere: a, b, n_docs and n_links over the corpus."""
        counted = self.postings.select("a", "b", "planes").mapInArrow(_popcounts, "a int, b int, n_docs long, n_links long")
        return counted.groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))

    def scores(self) -> DataFrame:
        """Per document its figures, ``n_best`` and ``count_sum``."""
        counts = self.scratch.store(self.pair_counts(), "pairs")
        # one row per id of the second vocabulary
        best = counts.groupBy("b").agg(F.max("n_links").alias("most"))
        scored = counts.join(F.broadcast(best), "b").select("a", "b", F.col("n_links").alias("score"), (F.col("n_links") == F.col("most")).alias("best"))
        # pairs grow with the corpus: the same join at every size
        told = self.postings.join(scored.hint("merge"), ["a", "b"]).select(F.col("block").alias("of"), "planes", "score", "best")
        out = self.documents.schema
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in out if f.name not in ("block", "ord"))
        return self.documents.groupBy("block").cogroup(told.groupBy("of")).applyInArrow(_told, schema + ", n_best long, count_sum long")


def _told(docs: pa.Table, postings: pa.Table) -> pa.Table:
    """A block's documents with what its postings bring them."""
    n_best, count_sum = np.zeros(BLOCK_DOCS, np.int64), np.zeros(BLOCK_DOCS, np.int64)
    for batch in postings.to_batches():
        row, digit, doc = members(batch.column(1))
        links = np.int64(1) << digit
        score = batch.column(2).to_numpy(zero_copy_only=False)
        best = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
        np.add.at(count_sum, doc, links * score[row])
        np.add.at(n_best, doc, links * best[row])
    at = docs.column("ord").to_numpy()
    kept = docs.drop_columns(["block", "ord"])
    return kept.append_column("n_best", pa.array(n_best[at])).append_column("count_sum", pa.array(count_sum[at]))


def align(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum.

    ``n_a`` and ``n_b`` are tokens, ``n_groups`` the stretches between common boundaries, ``n_links``
    the overlapping token pairs. A pair's count is its links in all documents; ``n_best`` links have a
    count that no other pair of their B id exceeds, ``count_sum`` adds up the counts of all links.
    ``groups_sha256`` is of the groups' ids. Special tokens' strings are ordinary text.

    Null and empty texts, and texts that a vocabulary does not give back byte for byte (as with the
    mark that stands for a space), have no tokens: zeros and an empty ``groups_sha256``. Equal rows
    each count and get their result; ids are passed on, null or not. An empty table gives no rows.
    """
    return Alignment(docs, a_path, b_path, id_column, text).scores()
