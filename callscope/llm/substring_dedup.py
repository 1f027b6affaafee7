"""Substring dedup by seed and extend.

Seeds are winnowed anchors: of the ``ANCHOR``-word shingles in every window of ``WINDOW`` words the
one with the smallest hash. Equal windows have equal anchors, so documents joined on their anchors
find every common window. Only anchors that more than one document has are extended: to every
window in which they are the anchor, up to ``WINDOW - ANCHOR`` words to either side, which are then
joined on the whole window to find the smallest id they start in. Windows that overlap or touch are
maximal repeats of WINDOW words or more, and are removed from all documents but the first.

Each group of documents asks once per different anchor and window (see ``requests``), so neither
copies nor frequent passages make pairs. Words and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from callscope.llm.requests import dealt, grouped, groups_for, packed, unique, unpacked
from callscope.llm.words import SPACED, Words, grams, words_of
from callscope.llm.work import Scratch

WINDOW, ANCHOR = 13, 5


def _windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start word, anchor, hash) of every window that lies in one row."""
    n = len(words.hashes) - WINDOW + 1
    if n <= 0:
        none = np.empty(0, np.uint64)
        return np.empty(0, np.int64), none, none
    row = words.row_of_word()
    shingles = grams(words.hashes, ANCHOR)
    anchor = shingles[:n].copy()
    for j in range(1, WINDOW - ANCHOR + 1):
        np.minimum(anchor, shingles[j : j + n], out=anchor)
    start = np.flatnonzero(row[:n] == row[WINDOW - 1 :])
    return start, anchor[start], grams(words.hashes, WINDOW)[start]


def _doc_ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids, and which of them are known."""
    column = table.column("doc_id").combine_chunks()
    return column.fill_null(0).to_numpy(), column.is_valid().to_numpy(zero_copy_only=False)


def _ends(values: np.ndarray, group: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and the largest value of each group."""
    least, most = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min)
    np.minimum.at(least, group, values)
    np.maximum.at(most, group, values)
    return least, most


def _ask_anchors(owners: int):
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, known = _doc_ids(table)
        anchors, docs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for words in words_of(table.column("text"), SPACED):
            start, anchor, _ = _windows(words)
            row = words.row_of_word()[start] + words.first_row
            # neighbouring windows mostly have the same anchor
            new = known[row] & np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])][: len(row)]
            anchors.append(anchor[new])
            docs.append(ids[row[new]])
        anchor, doc = np.concatenate(anchors), np.concatenate(docs)
        keys, _, number = unique(anchor)
        least, most = _ends(doc, number, len(keys))
        return dealt(key[0].as_py(), owners, keys, several=(least != most).astype(np.uint8))

    return ask


def _shared_anchors(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """To each group, those of its anchors that another group or several of its documents have."""
    anchor, row = unpacked(table.column("keys"), np.uint64, ascending=True)
    several, _ = unpacked(table.column("several"), np.uint8)
    keys, _, number = unique(anchor)
    shared = np.bincount(number, minlength=len(keys)) > 1
    shared[number[several > 0]] = True
    wanted = shared[number]
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row[wanted], minlength=table.num_rows))])
    return pa.table({"bucket": table.column("bucket"), "anchors": packed(anchor[wanted], bounds, ascending=True)})


def _ask_windows(owners: int):
    def ask(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        shared = np.unique(unpacked(answers.column("anchors"), np.uint64, ascending=True)[0])
        ids, known = _doc_ids(docs)
        windows, of_doc = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for words in words_of(docs.column("text"), SPACED):
            start, anchor, window = _windows(words)
            row = words.row_of_word()[start] + words.first_row
            seeded = known[row] & _among(anchor, shared)
            windows.append(window[seeded])
            of_doc.append(ids[row[seeded]])
        window, doc = np.concatenate(windows), np.concatenate(of_doc)
        keys, _, number = unique(window)
        least, most = _ends(doc, number, len(keys))
        return dealt(key[0].as_py(), owners, keys, least=least, several=(least != most).astype(np.uint8))

    return ask


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _first_documents(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """To each group, the windows that some document with a larger id than the first has, and that first id."""
    window, row = unpacked(table.column("keys"), np.uint64, ascending=True)
    least, _ = unpacked(table.column("least"), np.int64)
    several, _ = unpacked(table.column("several"), np.uint8)
    keys, _, number = unique(window)
    first = _ends(least, number, len(keys))[0][number]
    wanted = (first < least) | (several > 0)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(row[wanted], minlength=table.num_rows))])
    return pa.table(
        {
            "bucket": table.column("bucket"),
            "windows": packed(window[wanted], bounds, ascending=True),
            "first": packed(first[wanted], bounds),
        }
    )


def _removed(words: Words, ids: np.ndarray, known: np.ndarray, windows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which words lie in a maximal repeat that an earlier document has."""
    start, _, window = _windows(words)
    row = words.row_of_word()[start] + words.first_row
    gone = np.zeros(len(words.hashes) + 1, np.int64)
    if len(windows) and len(start):
        at = np.minimum(np.searchsorted(windows, window), len(windows) - 1)
        repeated = known[row] & (windows[at] == window) & (first[at] < ids[row])
        np.add.at(gone, start[repeated], 1)
        np.add.at(gone, start[repeated] + WINDOW, -1)
    return np.cumsum(gone)[:-1] > 0


def _cut(with_text: bool):
    def cut(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        windows, _ = unpacked(answers.column("windows"), np.uint64, ascending=True)
        first, _ = unpacked(answers.column("first"), np.int64)
        order = np.argsort(windows)
        windows, first = windows[order], first[order]
        ids, known = _doc_ids(docs)
        n_words, n_removed, hashes, texts = [], [], [], []
        for words in words_of(docs.column("text"), SPACED):
            gone = _removed(words, ids, known, windows, first)
            sums = np.concatenate([[0], np.cumsum(gone)])
            n_words.append(np.diff(words.bounds))
            n_removed.append(sums[words.bounds[1:]] - sums[words.bounds[:-1]])
            raw = words.data.tobytes()
            for i, (a, b) in enumerate(zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True)):
                if n_removed[-1][i]:
                    kept = np.flatnonzero(~gone[a:b]) + a
                    parts = zip(words.starts[kept].tolist(), words.ends[kept].tolist(), strict=True)
                    text = b" ".join([raw[x:y] for x, y in parts])
                else:
                    text = b" ".join(raw[words.starts[a] : words.ends[b - 1]].split()) if b > a else b""
                hashes.append(hashlib.sha256(text).hexdigest())
                if with_text:
                    texts.append(text.decode())
        none = [np.empty(0, np.int64)]
        columns = {
            "doc_id": docs.column("doc_id"),
            "n_words": pa.array(np.concatenate(none + n_words)),
            "n_removed": pa.array(np.concatenate(none + n_removed)),
            "kept_sha256": pa.array(hashes, pa.string()),
        }
        return pa.table(columns | ({"kept_text": pa.array(texts, pa.string())} if with_text else {}))

    return cut


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text.

    Null, empty and blank texts have no words, and their kept text is empty; texts of fewer than 13
    words lose none. Rows with equal ids do not count as earlier than each other. Rows without an id
    lose no words and make no other lose any. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "substring-dedup")
    groups = groups_for(spark, docs, text)
    rows = grouped(docs, id_column, text, groups)
    asked = rows.groupBy("bucket").applyInArrow(
        _ask_anchors(groups), "owner int, bucket int, keys binary, several binary"
    )
    seeds = scratch.store(
        asked.groupBy("owner").applyInArrow(_shared_anchors, "bucket int, anchors binary"), "seeds"
    )
    asked = rows.groupBy("bucket").cogroup(seeds.groupBy("bucket")).applyInArrow(
        _ask_windows(groups), "owner int, bucket int, keys binary, least binary, several binary"
    )
    first = scratch.store(
        asked.groupBy("owner").applyInArrow(_first_documents, "bucket int, windows binary, first binary"), "first"
    )
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return rows.groupBy("bucket").cogroup(first.groupBy("bucket")).applyInArrow(_cut(with_text), schema)
