"""Byte-level BPE encoding and decoding with a pair occurrence index.

The pieces that are new to a task are encoded together: every pair of neighbouring tokens is mapped
to all its positions, the active merge ranks are applied in ascending order, each to all positions
of its pair, and the lists of the pairs that a merge creates are extended. Since a merge can only
use tokens that a lower rank made, which is checked when the vocabulary is loaded, one ascending
sweep gives every piece what merging it alone by lowest rank would.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T


#: Different space-separated pieces a worker remembers before it starts anew.
CACHE_PIECES = 250_000
#: Bytes of the texts that a worker encodes, decodes and hashes together; a longer text is alone.
SLICE_BYTES = 4_000_000
#: Code points that any version of Unicode assigns, but for private use.
_ASSIGNED = (range(0xD800), range(0xE000, 0x34000), range(0xE0000, 0xE1000))
_LETTER, _NUMBER, _OTHER, _SPACE = range(4)
#: After a single space and before something else a piece always begins, so texts without
#: two white spaces in a row are cut there first.
_RUN = re.compile(r" (?:\s|$)")


def byte_symbols() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Token bytes, merge rules and special tokens of a byte-level BPE file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.splitter = Splitter(path)
        of_symbol = byte_symbols()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.bytes[i] = bytes(of_symbol[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.of_byte = np.zeros(256, np.int32)
        for symbol, b in of_symbol.items():
            self.of_byte[b] = ids[symbol]
        self.pair: list[tuple[int, int]] = []
        self.made: list[int] = []
        ready = set(self.of_byte.tolist())
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right = ids[a], ids[b]
            if left not in ready or right not in ready:
                raise ValueError(f"merge {rank} uses a token that no lower rank makes")
            self.pair.append((left, right))
            self.made.append(ids[a + b])
            ready.add(ids[a + b])
        keys = np.array([(a << 32) | b for a, b in self.pair], np.int64)
        self.keys, self.rank_of_key = np.unique(keys, return_index=True)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if it has none."""
        key = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank_of_key[at], -1)


class PairIndex:
    """Tokens of many pieces, and for each rank the positions where its pair may stand."""

    def __init__(self, pieces: list[bytes], vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        sizes = np.array([len(p) for p in pieces], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(sizes)])
        n = int(self.bounds[-1])
        place = np.int32 if n < 2**31 - 1 else np.int64
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        self.token = vocabulary.of_byte[raw]
        self.following = np.arange(1, n + 1, dtype=place)
        self.before = np.arange(-1, n - 1, dtype=place)
        filled = sizes > 0
        self.following[self.bounds[1:][filled] - 1] = -1
        self.before[self.bounds[:-1][filled]] = -1
        self.places: list[list[np.ndarray] | None] = [None] * len(vocabulary.pair)
        self._list(np.arange(n, dtype=place))

    def _list(self, at: np.ndarray) -> None:
        """Enter the pairs that begin at these positions."""
        after = self.following[at]
        inside = after >= 0
        at = at[inside]
        rank = self.vocabulary.ranks(self.token[at], self.token[after[inside]])
        known = rank >= 0
        rank, at = rank[known], at[known]
        if not len(at):
            return
        order = np.argsort(rank, kind="stable")
        rank, at = rank[order], at[order]
        cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
        edges = [0, *cuts.tolist(), len(at)]
        for a, b, r in zip(edges[:-1], edges[1:], rank[np.array(edges[:-1])].tolist(), strict=True):
            if self.places[r] is None:
                self.places[r] = [at[a:b]]
            else:
                self.places[r].append(at[a:b])

    def sweep(self) -> None:
        token, following, before = self.token, self.following, self.before
        for rank in range(len(self.places)):
            lists = self.places[rank]
            if lists is None:
                continue
            self.places[rank] = None
            left, right = self.vocabulary.pair[rank]
            i = lists[0] if len(lists) == 1 else np.concatenate(lists)
            i = i[token[i] == left]
            j = following[i]
            stands = (j >= 0) & (token[j] == right)
            i, j = i[stands], j[stands]
            if left == right and len(i) > 1:
                i = _apart(np.sort(i), following)
                j = following[i]
            if not len(i):
                continue
            token[i] = self.vocabulary.made[rank]
            token[j] = -1
            after = following[j]
            following[i] = after
            inside = after >= 0
            before[after[inside]] = i[inside]
            changed = np.concatenate([i, before[i]])
            changed.sort()
            fresh = changed >= 0
            fresh[1:] &= changed[1:] != changed[:-1]
            self._list(changed[fresh])

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces in one array, and the number of each piece's ids."""
        kept = self.token >= 0
        upto = np.concatenate([[0], np.cumsum(kept)])
        return self.token[kept].astype(np.uint32), np.diff(upto[self.bounds])


def _apart(at: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of positions whose pairs overlap, every other one from the left."""
    out, blocked = [], -1
    for i, j in zip(at.tolist(), following[at].tolist(), strict=True):
        if i != blocked:
            out.append(i)
            blocked = j
    return np.array(out, np.int64)


def encode_pieces(pieces: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of all pieces and how many each has, by one sweep over the ranks."""
    index = PairIndex(pieces, vocabulary)
    index.sweep()
    return index.result()


def _class_of_code_points(path: str) -> np.ndarray:
    """What the library takes each code point for: a letter, a number, a space or something else.

    Every code point is shown to the file's own splitter between a letter, a digit and a mark. Unicode
    versions differ in this, so no other module's classes will do.
    """
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    out = np.full(0x110000, _OTHER, np.uint8)
    for codes in _ASSIGNED:
        for at in range(codes.start, codes.stop, 1 << 14):
            part = range(at, min(at + (1 << 14), codes.stop))
            begins = np.zeros(5 * len(part) + 1, bool)
            begins[[start for _, (start, _) in split("".join(f"a{c}1{c}!" for c in map(chr, part)))]] = True
            with_letter, with_number, with_mark = (~begins[i:-1:5] for i in (1, 2, 4))
            out[part.start : part.stop] = np.select([with_letter, with_number, with_mark], [_LETTER, _NUMBER, _OTHER], _SPACE)
    out[ord(" ")] = _SPACE
    return out


def _ranges(codes: np.ndarray) -> str:
    """Code points as the inside of a character class."""
    if not len(codes):
        return ""
    cuts = np.flatnonzero(np.diff(codes) > 1)
    firsts, lasts = codes[np.concatenate([[0], cuts + 1])], codes[np.concatenate([cuts, [len(codes) - 1]])]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True))


def _pattern(letter: str, number: str, space: str):
    """The vocabulary's published splitting pattern with its classes spelt out."""
    other = f" ?[^{space}{letter}{number}]+"
    return regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+|{other}|[{space}]+(?![^{space}])|[{space}]+")


class Splitter:
    """Cuts texts into the pieces that the library encodes apart."""

    def __init__(self, path: str) -> None:
        classes = _class_of_code_points(path)
        self._classes = classes
        space = _ranges(np.flatnonzero(classes == _SPACE))
        self._known = _pattern(r"\p{L}", r"\p{N}", space)
        self._exact = None
        # texts with a character that this module or ``str.isalpha`` sees otherwise take the exact pattern
        every = "".join(chr(c) for codes in _ASSIGNED for c in codes)
        own = np.full(0x110000, _OTHER, np.uint8)
        alpha = np.zeros(0x110000, bool)
        own[[ord(c) for c in regex.findall(r"\p{L}", every)]] = _LETTER
        own[[ord(c) for c in regex.findall(r"\p{N}", every)]] = _NUMBER
        own[classes == _SPACE] = _SPACE
        alpha[[ord(c) for c in every if c.isalpha()]] = True
        differ = np.flatnonzero((own != classes) | (alpha != (classes == _LETTER)))
        self._disputed = re.compile(f"[{_ranges(differ)}]") if len(differ) else None

    def split(self, text: str) -> list[str]:
        if self._disputed is not None and not text.isascii() and self._disputed.search(text):
            if self._exact is None:
                letter, number, space = (_ranges(np.flatnonzero(self._classes == c)) for c in (_LETTER, _NUMBER, _SPACE))
                self._exact = _pattern(letter, number, space)
            return self._exact.findall(text)
        if text[0] == " " and text[1:].isalpha() or text.isalpha():
            return [text]
        if text[-1] in ".,":
            word = text[:-1]
            if word[:1] == " " and word[1:].isalpha() or word.isalpha():
                return [word, text[-1]]
        return self._known.findall(text)


def encode_parts(parts: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of some texts, all their different pieces encoded together, and how many each text has."""
    split, cuts, pieces = _Slots(), [], []
    for text in parts:
        part = [split[m] for m in vocabulary.splitter.split(text)] if text else []
        cuts.append(len(part))
        pieces += part
    flat, sizes = encode_pieces([p.encode() for p in split], vocabulary)
    order = np.array(pieces, np.int64)
    flat = _gather(flat, (np.cumsum(sizes) - sizes)[order], sizes[order])
    whole = np.concatenate([[0], np.cumsum(sizes[order])])[np.concatenate([[0], np.cumsum(cuts, dtype=np.int64)])]
    return flat, np.diff(whole)


class _Slots(dict):
    """Gives a new key the next number."""

    def __missing__(self, key: str) -> int:
        self[key] = slot = len(self)
        return slot


class Encoder:
    """Encodes whole texts; remembers the pieces between spaces."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.special)) + ")") if vocabulary.special else None
        self.reset()

    def reset(self) -> None:
        self.slots = _Slots()
        self.known = 0
        self.flat = np.empty(0, np.uint32)
        self.starts = np.empty(0, np.int64)
        self.sizes = np.empty(0, np.int64)

    def _keys(self, text: str) -> list[str]:
        """Keys of the parts that can be encoded apart.

        A part's key is what follows its leading space; the first part, which has none, is told
        apart by a space before it. No other key begins with white space.
        """
        parts = text.split(" ")
        if not _RUN.search(text):
            parts[0] = " " + parts[0]
            return parts
        joined = [" " + parts[0]]
        for p in parts[1:]:
            if not p or p[0].isspace():
                joined[-1] += " " + p
            else:
                joined.append(p)
        return joined

    def _learn(self) -> None:
        new = list(islice(self.slots, self.known, None))
        if not new:
            return
        flat, sizes = encode_parts([key[1:] if key[0] == " " else " " + key for key in new], self.vocabulary)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat])
        self.known = len(self.slots)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids start; null is empty."""
        if len(self.slots) > CACHE_PIECES:
            self.reset()
        slot = self.slots.__getitem__
        used: list[int] = []
        counts = np.zeros(len(texts) + 1, np.int64)
        for n, text in enumerate(texts, 1):
            if text:
                if any(s in text for s in self.vocabulary.special):
                    for part in self.special.split(text):
                        if part in self.vocabulary.special:
                            used.append(-1 - self.vocabulary.special[part])
                        elif part:
                            used += map(slot, self._keys(part))
                else:
                    used += map(slot, self._keys(text))
            counts[n] = len(used)
        self._learn()
        order = np.array(used, np.int64)
        fixed = np.flatnonzero(order < 0)
        flat, starts, sizes = self.flat, self.starts, self.sizes
        if len(fixed):
            flat = np.concatenate([flat, (-1 - order[fixed]).astype(np.uint32)])
            starts = np.concatenate([starts, len(self.flat) + np.arange(len(fixed))])
            sizes = np.concatenate([sizes, np.ones(len(fixed), np.int64)])
            order[fixed] = len(self.starts) + np.arange(len(fixed))
        ends = np.concatenate([[0], np.cumsum(sizes[order])])
        return _gather(flat, starts[order], sizes[order]), ends[counts]


def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(starts - ends + sizes, sizes)
    at += np.arange(total)
    return flat[at]


class Decoder:
    """Bytes and texts of token ids."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.flat = np.frombuffer(b"".join(vocabulary.bytes), np.uint8)
        self.sizes = np.array([len(b) for b in vocabulary.bytes], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The text of each row's ids; bytes that are not UTF-8 become replacement characters."""
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = ids[a:b]
            raw = _gather(self.flat, self.starts[own], self.sizes[own]).tobytes()
            out.append(raw.decode("utf-8", "replace"))
        return out


_LOADED: dict[str, tuple[Encoder, Decoder]] = {}


def loaded(path: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a worker, kept from one task to the next."""
    if path not in _LOADED:
        vocabulary = Vocabulary(path)
        _LOADED[path] = Encoder(vocabulary), Decoder(vocabulary)
    return _LOADED[path]


def _slices(batch: pa.RecordBatch, sizes: pa.Array) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, cut where the sizes of the rows reach another ``SLICE_BYTES``.

    A batch has a number of rows, whatever their texts' length; what a worker holds for its texts at
    once is many times the texts.
    """
    slot = np.cumsum(np.asarray(sizes.fill_null(0), np.int64)) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(slot)) + 1).tolist(), len(slot)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield batch.slice(a, b - a)


def _text_slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    return _slices(batch, pc.binary_length(batch.column(text)))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The documents with their token ids; null and empty texts have none. An older column ``ids`` is replaced."""
    docs = docs.drop(ids)

    def run(batches):
        encoder, _ = loaded(path)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for part in _text_slices(batch, at):
                flat, bounds = encoder.encode(part.column(at).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.view(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], names=[*part.schema.names, ids])

    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text of their ids; null counts as no ids. An older column ``text`` is replaced."""
    encoded = encoded.drop(text)

    def run(batches):
        _, decoder = loaded(path)
        for batch in batches:
            at = batch.schema.get_field_index(ids)
            for part in _slices(batch, batch.column(at).value_lengths()):
                lists = part.column(at)
                flat = np.asarray(lists.flatten(), np.int64)
                sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
                texts = decoder.decode(flat, np.concatenate([[0], np.cumsum(sizes)]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, text])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(text, T.StringType())]))


def round_trip(docs: DataFrame, path: str, id_column: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, hashes of the ids and of the decoded text, and the ids if asked for.

    Null and empty texts have no tokens and an empty decoded text; equal rows get equal results.
    """
    kinds = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    kinds += [("ids", T.ArrayType(T.IntegerType()))] * with_ids

    def run(batches):
        encoder, decoder = loaded(path)
        for batch in batches:
            for part in _text_slices(batch, 1):
                flat, bounds = encoder.encode(part.column(1).to_pylist())
                raw = flat.astype("<u4", copy=False)
                cuts = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                columns = [
                    part.column(0),
                    pa.array(np.diff(bounds)),
                    pa.array([sha256(raw[a:b]).hexdigest() for a, b in cuts]),
                    pa.array([sha256(t.encode()).hexdigest() for t in decoder.decode(flat, bounds)]),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat.view(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *(n for n, _ in kinds)])

    rows = docs.select(docs[id_column].alias("doc_id"), docs[text].alias("text"))
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(n, k) for n, k in kinds)])
    return rows.mapInArrow(run, schema)
