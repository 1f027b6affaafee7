"""Token ids of a corpus in binary files, each shard a wavelet matrix.

Documents are encoded, then dealt by ranges of their id and sorted. Each task cuts its range into
shards of about ``SHARD_TOKENS`` tokens, whole documents each, and writes them to its file in the
shared folder: shard number, document ids and lengths, and the compressed wavelet matrix, which
answers access, rank, count and occurrence queries for the shard without the others.
"""

from __future__ import annotations

import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callscope.llm.bpe import _gather
from callscope.llm.hash_index import HashIndex
from callscope.llm.wavelet import WaveletMatrix
from callscope.llm.words import SPACED, words_of
from callscope.llm.work import Scratch, partitions_for

SHARD_TOKENS = 1 << 20
#: Different words a worker remembers before it starts anew.
CACHE_WORDS = 3_000_000
#: Words given to the tokenizer as one text.
_TOGETHER = 50


class WordEncoder:
    """Ids of whole texts from the tokenizers library, which sees every different word once.

    The vocabulary drops white space and never joins what it separates, so the ids of a text are
    those of its words.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        # for lower-case words in composed form the normaliser changes nothing and letters stay together
        self.plain = Tokenizer.from_file(path)
        self.plain.no_truncation()
        self.plain.no_padding()
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.size = self.whole.get_vocab_size()
        self.ends_word = np.zeros(self.size, bool)
        for token, i in self.whole.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self._reset()

    @property
    def bits(self) -> int:
        return max(int(self.size - 1).bit_length(), 1)

    def _reset(self) -> None:
        self.known = HashIndex()
        self.flat = np.empty(0, np.uint32)
        self.starts = self.sizes = np.empty(0, np.int64)

    def _plain_words(self, words: list[str]) -> list[list[int]]:
        texts = [" ".join(words[i : i + _TOGETHER]) for i in range(0, len(words), _TOGETHER)]
        ids = [e.ids for e in self.plain.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.array([i for x in ids for i in x], np.int64)
        cuts = np.flatnonzero(self.ends_word[flat]) + 1 if len(flat) else np.empty(0, np.int64)
        if len(cuts) != len(words):
            raise ValueError("a word without an end")
        return [x.tolist() for x in np.split(flat, cuts[:-1])] if words else []

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        plain: dict[str, list[int]] = {}
        parts = []
        for word in words:
            body, tail = (word[:-1], word[-1]) if word[-1] in ".," else (word, "")
            lower = body.lower()
            if lower.isalpha() and len(lower) == len(body) and unicodedata.is_normalized("NFC", lower) and "İ" not in body and "Σ" not in body:
                plain[lower] = []
                parts.append((lower, tail))
            else:
                parts.append((None, word))
        plain = dict(zip(plain, self._plain_words(list(plain)), strict=True))
        others = [w for lower, w in parts if lower is None]
        marks = {m: self.whole.encode(m, add_special_tokens=False).ids for m in ".,"} | {"": []}
        rest = iter([e.ids for e in self.whole.encode_batch_fast(others, add_special_tokens=False)])
        ids = [plain[lower] + marks[tail] if lower is not None else next(rest) for lower, tail in parts]
        sizes = np.array([len(x) for x in ids], np.int64)
        self.known.insert(hashes, len(self.sizes) + np.arange(len(hashes), dtype=np.int32))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.array([i for x in ids for i in x], np.uint32)])

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text's ids start; null is empty."""
        if self.known.n > CACHE_WORDS:
            self._reset()
        out, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for words in words_of(texts, SPACED):
            slots = self.known.lookup(words.hashes)
            new = np.flatnonzero(slots < 0)
            if len(new):
                hashes, first = np.unique(words.hashes[new], return_index=True)
                raw, at = words.data.tobytes(), new[first]
                cuts = zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)
                self._learn(hashes, [raw[a:b].decode() for a, b in cuts])
                slots[new] = self.known.lookup(words.hashes[new])
            sizes = self.sizes[slots]
            out.append(_gather(self.flat, self.starts[slots], sizes))
            counts.append(np.diff(np.concatenate([[0], np.cumsum(sizes)])[words.bounds]))
        return np.concatenate(out), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


_LOADED: dict[str, WordEncoder] = {}


def loaded(path: str) -> WordEncoder:
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


def _encode(path: str, end: int, bounds: np.ndarray):
    def run(batches):
        encoder = loaded(path)
        for batch in batches:
            flat, cuts = encoder.encode(batch.column(1))
            n = len(cuts) - 1
            ids = np.insert(flat, cuts[1:], end) if n else flat
            cuts = (cuts + np.arange(n + 1)) * 4
            binary = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(ids.astype("<u4"))])
            docs = batch.column(0)
            known = docs.is_valid().to_numpy(zero_copy_only=False)
            part = np.searchsorted(bounds, docs.fill_null(0).to_numpy(zero_copy_only=False), side="right") + 1
            part = np.where(known, part, 0).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), docs, binary.cast(pa.binary())], names=["part", "doc_id", "ids"])

    return run


_FILE = "part int, seq int, n_tokens long, doc_ids array<long>, sizes array<long>, matrix binary"


def _shards(bits: int, tokens: int):
    def shard(part, seq, docs, ids):
        whole = np.concatenate([np.frombuffer(x, "<u4") for x in ids])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], pa.int32()),
                pa.array([seq], pa.int32()),
                pa.array([len(whole)], pa.int64()),
                pa.array([docs], pa.list_(pa.int64())),
                pa.array([[len(x) // 4 for x in ids]], pa.list_(pa.int64())),
                pa.array([WaveletMatrix.build(whole, bits).to_bytes()], pa.binary()),
            ],
            names=[f.split()[0] for f in _FILE.split(", ")],
        )

    def run(batches):
        now, seq, size, docs, ids = None, 0, 0, [], []
        for batch in batches:
            for part, doc, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if docs and (part != now or size + len(own) // 4 > tokens):
                    yield shard(now, seq, docs, ids)
                    seq, size, docs, ids = seq + 1, 0, [], []
                if part != now:
                    now, seq = part, 0
                docs.append(doc)
                ids.append(own)
                size += len(own) // 4
        if docs:
            yield shard(now, seq, docs, ids)

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    scratch: Scratch,
    end: int = 1,
    id_column: str = "doc_id",
    text: str = "text",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Token files of the documents in ascending order of their id, each followed by the end id.

    Null and empty texts have the end id only. Rows without an id come first; rows with equal ids
    come in the order of their tokens. The table has one row per shard.
    """
    parts = partitions_for(docs.sparkSession)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    cuts = [i / parts for i in range(1, parts)]
    found = rows.agg(F.percentile_approx("doc_id", cuts, 100 * parts)).first()[0] if cuts else []
    bounds = np.array(found or [], np.int64)
    encoded = rows.mapInArrow(_encode(path, end, bounds), "part int, doc_id long, ids binary")
    ordered = encoded.repartition(parts, "part").sortWithinPartitions("part", "doc_id", "ids")
    return scratch.store(ordered.mapInArrow(_shards(loaded(path).bits, shard_tokens), _FILE), "tokens")


def _read(batches):
    for batch in batches:
        for part, seq, docs, sizes, raw in zip(*(batch.column(n).to_pylist() for n in ("part", "seq", "doc_ids", "sizes", "matrix")), strict=True):
            ids = WaveletMatrix.from_bytes(raw).all().astype("<u4")
            cuts = np.concatenate([[0], np.cumsum(sizes)])
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            n = len(docs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * n, pa.int32()),
                    pa.array([seq] * n, pa.int32()),
                    pa.array(cuts[:-1], pa.int64()),
                    pa.array(docs, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["part", "seq", "offset", "doc_id", "n_tokens", "ids_crc32"],
            )


def read_digest(files: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    by_part = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    # one row per range of ids, as many as shuffle partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    first = files.select("part", "seq", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("first"))
    shards = first.join(base, "part").select("part", "seq", (F.col("base") + F.col("first")).alias("before"))
    rows = files.select("part", "seq", "doc_ids", "sizes", "matrix").mapInArrow(
        _read, "part int, seq int, offset long, doc_id long, n_tokens long, ids_crc32 long"
    )
    return rows.join(shards, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )
