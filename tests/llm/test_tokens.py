"""Encoders and counters against the libraries, and round trips through the files."""

import itertools
import hashlib
import os
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from callscope.llm import bpe, token_counts, token_files  # noqa: E402
from callscope.llm.vocabularies import vocabulary_file  # noqa: E402
from callscope.llm.wavelet import WaveletMatrix  # noqa: E402
from callscope.llm.work import Scratch  # noqa: E402

PARTS = ["a", "B", "the", "ß", " ", "  ", "\n", "\t", "日本", "😀", "\x00", "<|endoftext|>", "<s>", "▁", "é", "É", "ﬁ", "é", "́"]
PARTS += [".", ",", "Word", "\x1c", "　", "İ", "ΣΑΣ", "'s", "don't", "12", "½", "\x85", "​", "ǅ", "<0x0A>", "\r\n", "aaaaaaaaa", "   "]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    return ["", None, " ", "  ", "a ", " a"] + ["".join(rng.choices(PARTS, k=rng.randint(1, 20))) for _ in range(3000)]


@pytest.fixture(scope="module")
def byte_level():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_file("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def word_level():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_file("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=vocabulary_file("piece_bpe_32k.model"))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_bpe_ids_and_text(texts, byte_level):
    encoder, decoder = bpe.loaded(vocabulary_file("byte_bpe_50k.json"))
    flat, bounds = encoder.encode(texts)
    own = [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert own == [ids_of(byte_level, t) for t in texts]
    assert decoder.decode(flat, bounds) == [byte_level.decode(i, skip_special_tokens=False) for i in own]
    broken = np.array([encoder.vocabulary.bytes.index(b"\xc3")])
    assert decoder.decode(broken, np.array([0, 1])) == [byte_level.decode([int(broken[0])])]


def test_bpe_forgets_and_goes_on(texts, byte_level, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10)
    encoder = bpe.Encoder(bpe.Vocabulary(vocabulary_file("byte_bpe_50k.json")))
    for part in (texts[:50], texts[50:90], texts[90:200]):
        flat, bounds = encoder.encode(part)
        assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [ids_of(byte_level, t) for t in part]


def test_bpe_slices(monkeypatch):
    monkeypatch.setattr(bpe, "SLICE_BYTES", 8)
    texts = ["abc", None, "", "\u00e9" * 10, "abcd", "abcd", "x" * 9]
    batch = pa.record_batch({"doc_id": list(range(7)), "text": texts})
    parts = list(bpe._text_slices(batch, 1))
    assert pa.Table.from_batches(parts).to_pydict() == batch.to_pydict()
    assert [p.num_rows for p in parts] == [3, 1, 2, 1]
    assert [p.num_rows for p in bpe._text_slices(batch.slice(0, 0), 1)] == [0]


def test_bpe_memory_of_a_batch(monkeypatch):
    """What a worker holds goes by the slices of a batch, not by the batch."""
    monkeypatch.setattr(bpe, "SLICE_BYTES", 250_000)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 10_000)
    vocabulary = bpe.Vocabulary(vocabulary_file("byte_bpe_50k.json"))
    batch = pa.record_batch({"text": [" ".join(f"w{i * 7919 + j}" for j in range(800)) for i in range(250)]})

    def peak(parts):
        encoder = bpe.Encoder(vocabulary)
        tracemalloc.start()
        for part in parts:
            encoder.encode(part.column(0).to_pylist())
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    assert 3 * peak(bpe._text_slices(batch, 0)) < peak([batch])


def test_bpe_rows(odd_docs, odd_rows, no_docs, byte_level, collected):
    path = vocabulary_file("byte_bpe_50k.json")
    wanted = []
    for d, t in odd_rows:
        ids = ids_of(byte_level, t)
        wanted.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    got = collected(bpe.round_trip(odd_docs, path), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == sorted(wanted, key=repr)
    assert bpe.round_trip(no_docs, path).count() == 0
    back = bpe.decode(bpe.encode(odd_docs, path), path)
    assert all(r.decoded == (r.text or "") for r in back.collect())
    assert set(back.columns) == {*odd_docs.columns, "decoded"}


def test_piece_counts(texts, pieces):
    got = token_counts.loaded(vocabulary_file("piece_bpe_32k.model")).count(pa.array(texts, pa.string()))
    assert got.tolist() == [len(pieces.encode(t)) if t else 0 for t in texts]


def test_counts_of_huge_texts(odd_docs, odd_rows, no_docs, make_docs, pieces):
    path = vocabulary_file("piece_bpe_32k.model")
    long = ["日本語" * 900, "ab" * 1500 + " " + "the " * 300, " " * 2500, "▁" * 2000, "é😀" * 1200]
    rows = odd_rows + [(10**9 + i, t) for i, t in enumerate(long)]
    out = token_counts.count_tokens(make_docs(rows), path, huge=400, chunk=200, overlap=40, limit=100)
    wanted = sorted((repr(d), len((t or "").encode()), n := len(pieces.encode(t)) if t else 0, n > 100) for d, t in rows)
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()) == wanted
    assert token_counts.count_tokens(no_docs, path).count() == 0


def test_no_piece_crosses_a_stable_place(pieces):
    counter = token_counts.loaded(vocabulary_file("piece_bpe_32k.model"))
    text = "interesting wording of unusual sentences"
    for at in range(1, len(text)):
        if counter.stable(text, at):
            assert len(pieces.encode(text)) == (counter.boundaries(text) < at).sum() + (counter.boundaries(text) >= at).sum()
            assert at in counter.boundaries(text)


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    for n, bits in ((0, 16), (1, 3), (511, 7), (5000, 16), (3000, 18)):
        ids = rng.integers(0, min(1 << bits, 300), n)
        matrix = WaveletMatrix.from_bytes(WaveletMatrix.build(ids, bits).to_bytes())
        assert matrix.all().tolist() == ids.tolist()
        for at in range(0, n, 97):
            assert matrix.access(at) == ids[at]
        for token in {*ids[:5].tolist(), 299}:
            places = np.flatnonzero(ids == token)
            assert matrix.count(token) == len(places) and matrix.locate(token) == places.tolist()
            assert matrix.count(token, n // 3, n // 2) == ((places >= n // 3) & (places < n // 2)).sum()
            assert matrix.rank(token, n) == len(places)
    with pytest.raises(ValueError):
        WaveletMatrix.from_bytes(b"xxxx" + bytes(20))
    with pytest.raises(IndexError):
        matrix.select(1 << 17, 0)


def test_word_ids(texts, word_level):
    flat, bounds = token_files.loaded(vocabulary_file("word_bpe_49k.json")).encode(pa.array(texts, pa.string()))
    assert [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [ids_of(word_level, t) for t in texts]


def test_token_files(spark, odd_docs, odd_rows, no_docs, word_level):
    path = vocabulary_file("word_bpe_49k.json")
    files = token_files.write_token_files(odd_docs, path, Scratch(spark, "test"), shard_tokens=300)
    assert files.count() > 4
    rows = sorted(((d is not None, d or 0, [*ids_of(word_level, t), 1]) for d, t in odd_rows), key=lambda r: (r[0], r[1], np.array(r[2], "<u4").tobytes()))
    start, wanted = 0, []
    for known, d, ids in rows:
        wanted.append((d if known else None, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted((tuple(r) for r in token_files.read_digest(files).collect()), key=lambda r: r[1])
    assert got == wanted
    none = token_files.write_token_files(no_docs, path, Scratch(spark, "test"))
    assert token_files.read_digest(none).count() == 0


def test_hash_index_grows():
    from callscope.llm.hash_index import HashIndex

    index, keys = HashIndex(), np.random.default_rng(4).integers(0, 2**63, 200_000).astype(np.uint64)
    keys = np.unique(np.concatenate([keys, np.arange(5, dtype=np.uint64)]))[1:]
    for part in np.array_split(keys, 7):
        index.insert(part, (part & np.uint64(0xFFFF)).astype(np.int32))
    assert (index.lookup(keys) == (keys & np.uint64(0xFFFF)).astype(np.int32)).all()
    assert (index.lookup(keys + np.uint64(1 << 63)) == -1).all()


def test_every_code_point_is_split_as_the_library_does():
    """Unicode versions of modules differ; only the library's classes count."""
    from tokenizers import Tokenizer

    from callscope.llm.bpe import Encoder, Vocabulary

    path = vocabulary_file("byte_bpe_50k.json")
    library, encoder = Tokenizer.from_file(path), Encoder(Vocabulary(path))
    codes = [c for c in [*range(0x34000), *range(0xE0000, 0xE1000), 0xF0000, 0x10FFFF] if not 0xD800 <= c < 0xE000]
    for shape in ("{}'s", "{}1", " {}", "a{}b"):
        texts = [shape.format(chr(c)) for c in codes]
        ids, bounds = encoder.encode(texts)
        wanted = library.encode_batch(texts, add_special_tokens=False)
        assert ids.tolist() == [i for e in wanted for i in e.ids]
        assert bounds[1:].tolist() == list(itertools.accumulate(len(e.ids) for e in wanted))
