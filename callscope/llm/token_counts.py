"""Token counts under a sentencepiece vocabulary, with overlap resynchronisation for huge texts.

A place in a text is a stable boundary if no piece of the vocabulary matches the text across it:
every merge makes a piece of the vocabulary, so none crosses the place, and what stands on either
side is encoded alone. Between a word and a following space this holds for the whole vocabulary if
no piece has a space after another character, which is checked when it is loaded; so the tokens of
a text are those of its words, which workers remember.

Texts of more than ``HUGE`` characters are cut into chunks that overlap. Each chunk is encoded with
offsets, in any task, and says where in its overlaps it has token boundaries that are stable, with
the tokens before them. Neighbours are spliced at the first boundary that both have. A text with an
overlap without one is cut anew with overlaps twice as wide, until all its chunks align or one chunk
holds the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscope.llm.hash_index import HashIndex
from callscope.llm.words import Alphabet, words_of
from callscope.llm.work import Scratch, partitions_for

HUGE = 1 << 16
CHUNK = 1 << 15
OVERLAP = 256
#: Different words a worker remembers before it starts anew.
CACHE_WORDS = 3_000_000
_SPACE_MARK = "▁"
#: Only the space separates words here.
BY_SPACE = Alphabet(np.arange(256) == 0x20, np.arange(256, dtype=np.uint8))


class Counter:
    """Counts tokens of whole texts with one vocabulary."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        self.pieces = {p for i, p in enumerate(pieces) if not self.processor.is_control(i) and not self.processor.is_byte(i)}
        self.longest = max(map(len, self.pieces))
        self.by_word = not any(_SPACE_MARK in p.lstrip(_SPACE_MARK) for p in self.pieces)
        self.known = HashIndex()

    def count(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        if not self.by_word:
            return np.array([self._whole(t) for t in texts.to_pylist()], np.int64)
        if self.known.n > CACHE_WORDS:
            self.known = HashIndex()
        for words in words_of(texts, BY_SPACE):
            counts = self.known.lookup(words.hashes)
            new = np.flatnonzero(counts < 0)
            if len(new):
                hashes, first = np.unique(words.hashes[new], return_index=True)
                raw = words.data.tobytes()
                at = new[first]
                found = [raw[a:b].decode() for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)]
                sizes = np.array([len(x) for x in self.processor.encode(found, num_threads=1)], np.int32)
                self.known.insert(hashes, sizes)
                counts[new] = self.known.lookup(words.hashes[new])
            sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            own = sums[words.bounds[1:]] - sums[words.bounds[:-1]]
            n_bytes = np.bincount(words.row_of_word(), words.ends - words.starts, minlength=words.rows)
            for i in self._odd(texts, words, n_bytes):
                own[i] = self._whole(texts[words.first_row + i].as_py())
            out[words.first_row : words.first_row + words.rows] = own
        return out

    def _odd(self, texts: pa.Array, words, n_bytes: np.ndarray) -> np.ndarray:
        """Rows with other spaces than one between two words, or with the space mark itself."""
        import pyarrow.compute as pc

        part = texts.slice(words.first_row, words.rows)
        sizes = pc.binary_length(part).fill_null(0).to_numpy(zero_copy_only=False)
        n_words = np.diff(words.bounds)
        spaces = sizes - n_bytes
        marked = pc.match_substring(part, _SPACE_MARK).fill_null(False).to_numpy(zero_copy_only=False)
        return np.flatnonzero(((spaces + 1 != n_words) & (sizes > 0)) | marked)

    def _whole(self, text: str | None) -> int:
        return len(self.processor.encode(text)) if text else 0

    def boundaries(self, text: str) -> np.ndarray:
        """The character at which each token of a chunk begins; the bytes of one share their place."""
        proto = self.processor.encode(text, return_type="proto")
        begins = np.array([p.begin for p in proto.pieces], np.int64)
        first_bytes = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        return np.concatenate([[0], np.cumsum(first_bytes)])[begins]

    def stable(self, text: str, at: int) -> bool:
        """No piece matches the text across this place; the text reaches far enough on both sides."""
        shown = text[max(at - self.longest, 0) : at + self.longest].replace(" ", _SPACE_MARK)
        cut = min(at, self.longest)
        for start in range(max(cut - self.longest + 1, 0), cut):
            for end in range(cut + 1, min(start + self.longest, len(shown)) + 1):
                if shown[start:end] in self.pieces:
                    return False
        return True


_LOADED: dict[str, Counter] = {}


def loaded(path: str) -> Counter:
    if path not in _LOADED:
        _LOADED[path] = Counter(path)
    return _LOADED[path]


def _count(path: str):
    def run(batches):
        counter = loaded(path)
        for batch in batches:
            counts = pa.array(counter.count(batch.column(2)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], counts], names=["doc_id", "n_bytes", "n_tokens"])

    return run


_CHUNKS = "row long, i int, last boolean, left int, right int, text string"


def _cut(overlap: int, chunk: int):
    """Chunks of each text; ``left`` and ``right`` are the overlaps' sizes, 0 at the text's ends."""

    def run(batches):
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                step = max(chunk, 2 * overlap)
                n = max((len(text) - overlap) // step, 1)
                for i in range(n):
                    last = i == n - 1
                    part = text[i * step :] if last else text[i * step : (i + 1) * step + overlap]
                    columns = [[row], [i], [last], [overlap if i else 0], [0 if last else overlap], [part]]
                    yield pa.RecordBatch.from_pydict(
                        dict(zip([f.split()[0] for f in _CHUNKS.split(", ")], columns, strict=True)),
                        schema=pa.schema(
                            [("row", pa.int64()), ("i", pa.int32()), ("last", pa.bool_()), ("left", pa.int32()), ("right", pa.int32()), ("text", pa.string())]
                        ),
                    )

    return run


#: Places in the overlap, counted from the start of the following chunk, and the tokens before them.
_ENCODED = "row long, i int, last boolean, n long, left_at array<int>, left_n array<int>, right_at array<int>, right_n array<int>"


def _encode(path: str):
    def run(batches):
        counter = loaded(path)
        for batch in batches:
            rows = []
            for row, i, last, left, right, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                begins = counter.boundaries(text)
                sides = []
                for start, size in ((0, left), (len(text) - right, right)):
                    places = np.unique(begins[(begins >= start + counter.longest) & (begins <= start + size - counter.longest)])
                    places = [p for p in places.tolist() if counter.stable(text, p)] if size else []
                    sides.append([p - start for p in places])
                    sides.append([int((begins < p).sum()) for p in places])
                rows.append([row, i, last, len(begins), *sides])
            kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), *[pa.list_(pa.int32())] * 4]
            names = [f.split()[0] for f in _ENCODED.split(", ")]
            columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return run


def _spliced(encoded: DataFrame) -> DataFrame:
    """(row, n_tokens), null where an overlap has no common boundary."""
    order = Window.partitionBy("row").orderBy("i")
    common = F.array_intersect(F.lag("right_at").over(order), "left_at")
    with_cut = encoded.withColumn("cut", F.try_element_at(F.array_sort(common), F.lit(1)))
    with_next = with_cut.withColumn("next", F.lead("cut").over(order))

    def before(places: str, counts: str, cut: str):
        return F.try_element_at(counts, F.array_position(places, F.col(cut)).cast("int"))

    first = F.when(F.col("i") == 0, 0).otherwise(before("left_at", "left_n", "cut"))
    upto = F.when(F.col("last"), F.col("n")).otherwise(before("right_at", "right_n", "next"))
    each = with_next.select("row", (upto - first).alias("own"))
    whole = F.when(F.count("own") == F.count("*"), F.sum("own"))
    return each.groupBy("row").agg(whole.alias("n_tokens"))


def _count_huge(rows: DataFrame, path: str, scratch: Scratch, overlap: int, chunk: int) -> DataFrame:
    """Counts of long texts, all turns together."""
    done, turn, open_ = None, 0, rows
    parts = partitions_for(rows.sparkSession)
    while True:
        chunks = open_.mapInArrow(_cut(overlap, chunk), _CHUNKS).repartition(parts, "row", "i")
        counted = scratch.store(_spliced(chunks.mapInArrow(_encode(path), _ENCODED)), f"spliced-{turn}")
        aligned = counted.where("n_tokens IS NOT NULL")
        done = aligned if done is None else done.union(aligned)
        apart = counted.where("n_tokens IS NULL").select("row")
        if apart.isEmpty():
            return done
        open_ = rows.join(apart, "row", "left_semi").select("row", "text")
        turn, overlap = turn + 1, overlap * 2


def count_tokens(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text: str = "text",
    limit: int = 4096,
    huge: int = HUGE,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Per document: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    Null and empty texts have no bytes and no tokens. Equal rows each get their count. An empty
    table gives no rows.
    """
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"),
        F.col(text).alias("text"),
    )
    is_long = F.coalesce(F.length("text"), F.lit(0)) > huge
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("n_tokens", T.LongType())])
    short = rows.where(~is_long).mapInArrow(_count(path), schema)
    scratch = Scratch(docs.sparkSession, "token-counts")
    # written, so that a row keeps its number whatever reads it again
    long = scratch.store(rows.where(is_long).withColumn("row", F.monotonically_increasing_id()), "long")
    counts = _count_huge(long.select("row", "text"), path, scratch, overlap, chunk)
    counted = short.union(long.join(counts, "row").select("doc_id", "n_bytes", "n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
