"""Exact dedup with an extendible-hash index on shared files.

The directory maps the leading bits of a text's hash to a bucket. A bucket with more than
``BUCKET_KEYS`` keys is split by its next bit, which doubles the directory where needed; only
counts by leading bits reach the driver, never keys. Map tasks first join the copies they see, so
that a group holding a third of all rows reaches its owner as a few rows. Owner tasks take ranges
of buckets, chain different texts that share a hash, and compare bytes. The index is a table in the
shared folder: bucket, key, place in the chain, text, the row that stays, and the group's size.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.work import Scratch, free_prefix, partitions_for

BUCKET_KEYS = 4096
#: Leading bits that the driver's directory may use: at most 2**16 counts reach it at once.
MAX_DEPTH = 16
#: Text that one map task holds to join copies before the shuffle.
COMBINE_BYTES = 32 << 20


def key_of(text):
    """A 64-bit key of a text; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def directory(keys: DataFrame, key: str, bucket_keys: int = BUCKET_KEYS, max_depth: int = MAX_DEPTH) -> list[tuple[int, int]]:
    """(leading bits, local depth) of each bucket.

    One count of distinct keys by ``max_depth`` leading bits; buckets then split while they are
    overfull. A bucket of one key cannot be split and stays; its owner chains or counts its copies.
    """
    leading = F.shiftrightunsigned(F.col(key), 64 - max_depth).alias("leading")
    counts = {
        r.leading: r.n
        for r in keys.groupBy(leading).agg(F.approx_count_distinct(key).alias("n")).collect()
    }
    buckets, open_ = [], [(0, 0, counts)]
    while open_:
        bits, depth, own = open_.pop()
        if sum(own.values()) <= bucket_keys or depth == max_depth:
            buckets.append((bits, depth))
            continue
        shift = max_depth - depth - 1
        for side in (0, 1):
            part = {k: n for k, n in own.items() if (k >> shift) & 1 == side}
            open_.append((bits * 2 + side, depth + 1, part))
    return sorted(buckets, key=lambda b: b[0] << (max_depth - b[1]))


def with_bucket(rows: DataFrame, key: str, buckets: list[tuple[int, int]]) -> DataFrame:
    """Rows with the ``bucket`` that the directory gives for their key.

    The directory has 2**depth slots, at most 2**MAX_DEPTH, so it is broadcast.
    """
    depth = max(d for _, d in buckets)
    if depth == 0:
        return rows.withColumn("bucket", F.lit(0))
    slots = [(i, n) for i, n in enumerate(n for n, (_, d) in enumerate(buckets) for _ in range(1 << (depth - d)))]
    table = rows.sparkSession.createDataFrame(slots, "slot long, bucket int")
    slot = F.shiftrightunsigned(F.col(key), 64 - depth)
    return rows.withColumn("slot", slot).join(F.broadcast(table), "slot").drop("slot")


_INDEX = "bucket int, key long, chain int, text string, keep_id long, n long, sha256 string"


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


def _combine(batches):
    """Copies that meet in a bounded store become one entry; the oldest entries leave first."""
    store: OrderedDict[tuple[int, str], list] = OrderedDict()
    held = 0

    def batch_of(entries):
        cols = list(zip(*entries, strict=True))
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = ("bucket", "key", "text", "keep_id", "n")
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    for batch in batches:
        out = []
        for bucket, key, text, doc in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            old = store.get((key, text))
            if old is not None:
                old[3], old[4] = _larger(old[3], doc), old[4] + 1
                store.move_to_end((key, text))
                continue
            store[key, text] = [bucket, key, text, doc, 1]
            held += len(text) + 200
            while held > COMBINE_BYTES:
                _, gone = store.popitem(last=False)
                held -= len(gone[2]) + 200
                out.append(gone)
        if out:
            yield batch_of(out)
    if store:
        yield batch_of(store.values())


def _own(batches):
    """Entries come in order of bucket and key; each key's chain holds its different texts."""
    bucket = key = None
    chain: dict[str, list] = {}

    def flush(rows):
        rows += [[bucket, key, i, text, doc, n] for i, (text, (doc, n)) in enumerate(chain.items())]

    for batch in batches:
        rows: list = []
        for b, k, text, doc, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (b, k) != (bucket, key):
                flush(rows)
                bucket, key, chain = b, k, {}
            entry = chain.get(text)
            if entry is None:
                chain[text] = [doc, n]
            else:
                entry[0], entry[1] = _larger(entry[0], doc), entry[1] + n
        if rows:
            yield _entries(rows)
    rows = []
    flush(rows)
    if rows:
        yield _entries(rows)


def _entries(rows: list) -> pa.RecordBatch:
    cols = [*zip(*rows, strict=True)]
    cols.append([hashlib.sha256(t.encode()).hexdigest() for t in cols[3]])
    kinds = (pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string())
    names = [f.split()[0] for f in _INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def build_index(docs: DataFrame, id_column: str = "doc_id", text: str = "text", scratch: Scratch | None = None) -> DataFrame:
    """The index as a table in the shared folder, one row per different text."""
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark, "exact-dedup")
    rows = docs.select(
        key_of(F.col(text)).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.col(id_column).cast("long").alias("doc"),
    )
    buckets = directory(rows, "key")
    parts = partitions_for(spark)
    entries = (
        with_bucket(rows, "key", buckets)
        .select("bucket", "key", "text", "doc")
        .mapInArrow(_combine, "bucket int, key long, text string, keep_id long, n long")
    )
    owned = (
        entries.repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "key")
        .mapInArrow(_own, _INDEX)
    )
    return scratch.store(owned, "index")


def dedup_groups(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, id of the row that stays, group size, kept, hash of the text.

    Equal texts form a group, of which the row with the largest id stays; null counts as empty.
    Rows with equal id and text are one group, and all rows with the largest id are marked kept.
    A null id never stays beside another; a group of nulls has a null keep_id and is kept. An empty
    table gives no rows. The texts' SHA-256 joins rows to the chain entry that the owner confirmed.
    """
    index = build_index(docs, id_column, text)
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.sha2(whole, 256).alias("text_sha256"),
        key_of(F.col(text)).alias("key"),
    )
    groups = index.select("key", F.col("sha256").alias("text_sha256"), "keep_id", F.col("n").alias("group_size"))
    out = rows.join(groups, ["key", "text_sha256"])
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with the columns they came with; one row per different text.

    Of rows that are equal in text and id one stays, whichever.
    """
    prefix = free_prefix(docs.columns)
    on = [prefix + n for n in ("key", "sha", "id", "no_id")]

    def keys(key, sha, doc):
        values = (key, sha, F.coalesce(doc, F.lit(0)), doc.isNull())
        return dict(zip(on, values, strict=True))

    index = build_index(docs, id_column, text)
    kept = index.select(*(c.alias(n) for n, c in keys(F.col("key"), F.col("sha256"), F.col("keep_id")).items()))
    sha = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    rows = docs.withColumns(keys(key_of(F.col(text)), sha, F.col(id_column).cast("long")))
    return rows.join(kept, on, "left_semi").dropDuplicates(on).select(*docs.columns)
