"""Questions about hashes that groups of documents put to the owners of those hashes.

A group of documents asks once for each different hash it has, however often it has it, so a hash
that a third of all rows share costs its owner one entry per group. Questions and answers are
packed arrays: one row per group and owner that have something to say to each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text in one group of documents, roughly.
GROUP_BYTES = 24 << 20


def grouped(docs: DataFrame, id_column: str, text: str, groups: int, *others: str) -> DataFrame:
    """doc_id, text, the others and ``bucket``, the group of the document."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"), *others)
    return rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(groups)).cast("int"))


def groups_for(spark: SparkSession, docs: DataFrame, text: str, group_bytes: int = GROUP_BYTES) -> int:
    """So many groups that each holds ``group_bytes`` of text, and one per shuffle partition at least."""
    total = docs.agg(F.sum(F.octet_length(text)).alias("n")).first().n or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // group_bytes))


def unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys in ascending order, a place of each, and the number of each key."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    number = np.empty(len(keys), np.int64)
    number[order] = np.cumsum(new) - 1
    return ordered[new], order[new], number


def dealt(bucket: int, owners: int, keys: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """(owner, bucket, keys, columns...): each owner's part of the arrays, of ascending keys.

    Owners have ranges of hashes, so their parts follow each other.
    """
    owner = ((keys >> np.uint64(32)) * np.uint64(owners) >> np.uint64(32)).astype(np.int64)
    present, starts = np.unique(owner, return_index=True)
    bounds = np.concatenate([starts, [len(keys)]]).astype(np.int64)
    table = {
        "owner": pa.array(present, pa.int32()),
        "bucket": pa.array(np.full(len(present), bucket), pa.int32()),
        "keys": packed(keys, bounds, ascending=True),
    }
    return pa.table(table | {n: packed(c, bounds) for n, c in columns.items()})


def packed(values: np.ndarray, bounds: np.ndarray, ascending: bool = False) -> pa.Array:
    """One compressed binary per stretch of the array; steps instead of values where they ascend."""
    return pa.array([_pack(values[a:b], ascending) for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary())


def unpacked(column, kind, ascending: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All values of a packed column, and which row each is from."""
    parts = [unpack(x, kind, ascending) for x in column.to_pylist()]
    row = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return np.concatenate([np.empty(0, kind), *parts]), row


_CODEC = pa.Codec("zstd", compression_level=1)


def _pack(values: np.ndarray, ascending: bool) -> bytes:
    """The number of values, then the first bytes of all values, the second bytes, and so on."""
    n = len(values)
    if n == 0:
        return bytes(8)
    if ascending:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(n, -1).T)
    return n.to_bytes(8, "little") + _CODEC.compress(planes, asbytes=True)


def unpack(raw: bytes, kind, ascending: bool = False) -> np.ndarray:
    n, size = int.from_bytes(raw[:8], "little"), np.dtype(kind).itemsize
    if n == 0:
        return np.empty(0, kind)
    planes = np.frombuffer(_CODEC.decompress(raw[8:], decompressed_size=n * size, asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if ascending else values
