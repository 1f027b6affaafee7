"""Keys of landed rows in hash buckets, beside the raw tables and kept up by landing.

One index per entity with a key: ``index.{entity}``, partitioned by extract date, so that a corrected
extract replaces its keys, and by bucket. Blocks of neighbouring ids are hashed, not single ids: ids
are mostly given in ascending order, so the ids of a day lie in few buckets, and a lookup opens those
of all extracts and no others. Ids without any order lie in all buckets; a lookup then reads the
index whole, which is the key and a few more columns. Rows without a key are not in the index.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.schemas import ENTITIES, Entity
from callscope.sources.tables import Tables

# Stay as they are for the life of a warehouse: they say where a key is.
BUCKETS = 1024
BLOCK_BITS = 24
# Entries sorted and written by each task.
ENTRIES_PER_TASK = 500_000

KEY, BUCKET, EXTRACT_DATE = "key", "bucket", "extract_date"


def bucket_of(key: Column) -> Column:
    """Bucket of a key, number or text. Numbers that are equal as bigint share a bucket."""
    block = F.shiftright(key.try_cast("bigint"), BLOCK_BITS)
    return F.pmod(F.xxhash64(F.coalesce(block, F.xxhash64(key))), F.lit(BUCKETS)).cast("int")


def _entries(raw: DataFrame, entity: Entity) -> DataFrame:
    rows = raw.filter(F.col(entity.key).isNotNull())
    return rows.select(F.col(entity.key).alias(KEY), *entity.indexed, EXTRACT_DATE).withColumn(
        BUCKET, bucket_of(F.col(KEY))
    )


def _dealt(entries: DataFrame, rows: int) -> DataFrame:
    """Entries dealt to tasks by ranges of extract, bucket and key, each task the same number of them.

    Not by bytes, as a rebalance does: neighbouring ids compress so well that one task would get, and
    sort, tens of millions. Nor by hash: a few slices of ids are dealt unevenly. A folder is written by
    the few tasks whose ranges meet in it.
    """
    number = F.coalesce(F.col(KEY).try_cast("bigint"), F.xxhash64(KEY))
    return entries.repartitionByRange(max(1, -(-rows // ENTRIES_PER_TASK)), EXTRACT_DATE, BUCKET, number)


def update(tables: Tables, table: str, days: Collection[str] | None = None) -> None:
    """Index the extracts of ``days`` as they are in raw now; all of them if there is no index yet."""
    entity = ENTITIES[table]
    if entity.key is None:
        return
    raw = tables.read("raw", table)
    by = [EXTRACT_DATE, BUCKET]
    if days is None or not tables.exists("index", table):
        tables.overwrite(_dealt(_entries(raw, entity), raw.count()), "index", table, by, rebalance=False)
        return
    raw = raw.filter(F.col(EXTRACT_DATE).isin(sorted(days)))
    tables.replace_partitions(
        _dealt(_entries(raw, entity), raw.count()),
        "index",
        table,
        by,
        in_scope=lambda p: p[EXTRACT_DATE] in days,
        first=days,
        rebalance=False,
    )


def ensure(tables: Tables, table: str) -> None:
    """Index what was landed before there were indexes."""
    if not tables.exists("index", table) and tables.exists("raw", table):
        update(tables, table)


def of_extracts(tables: Tables, table: str, days: Collection[str]) -> DataFrame:
    """Entries of these extracts."""
    return tables.read("index", table).filter(F.col(EXTRACT_DATE).isin(sorted(days)))


def buckets_of_extracts(tables: Tables, table: str, days: Collection[str]) -> set[int]:
    """Buckets in which these extracts have keys, from folder names."""
    return buckets_of(tables.partitions("index", table, days))


def buckets_of(partitions: list[dict[str, str | None]]) -> set[int]:
    # A folder whose buckets are all gone has none.
    return {int(p[BUCKET]) for p in partitions if p.get(BUCKET) is not None}


def in_buckets(rows: DataFrame, buckets: Collection[int]) -> DataFrame:
    """Rows of a table partitioned by bucket; no file of another bucket is read."""
    return rows.filter(F.col(BUCKET).isin(sorted(buckets)))


def sharing_keys(tables: Tables, table: str, days: Collection[str]) -> DataFrame:
    """Entries, of whatever extract, whose key is also in an extract of ``days``."""
    buckets = buckets_of_extracts(tables, table, days)
    keys = of_extracts(tables, table, days).select(BUCKET, KEY).distinct()
    return in_buckets(tables.read("index", table), buckets).join(keys, [BUCKET, KEY], "left_semi")
