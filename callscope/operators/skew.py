"""Heavy keys: count them, and spread them over many tasks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task may hold; a key above it is split.
SPLIT_ROWS = 2_000_000


def heavy_keys(df: DataFrame, key: Column, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """(key, n) of the keys with more than ``split_rows`` rows; null counts as no key.

    Reads the key column only and counts map-side first. There are at most rows / split_rows such
    keys, none is left out, and nothing runs before the result is used.
    """
    counts = df.select(key.alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    return counts.filter((F.col("n") > split_rows) & F.col("key").isNotNull())


@dataclass(frozen=True)
class Load:
    """Rows with a key, and rows of the most frequent key."""

    rows: int
    most: int


def load_of_keys(df: DataFrame, key: Column) -> Load:
    """Counts the rows of each key, map-side first, and brings two numbers to the driver."""
    counts = df.select(key.alias("key")).filter("key is not null").groupBy("key").agg(F.count("*").alias("n"))
    found = counts.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    return Load(found["rows"] or 0, found["most"] or 0)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: str,
    how: str = "left",
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Equi join for a left side whose keys are missing or very frequent. Left keys are at least 0.

    A row without a key matches nothing; it gets a negative key from the hash of ``spread_by``, so
    that such rows do not meet in one task. ``right`` holds at most one row per key. Keys are counted
    first; if one has more than ``split_rows`` rows, heavy keys are cut into parts of about
    ``split_rows`` rows, and the one right row of each is repeated once per part. Keeps the columns
    of both sides for ``how="left"``, of the left side for ``how="left_anti"``.
    """
    no_key = -1 - F.pmod(F.xxhash64(spread_by), F.lit(2**62))
    keyed = left.withColumn("_key", F.coalesce(left_key, no_key))
    right = right.filter(F.col(right_key) >= 0)
    if load_of_keys(left, F.col(left_key)).most <= split_rows:
        return keyed.join(right, F.col("_key") == F.col(right_key), how).drop("_key")
    heavy = heavy_keys(left, F.col(left_key), split_rows)
    parts = heavy.select(F.col("key").alias("_heavy_key"), F.ceil(F.col("n") / split_rows).alias("_parts"))
    one = F.coalesce("_parts", F.lit(1))
    left = keyed.join(parts, F.col("_key") == F.col("_heavy_key"), "left").withColumn(
        "_part", F.pmod(F.xxhash64(spread_by), one)
    )
    copies = F.sequence(F.lit(0).cast("bigint"), one - 1)
    right = (
        right.join(parts, F.col(right_key) == F.col("_heavy_key"), "left")
        .withColumn("_copy", F.explode(copies))
        .drop("_heavy_key", "_parts")
    )
    same = (F.col("_key") == F.col(right_key)) & (F.col("_part") == F.col("_copy"))
    return left.join(right, same, how).drop("_key", "_part", "_copy", "_heavy_key", "_parts")
