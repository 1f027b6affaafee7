"""Which files are new, changed or removed, by content hash.

The manifest holds path, size, modification time and digest of every landed file. A file with the
size and time it had is taken as unchanged without being read, so a daily run reads the new and
rewritten files only; ``verify`` reads them all. A rewritten file whose content is the same is not
landed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callscope.sources.tables import Tables

MANIFEST = ("raw", "file_manifest")
SEEN = ("raw", "files_seen")
_STAT = ("path", "length", "modificationTime")


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Delivered files; as long as ``content`` is not selected they are only listed."""
    return spark.read.format("binaryFile").load(paths)


# A prime below 2^31, so that products fit in 64 bits, and two bases.
_PRIME = 2**31 - 1
_BASES = (1_000_003, 69_621_337)
# A power's exponent of 33 bits is looked up in three parts.
_PART = 11


def _power_tables(base: int) -> list[list[int]]:
    """Powers base^(i 2^(11 k)) of all i below 2^11, for each part k."""
    tables = []
    for _ in range(3):
        powers = [1]
        for _ in range((1 << _PART) - 1):
            powers.append(powers[-1] * base % _PRIME)
        tables.append(powers)
        base = powers[-1] * base % _PRIME
    return tables


def _power(base: int, exponent: Column) -> Column:
    """base^exponent modulo the prime, for exponents from 0 to 2^33 - 1."""
    out = None
    for k, powers in enumerate(_power_tables(base)):
        digit = F.shiftright(exponent, k * _PART).bitwiseAND(F.lit((1 << _PART) - 1)).cast("int")
        # text, as one literal: the optimizer makes an array of it once
        table = F.split(F.lit(",".join(map(str, powers))), ",").cast("array<bigint>")
        looked_up = table[digit]
        out = looked_up if out is None else out * looked_up % _PRIME
    return out


def _line_hash(i: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(i), "value"), F.lit(_PRIME))


def line_digests(lines: DataFrame) -> DataFrame:
    """(file, digest) of rows (file, start, place, value), read in splits that begin at ``start``.

    With h the hash of a line, a split has the polynomial sum of h_i B^i over its lines; behind n
    other lines it counts B^n times as much. So the sums of splits are merged without numbering the
    lines of a file: a task numbers its own, and what that shifts a split by is divided out. The
    digest depends on order and on every byte, carriage returns included, but not on where a file
    is split.
    """
    row = F.col("place").bitwiseAND(F.lit(2**33 - 1))
    sums = [F.sum(_line_hash(i) * _power(b, F.col("row")) % _PRIME).alias(f"sum{i}") for i, b in enumerate(_BASES)]
    splits = (
        lines.withColumn("row", row)
        .groupBy("file", "start")
        .agg(F.count("*").alias("n"), F.min("row").alias("first"), F.bit_xor(F.xxhash64("value")).alias("each"), *sums)
    )
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    # one row per split of a file
    placed = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    # exponents count modulo the prime less one, negative ones too
    shift = F.pmod(F.col("before") - F.col("first"), F.lit(_PRIME - 1))
    merged = [
        F.sum(F.pmod(f"sum{i}", F.lit(_PRIME)) * _power(b, shift) % _PRIME) % _PRIME for i, b in enumerate(_BASES)
    ]
    parts = [F.sum("n"), F.bit_xor("each"), *merged]
    return placed.groupBy("file").agg(F.md5(F.concat_ws("-", *[p.cast("string") for p in parts])).alias("digest"))


def _hashed(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, length, modificationTime, digest) of files of any size, read in splits.

    A file is its lines between line feeds. Lines are reduced to one row per split before anything
    is shuffled or joined.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    # Spark lists no files without a byte; one that was emptied counts as removed.
    listed = _files(spark, paths).select(*_STAT)
    same = _spelling("path") == _spelling("file")
    return listed.join(line_digests(lines), same).select(*_STAT, F.col("digest").alias("md5"))


def _spelling(path: str):
    """File listings and file metadata differ in slashes and escapes."""
    return F.regexp_replace(F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B"))), r"^(\w+):/+", "$1:/")


def file_hashes(
    spark: SparkSession, raw_dir: str, known: DataFrame | None = None, verify: bool = False
) -> DataFrame:
    """The manifest of all files present, taking over what is known of files not written since."""
    everything = f"{raw_dir.rstrip('/')}/*/*.csv"
    if known is None or verify:
        return _hashed(spark, everything)
    present = _files(spark, everything).select(*_STAT)
    # Paths of the files written since the last run.
    written = [r["path"] for r in present.join(known, list(_STAT), "left_anti").collect()]
    kept = known.join(present, list(_STAT), "left_semi").select(*_STAT, "md5")
    return kept.unionByName(_hashed(spark, written)) if written else kept


def changed_files(hashes: DataFrame, known: DataFrame | None) -> DataFrame:
    """Files whose content the manifest does not have under that path."""
    return hashes if known is None else hashes.join(known, ["path", "md5"], "left_anti")


def removed_files(hashes: DataFrame, known: DataFrame | None) -> DataFrame:
    """Files of the manifest that are no longer there."""
    return hashes.limit(0) if known is None else known.join(hashes, "path", "left_anti")


def known_files(tables: Tables) -> DataFrame | None:
    return tables.read(*MANIFEST) if tables.exists(*MANIFEST) else None


def remember(tables: Tables, hashes: DataFrame) -> None:
    """Store the manifest, after the files have been landed."""
    tables.overwrite(hashes, *MANIFEST)
