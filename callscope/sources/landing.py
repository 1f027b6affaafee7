"""CSV extracts -> raw tables.

An extract is ``{raw_dir}/{YYYY-MM-DD}/{entity}.csv``, one file or a folder of part files with the
same header. Columns are bound by header name, as extracts of different days may order them
differently or lack some. Raw keeps text as delivered plus lineage; it is partitioned by extract
date, so a corrected extract replaces what it replaced on disk, and by event date, so later stages
read only the days they need.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callscope.schemas import ENTITIES, Entity
from callscope.sources import key_index
from callscope.sources.key_index import EXTRACT_DATE
from callscope.sources.tables import Tables, list_files

EVENT_DATE = "event_date"
# Without pruning a malformed row fails whichever columns are used.
_CSV = {"quote": '"', "escape": '"', "mode": "FAILFAST", "header": True, "columnPruning": False}
# A file whose header differs from the one planned for its folder fails instead of being misread.
_STRICT = {**_CSV, "enforceSchema": False}


class MissingExtract(FileNotFoundError):
    """No file for an entity."""


@dataclass(frozen=True)
class Landed:
    """What a load did to one raw table."""

    table: str
    files: int
    rows: int
    event_dates: frozenset[date] = field(default_factory=frozenset)
    days: frozenset[str] = field(default_factory=frozenset)


def _entity_path(entity: Entity) -> str:
    """Pattern of a delivered file's folder and name."""
    return rf"([^/]+)/{re.escape(entity.file_name)}(?:/[^/]+)?$"


def folder_of(path: str, entity: Entity) -> str | None:
    """Name of the dated folder of a file, None if the file belongs to another entity."""
    match = re.search("/" + _entity_path(entity), path)
    return match[1] if match else None


def days_of(paths: Iterable[str], entity: Entity) -> set[str]:
    """The dated folders of an entity's files."""
    return {folder_of(p, entity) for p in paths} - {None}


def extract_files(
    spark: SparkSession, raw_dir: str, entity: Entity, days: Iterable[str] | None = None
) -> dict[str, int]:
    """Sizes of the entity's files in the given folders, by default in all; none is an error."""
    base = raw_dir.rstrip("/")
    below = "*" if days is None else "{" + ",".join(sorted(days)) + "}"
    pattern = f"{base}/{below}/{entity.file_name}"
    files = list_files(spark, pattern) | list_files(spark, f"{pattern}/[!._]*")
    if not files:
        raise MissingExtract(f"{entity.name} was not delivered: nothing at {pattern}")
    return files


def _by_header(
    spark: SparkSession, entity: Entity, files: Iterable[str]
) -> dict[tuple[str, ...], list[str]]:
    """Files by header. Reads one header line per extract; its parts share it."""
    extracts = defaultdict(list)
    for path in files:
        extracts[folder_of(path, entity)].append(path)

    def header(paths: list[str]) -> tuple[str, ...]:
        return tuple(spark.read.options(**_CSV, multiLine=entity.multi_line).csv(paths[0]).columns)

    by_header = defaultdict(list)
    with ThreadPoolExecutor(16) as pool:
        for columns, paths in zip(
            pool.map(header, extracts.values()), extracts.values(), strict=True
        ):
            by_header[columns] += paths
    return by_header


def _scan(spark: SparkSession, entity: Entity, header: tuple[str, ...], paths: list[str]) -> DataFrame:
    """Header columns as text plus ``_source_file``.

    Files of an entity without line ends in its values are read in splits, whatever their size.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    options = {**_STRICT, "multiLine": entity.multi_line}
    df = spark.read.schema(schema).options(**options).csv(paths)
    return df.select("*", F.col("_metadata.file_path").alias("_source_file"))


def read_extracts(spark: SparkSession, entity: Entity, files: dict[str, int]) -> DataFrame:
    """Declared columns of all files as text, with lineage, extract date and event date.

    One scan per distinct header. An empty field is null, quoted or not.
    """
    scans = []
    for header, paths in _by_header(spark, entity, files).items():
        present = {c.lower(): c for c in header}
        columns = [
            F.nullif(F.col(f"`{present[c]}`"), F.lit("")).alias(c)
            for c in entity.columns
            if c in present
        ]
        scans.append(_scan(spark, entity, header, paths).select(*columns, "_source_file"))
    raw = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    text = T.StringType()
    raw = raw.withColumns(
        {c: F.lit(None).cast(text) for c in entity.columns if c not in raw.columns}
    )
    event_date = (
        F.to_date(F.col(entity.event_time).try_cast("timestamp_ntz"))
        if entity.event_time
        else F.lit(None).cast("date")
    )
    # Relative to the parent of the landing folder. Cut at slashes: a pattern takes longer than reading the row.
    path = F.col("_source_file")
    below = F.when(path.endswith(f"/{entity.file_name}"), F.substring_index(path, "/", -3)).otherwise(
        F.substring_index(path, "/", -4)
    )
    return raw.withColumn("_source_file", below).select(
        *entity.columns,
        "_source_file",
        F.current_timestamp().alias("_loaded_at"),
        F.substring_index(F.substring_index("_source_file", "/", 2), "/", -1).alias(EXTRACT_DATE),
        event_date.alias(EVENT_DATE),
    )


def _event_dates(tables: Tables, entity: Entity, extract_dates: set[str] | None) -> set[date]:
    return {
        date.fromisoformat(p[EVENT_DATE])
        for p in tables.partitions("raw", entity.name, extract_dates)
        if p.get(EVENT_DATE)
    }


def land_all(spark: SparkSession, tables: Tables, raw_dir: str) -> list[Landed]:
    """Drop and rebuild every raw table from all files present."""
    found = {e: extract_files(spark, raw_dir, e) for e in ENTITIES.values()}
    report = []
    for entity, files in found.items():
        rows = tables.overwrite(
            read_extracts(spark, entity, files),
            "raw",
            entity.name,
            [EXTRACT_DATE, EVENT_DATE],
        )
        key_index.update(tables, entity.name)
        dates = _event_dates(tables, entity, None)
        days = frozenset(days_of(files, entity))
        report.append(Landed(entity.name, len(files), rows, frozenset(dates), days))
    return report


def land_files(
    spark: SparkSession, tables: Tables, raw_dir: str, paths: Iterable[str]
) -> list[Landed]:
    """Land the extracts that new, changed or removed files belong to.

    An extract replaces the rows landed for it before, so a replay does not add rows twice. One of
    which no file is left has no rows.
    """
    paths = list(paths)
    report = []
    for entity in ENTITIES.values():
        days = days_of(paths, entity)
        if not days:
            continue
        try:
            files = extract_files(spark, raw_dir, entity, days)
            arrived = read_extracts(spark, entity, files)
        except MissingExtract:
            if not tables.exists("raw", entity.name):
                raise
            files, arrived = {}, spark.createDataFrame([], tables.schema("raw", entity.name))
        before = _event_dates(tables, entity, days)
        rows = tables.replace_partitions(
            arrived,
            "raw",
            entity.name,
            [EXTRACT_DATE, EVENT_DATE],
            in_scope=lambda p, days=days: p[EXTRACT_DATE] in days,
            first=days,
        )
        key_index.update(tables, entity.name, days)
        after = _event_dates(tables, entity, days)
        touched = frozenset(before | after)
        report.append(Landed(entity.name, len(files), rows, touched, frozenset(days)))
    return report


def read_raw(tables: Tables, table: str) -> DataFrame:
    return tables.read("raw", table)
