"""Continuous form of the daily job: every file that arrives is landed once, then the marts follow.

The stream carries file paths only. Its checkpoint remembers which files were taken; each
micro-batch lands its files and rebuilds the dates they touch, however late these are. A payment
window of three days is thus never held as stream state, and a replayed batch writes the same
partitions again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from callscope.operators.skew import SPLIT_ROWS
from callscope.plans import daily
from callscope.schemas import ENTITIES
from callscope.sources.landing import Landed, land_files
from callscope.sources.tables import Tables

_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, raw_dir: str, max_files: int = 1000) -> DataFrame:
    """Stream of the paths of delivered files; contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(_FILE)
        .option("maxFilesPerTrigger", max_files)
        .load(f"{raw_dir.rstrip('/')}/*/*.csv")
        .select("path")
    )


def ingest_stream(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    checkpoint: str,
    max_files: int = 1000,
    on_landed: Callable[[Tables, list[Landed]], None] | None = None,
) -> StreamingQuery:
    """Land the files not yet taken, then stop. Started again it lands only later arrivals."""
    tables = Tables(spark, out_dir)

    def land(batch: DataFrame, _: int) -> None:
        # At most ``max_files`` paths.
        paths = [r["path"] for r in batch.collect()]
        daily.keep_ids(tables, paths)
        landed = land_files(spark, tables, raw_dir, paths)
        if on_landed:
            on_landed(tables, landed)

    return (
        arriving_files(spark, raw_dir, max_files)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def refresh_stream(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    checkpoint: str,
    clock: Callable[[], datetime],
    max_files: int = 1000,
    split_rows: int = SPLIT_ROWS,
) -> StreamingQuery:
    """Ingest, and rebuild the marts after each micro-batch. Rates must have been loaded before.

    Nothing is built until each entity has delivered once.
    """

    def rebuild(tables: Tables, landed: list[Landed]) -> None:
        if all(tables.exists("raw", name) for name in ENTITIES):
            as_of = clock()
            with tables.publishing():
                daily.build(spark, tables, landed, as_of, split_rows=split_rows)
            daily.finish(tables, as_of)

    return ingest_stream(spark, raw_dir, out_dir, checkpoint, max_files, rebuild)
