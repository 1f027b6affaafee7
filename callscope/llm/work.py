"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from callscope.session import shared_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Each write drops its shuffle files when it ends; the written table takes their place."""
    old = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, old)


class Scratch:
    """Tables of one run of an operator. A table survives lost executors and cuts the lineage."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = shared_folder(spark, name)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        with _shuffles_freed(self.spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions_for(spark: SparkSession, at_least: int = 1) -> int:
    """As many partitions as the session gives to a shuffle."""
    return max(at_least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def free_prefix(columns: list[str]) -> str:
    """Underscores with which none of the columns starts."""
    prefix = "_"
    while any(c.startswith(prefix) for c in columns):
        prefix += "_"
    return prefix
