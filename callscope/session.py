"""Session settings for local runs, and the folder shared by all executors."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the submitter's settings apply."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("callscope")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_settings(shuffled_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a large run, given the size of its largest shuffle and the executor cores.

    Shuffle partitions of about 200 MB sort in memory; there are at least two per core. Adaptive
    execution joins the small ones and cuts skewed ones.
    """
    partitions = max(2 * cores, math.ceil(shuffled_bytes / (200 * 1024**2)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
    }


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of the machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = os.path.join(tempfile.gettempdir(), "callscope")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
