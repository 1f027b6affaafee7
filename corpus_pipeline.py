"""Corpus pipeline: rate, drop copies, drop near copies, decontaminate, tokenise.

Every stage takes (spark, docs, sf_dir); its result is written and read back as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from callscope.llm import bpe, decontamination, exact_dedup, near_dedup, quality
from callscope.llm.vocabularies import vocabulary_file
from callscope.llm.work import Scratch, free_prefix


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which the classifier says that they are good rather than poor or toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, quality.graded(labels))
    prefix = free_prefix(docs.columns)
    scored = quality.score(docs, model, selected=2, prefix=prefix)
    return scored.where(scored[prefix + "selected"]).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each different text."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return near_dedup.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with their number and the hash of what they decode to."""
    return bpe.round_trip(docs, vocabulary_file("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", tokenise),
]

#: The classifier is beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    last = len(STAGES) - 1
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.store(stage(spark, docs, sf_dir), name) if i < last else stage(spark, docs, sf_dir)
    return docs
