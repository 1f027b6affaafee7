"""The test tables as delivered CSV files, for the queries about ingestion and the daily job."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callscope import fixtures as fx
from callscope.schemas import AGENT_MAPPING, CALLS, DISPOSITIONS, PAYMENTS

TABLES = {
    CALLS: fx.calls,
    DISPOSITIONS: fx.dispositions,
    PAYMENTS: fx.payments,
    AGENT_MAPPING: fx.agent_mapping,
}


def write_csv(df: DataFrame, raw_dir: str, day: date, entity: str) -> None:
    """Write the extract ``{raw_dir}/{day}/{entity}.csv`` as part files."""
    text = df.select([F.col(c).cast("string").alias(c) for c in df.columns])
    text.write.mode("overwrite").csv(
        f"{raw_dir}/{day}/{entity}.csv",
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def deliver(
    spark: SparkSession,
    sf_dir: str,
    raw_dir: str,
    day: date,
    parts: dict[str, str],
    reorder: bool = False,
) -> None:
    """One day's folder: of each table the rows that satisfy its SQL condition."""
    for entity, condition in parts.items():
        df = TABLES[entity](spark, sf_dir).filter(condition)
        if reorder:
            df = df.select(*reversed(df.columns), F.lit("x").alias("added_later"))
        write_csv(df, raw_dir, day, entity)


def payload(rates: Iterable[tuple[str, float]]) -> str:
    body = ", ".join(f'"{c}": {r}' for c, r in rates)
    return f'{{"result": "success", "conversion_rates": {{{body}}}}}'


def midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)
