"""Data checks: each is a DataFrame of violations, empty if the check passes."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(ValueError):
    """One or more checks found violations."""


@dataclass(frozen=True)
class Check:
    name: str
    violations: DataFrame


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys on more than one row, with their number of rows; nulls are not keys."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") > 1)
    )


def unique(table: str, df: DataFrame, key: str) -> Check:
    return Check(f"unique({table}.{key})", duplicate_keys(df, key))


def not_null(table: str, df: DataFrame, column: str) -> Check:
    return Check(f"not_null({table}.{column})", df.filter(F.col(column).isNull()).select(column))


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows outside ``[low, high]``, both ends allowed; nulls pass."""
    return df.filter(~F.col(column).between(low, high))


def accepted_range(table: str, df: DataFrame, column: str, low: float, high: float) -> Check:
    return Check(f"accepted_range({table}.{column})", out_of_range(df, column, low, high))


def accepted_values(table: str, df: DataFrame, column: str, values: Iterable[str]) -> Check:
    """Values never agreed on, with their number of rows."""
    unknown = df.filter(~F.col(column).isin(list(values)))
    return Check(
        f"accepted_values({table}.{column})",
        unknown.groupBy(column).agg(F.count("*").alias("n")),
    )


def blank_share(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.count_if(F.col(column).isNull()).alias("blank"), F.count("*").alias("total")
    ).withColumn("share", F.try_divide(F.col("blank").cast("double"), F.col("total")))


def blank_share_at_most(table: str, df: DataFrame, column: str, limit: float) -> Check:
    return Check(
        f"blank_share({table}.{column})",
        blank_share(df, column).filter(F.col("share") > limit),
    )


def missing_rates(priced: DataFrame) -> DataFrame:
    """Groups of attributed payments that no rate converts; a sum would leave them out silently."""
    return priced.filter(F.col("local_units_per_usd").isNull()).select(
        "call_date", "market", "currency", "payments", "amount_local"
    )


def require_rates(priced: DataFrame) -> None:
    run_checks([Check("rate for every attributed payment", missing_rates(priced))])


def run_checks(checks: Iterable[Check]) -> dict[str, int]:
    """Run all checks as one job, then raise one error naming every one that failed."""
    checks = list(checks)
    counted = [
        c.violations.agg(F.count("*").alias("n")).select(F.lit(c.name).alias("name"), "n")
        for c in checks
    ]
    # One row per check.
    found = {r["name"]: r["n"] for r in reduce(DataFrame.unionAll, counted).collect()}
    failed = [f"{c.name}: {found[c.name]} violation(s)" for c in checks if found[c.name]]
    if failed:
        raise QualityError("; ".join(failed))
    return found
