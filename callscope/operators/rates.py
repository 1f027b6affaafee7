"""Exchange rates per currency: the latest one, or the one nearest to a date; as known at a time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callscope.functions import ntz


def known_rates(versions: DataFrame, known_at: datetime) -> DataFrame:
    """Of each date and currency the rate fetched last by ``known_at``, naive UTC, inclusive.

    A rate without a time of fetching was never known. Two fetches at one instant: the larger rate.
    """
    others = [c for c in versions.columns if c not in ("rate_date", "currency")]
    newest = F.max(F.struct("fetched_at", *[c for c in others if c != "fetched_at"])).alias("v")
    return (
        versions.filter(F.col("fetched_at") <= ntz(known_at))
        .groupBy("rate_date", "currency")
        .agg(newest)
        .select(*[F.col(f"v.{c}") if c in others else F.col(c) for c in versions.columns])
    )


def latest_rates(rates: DataFrame) -> DataFrame:
    """One row per currency."""
    return (
        rates.groupBy("currency")
        .agg(F.max(F.struct("rate_date", "local_units_per_usd")).alias("r"))
        .select("currency", "r.rate_date", "r.local_units_per_usd")
    )


def price_latest(amounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Add the most recent rate of each row's currency; null if there is none."""
    return amounts.join(latest_rates(rates), "currency", "left")


def price_nearest(amounts: DataFrame, rates: DataFrame) -> DataFrame:
    """Add the rate dated nearest to ``call_date``, the earlier one of two at equal distance.

    ``amounts`` is already summed by date, market and currency, and there is one rate per date and
    currency, so a currency's group grows with the calendar and not with the payments.
    """
    rate = F.struct("rate_date", "local_units_per_usd")
    timeline = amounts.withColumn("day", F.col("call_date")).unionByName(
        rates.select(
            "currency",
            F.col("rate_date").alias("day"),
            rate.alias("rate"),
        ),
        allowMissingColumns=True,
    )
    by_day = Window.partitionBy("currency").orderBy("day")
    upto = by_day.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    onward = by_day.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    found = (
        timeline.withColumn("earlier", F.last("rate", ignorenulls=True).over(upto))
        .withColumn("later", F.first("rate", ignorenulls=True).over(onward))
        .filter(F.col("rate").isNull())
    )
    to_earlier = F.datediff("day", "earlier.rate_date")
    to_later = F.datediff("later.rate_date", "day")
    take_earlier = F.col("later").isNull() | (to_earlier <= to_later)
    pick = F.when(F.col("earlier").isNotNull() & take_earlier, F.col("earlier")).otherwise(
        F.col("later")
    )
    return found.select(
        *amounts.columns,
        pick["rate_date"].alias("rate_date"),
        pick["local_units_per_usd"].alias("local_units_per_usd"),
    )
