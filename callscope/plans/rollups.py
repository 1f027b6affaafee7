"""Published figures and drill-downs over the marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coding_rate_overall(coding: DataFrame) -> DataFrame:
    """Coded over all calls; a mean of the groups' rates would weigh small groups too much."""
    return coding.agg(
        F.sum("coded_calls").alias("coded_calls"), F.sum("total_calls").alias("total_calls")
    ).withColumn("coding_rate", F.col("coded_calls").cast("double") / F.col("total_calls"))


def paid_post_call_overall(paid: DataFrame) -> DataFrame:
    """Share of paid dispositions among those whose window has closed."""
    return _with_paid_rate(
        settled(paid).agg(
            F.count_if("is_paid_post_call").alias("paid_calls"),
            F.count("*").alias("assessable_calls"),
        )
    )


def paid_post_call_of_states(states: DataFrame) -> DataFrame:
    """The same share from the mart's states."""
    return _with_paid_rate(
        settled(states).agg(
            F.coalesce(F.sum("paid_calls"), F.lit(0)).alias("paid_calls"),
            F.coalesce(F.sum("assessable_calls"), F.lit(0)).alias("assessable_calls"),
        )
    )


def _with_paid_rate(counts: DataFrame) -> DataFrame:
    rate = F.try_divide(F.col("paid_calls").cast("double"), F.col("assessable_calls"))
    return counts.withColumn("paid_rate", rate)


def settled(paid: DataFrame) -> DataFrame:
    """Only rows whose answer can no longer change."""
    return paid.filter("is_window_closed")


def value_recovered_by_market(value: DataFrame) -> DataFrame:
    """USD per market and in total; ``is_total`` tells the total from an unknown market."""
    return (
        value.rollup("market")
        .agg(
            F.grouping("market").cast("int").alias("is_total"),
            F.sum("value_recovered_usd").alias("value_recovered_usd"),
        )
    )


def top_drivers(drivers: DataFrame, n: int) -> DataFrame:
    return (
        drivers.groupBy("level_one")
        .agg(F.sum("call_count").alias("call_count"))
        .orderBy(F.desc("call_count"), "level_one")
        .limit(n)
    )


def driver_drill_down(drivers: DataFrame) -> DataFrame:
    """Counts per prefix of the three levels; ``depth_id`` separates subtotals from null levels."""
    return drivers.rollup("level_one", "level_two", "level_three").agg(
        F.grouping_id("level_one", "level_two", "level_three").cast("int").alias("depth_id"),
        F.sum("call_count").alias("call_count"),
    )
