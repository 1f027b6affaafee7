"""Intermediate -> marts. Every aggregation combines map-side before its shuffle."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.functions import surrogate_key
from callscope.operators.rates import price_latest, price_nearest

FxRule = Literal["latest", "nearest"]


def dim_agent(mapping: DataFrame) -> DataFrame:
    return mapping.select("ameyo_user_id", "atlas_user_name", "team", "market")


def fct_coding_rate(calls_coded: DataFrame, agents: DataFrame) -> DataFrame:
    """Calls, coded calls and their ratio by local date, market, campaign and agent.

    Name and team depend on the login alone, so the calls are counted first and the agents joined
    to the counts.
    """
    counted = calls_coded.groupBy(
        F.to_date("called_at_local").alias("call_date"), "market", "campaign_name", "ameyo_user_id"
    ).agg(
        F.count("*").alias("total_calls"),
        F.count_if("is_coded").alias("coded_calls"),
    )
    named = counted.join(
        agents.select("ameyo_user_id", "atlas_user_name", "team"), "ameyo_user_id", "left"
    )
    return named.select(
        surrogate_key(
            F.col("call_date"), F.col("market"), F.col("campaign_name"), F.col("ameyo_user_id")
        ).alias("coding_rate_id"),
        "call_date",
        "market",
        "campaign_name",
        "ameyo_user_id",
        "atlas_user_name",
        "team",
        "total_calls",
        "coded_calls",
        (F.col("coded_calls").cast("double") / F.col("total_calls")).alias("coding_rate"),
    )


def fct_paid_post_call(attribution: DataFrame) -> DataFrame:
    """One row per assessable disposition, however many payments it got."""
    return attribution.groupBy(
        "call_log_id",
        "market",
        "contract_id",
        "disposed_at_utc",
        "window_closes_at_utc",
        "is_window_closed",
    ).agg(
        F.bool_or("is_paid_post_call").alias("is_paid_post_call"),
        F.count("pay_timestamp_utc").alias("attributed_payment_count"),
    )


def priced_payments(
    attribution: DataFrame, rates: DataFrame, fx: FxRule = "latest"
) -> DataFrame:
    """Attributed amounts by payment date, market and currency, with the rate to convert them.

    All payments of a group share one rate, so the sum is taken before the rate is looked up.
    """
    amounts = (
        attribution.filter(F.col("pay_timestamp_utc").isNotNull())
        .groupBy(F.to_date("pay_timestamp_utc").alias("call_date"), "market", "currency")
        .agg(F.count("*").alias("payments"), F.sum("amount_local").alias("amount_local"))
    )
    return (price_nearest if fx == "nearest" else price_latest)(amounts, rates)


def value_by_day(priced: DataFrame) -> DataFrame:
    usd = F.col("amount_local") / F.col("local_units_per_usd")
    return (
        priced.groupBy("call_date", "market")
        .agg(F.max("rate_date").alias("fx_rate_date_used"), F.sum(usd).alias("value_recovered_usd"))
        .select(
            surrogate_key(F.col("call_date"), F.col("market")).alias("value_recovered_id"),
            "call_date",
            "market",
            "fx_rate_date_used",
            "value_recovered_usd",
        )
    )


def fct_value_recovered_usd(
    attribution: DataFrame, rates: DataFrame, fx: FxRule = "latest"
) -> DataFrame:
    """USD recovered by payment date and market of the call."""
    return value_by_day(priced_payments(attribution, rates, fx))


def fct_inbound_call_drivers(hierarchy: DataFrame) -> DataFrame:
    keys = ("call_date", "market", "level_one", "level_two", "level_three")
    return (
        hierarchy.groupBy(F.to_date("disposed_at_utc").alias("call_date"), *keys[1:])
        .agg(F.count("*").alias("call_count"))
        .select(surrogate_key(*[F.col(k) for k in keys]).alias("driver_id"), *keys, "call_count")
    )
