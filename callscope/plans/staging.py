"""Raw -> staging: rename, cast, label, clean. Lazy projections, one row in, one row out.

Only the agent mapping changes the grain, to one row per login.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope import schemas
from callscope.functions import (
    CURRENCY_BY_TENANT,
    MARKET_BY_CENTRE,
    MARKET_BY_TENANT,
    blank_to_null,
    label,
    trim_blanks,
)

# Lineage column names of the hosted connector.
CONNECTOR_LINEAGE = {
    "_ab_source_file_url": "_source_file",
    "_airbyte_extracted_at": "_loaded_at",
}


def unify_lineage(raw: DataFrame) -> DataFrame:
    """One lineage shape, whichever loader landed the rows."""
    return raw.withColumnsRenamed(CONNECTOR_LINEAGE)


def _lineage(raw: DataFrame) -> list[Column]:
    return [F.col(c) for c in schemas.LINEAGE if c in raw.columns]


def stg_calls(raw: DataFrame) -> DataFrame:
    """One row per call leg; ``called_at_local`` stays in the centre's local time."""
    raw = unify_lineage(raw)
    return raw.select(
        F.col("ch_call_id").cast("bigint").alias("call_id"),
        F.col("ch_date_added").cast("timestamp_ntz").alias("called_at_local"),
        label(F.col("ch_contact_center_id").cast("int"), MARKET_BY_CENTRE).alias("market"),
        F.col("ch_system_disposition").alias("system_disposition"),
        F.col("ch_call_type").alias("call_type"),
        F.col("total_talk_time").cast("bigint").alias("talk_time_ms"),
        F.col("udh_user_id").cast("string").alias("ameyo_user_id"),
        "campaign_name",
        blank_to_null(F.col("udh_notes")).alias("call_notes_raw"),
        *_lineage(raw),
    )


def stg_dispositions(raw: DataFrame) -> DataFrame:
    """One row per disposition. Blank levels two and three become null, level one stays as is."""
    raw = unify_lineage(raw)
    return raw.select(
        F.col("call_log_id").cast("bigint").alias("call_log_id"),
        label(F.col("tenant_id").cast("int"), MARKET_BY_TENANT).alias("market"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("contract_id").cast("bigint").alias("contract_id"),
        F.col("created_timestamp_utc").cast("timestamp_ntz").alias("disposed_at_utc"),
        F.col("createdby").cast("string").alias("disposed_by"),
        "call_type",
        "level_one",
        blank_to_null(F.col("level_two")).alias("level_two"),
        blank_to_null(F.col("level_three")).alias("level_three"),
        *_lineage(raw),
    )


def stg_disposition_keys(entries: DataFrame) -> DataFrame:
    """What coding needs of dispositions, from entries of their key index."""
    return entries.select(
        F.col("key").cast("bigint").alias("call_log_id"),
        F.col("contract_id").cast("bigint").alias("contract_id"),
        F.col("created_timestamp_utc").cast("timestamp_ntz").alias("disposed_at_utc"),
    )


def stg_payments(raw: DataFrame) -> DataFrame:
    """One row per payment, in local currency. Bad amounts and odd providers stay in."""
    raw = unify_lineage(raw)
    tenant = F.col("tenant_id").cast("int")
    return raw.select(
        F.col("pay_timestamp_utc").cast("timestamp_ntz").alias("pay_timestamp_utc"),
        label(tenant, MARKET_BY_TENANT).alias("market"),
        label(tenant, CURRENCY_BY_TENANT).alias("currency"),
        tenant.alias("tenant_id"),
        F.col("contract_id").cast("bigint").alias("contract_id"),
        trim_blanks(F.col("payment_request_provider")).alias("payment_request_provider"),
        "create_program",
        F.col("amount").cast("double").alias("amount_local"),
        *_lineage(raw),
    )


def stg_fx_rates(raw: DataFrame) -> DataFrame:
    return raw.select("rate_date", "currency", "local_units_per_usd", "fetched_at")


def stg_agent_mapping(raw: DataFrame) -> DataFrame:
    """One row per login: the alphabetically first name, then team, then centre, nulls last.

    The smallest row of a login is an aggregate, so copies of a row and a login with very many rows
    shrink before the shuffle; no window, no separate DISTINCT.
    """
    order = ("atlas_user_name", "team", "contact_centre")
    smallest = F.min(
        F.struct(
            *[c for n in order for c in (F.isnull(n).alias(f"{n}_absent"), F.col(n))],
        )
    )
    return (
        raw.groupBy(F.col("ameyo_user_id").cast("string").alias("ameyo_user_id"))
        .agg(smallest.alias("pick"))
        .select(
            F.col("pick.contact_centre").alias("market"),
            "ameyo_user_id",
            F.col("pick.team").alias("team"),
            F.col("pick.atlas_user_name").alias("atlas_user_name"),
        )
    )
