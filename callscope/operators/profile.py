"""Figures about gaps in the data. Groups are counted map-side before any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.operators.coding import with_candidate_id

# Provider names that are no payment providers.
NON_PROVIDERS = ("MANUAL", "UNKNOWN", "LOYALTY_DISCOUNT")


def blank_notes(calls: DataFrame) -> DataFrame:
    return calls.agg(
        F.count_if(F.col("call_notes_raw").isNull()).alias("blank"), F.count("*").alias("total")
    )


def note_classes(calls: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Notes that match a disposition, are numbers without one, or no ids at all.

    Calls are counted per id before the ids are looked up, so an id typed into very many notes
    joins as one row.
    """
    per_id = (
        with_candidate_id(calls.filter(F.col("call_notes_raw").isNotNull()))
        .groupBy("candidate_call_log_id")
        .agg(F.count("*").alias("n"))
    )
    known = dispositions.select("call_log_id")
    note_class = (
        F.when(F.col("call_log_id").isNotNull(), "matched")
        .when(F.col("candidate_call_log_id").isNull(), "not an id")
        .otherwise("unmatched")
    )
    return (
        per_id.join(known, F.col("candidate_call_log_id") == F.col("call_log_id"), "left")
        .groupBy(note_class.alias("note_class"))
        .agg(F.sum("n").alias("n"))
    )


def mapping_variants(raw_mapping: DataFrame) -> DataFrame:
    """The different rows of the mapping, each with the number of its copies; nulls are equal."""
    columns = ("contact_centre", "ameyo_user_id", "team", "atlas_user_name")
    return raw_mapping.groupBy(*columns).agg(F.count("*").alias("n"))


def mapping_duplicates(raw_mapping: DataFrame) -> DataFrame:
    """Logins on several mapping rows: copies only, differing, or differing in the team."""
    variants = mapping_variants(raw_mapping)
    team = F.coalesce("team", F.lit(""))
    per_login = variants.groupBy("ameyo_user_id").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("variants"),
        F.min(team).alias("first_team"),
        F.max(team).alias("last_team"),
    )
    duplicate_class = (
        F.when(F.col("variants") == 1, "exact")
        .when(F.col("first_team") == F.col("last_team"), "conflicting")
        .otherwise("conflicting on team")
    )
    return (
        per_login.filter(F.col("n") > 1)
        .groupBy(duplicate_class.alias("duplicate_class"))
        .agg(F.count("*").alias("logins"), F.sum("n").alias("mapping_rows"))
    )


def odd_payments(payments: DataFrame) -> DataFrame:
    return payments.agg(
        F.count_if(F.col("amount_local") <= 0).alias("not_positive"),
        *[
            F.count_if(F.col("payment_request_provider") == p).alias(p.lower())
            for p in NON_PROVIDERS
        ],
    )


def null_contracts(dispositions: DataFrame) -> DataFrame:
    return dispositions.groupBy("call_type").agg(
        F.count_if(F.col("contract_id").isNull()).alias("null_contracts"),
        F.count("*").alias("dispositions"),
    )


def tied_dispositions(dispositions: DataFrame) -> DataFrame:
    """Number of (contract, instant) pairs with several dispositions."""
    return (
        dispositions.filter(F.col("contract_id").isNotNull())
        .groupBy("contract_id", "disposed_at_utc")
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("tied"))
    )


def call_types(dispositions: DataFrame) -> DataFrame:
    return dispositions.groupBy("call_type").agg(F.count("*").alias("n"))


def contract_load(dispositions: DataFrame, payments: DataFrame) -> DataFrame:
    """Contracts that pay, those that pay more than once, and the most dispositions of one."""
    contract = F.col("contract_id").isNotNull()
    per_contract = (
        dispositions.filter(contract)
        .select("contract_id", F.lit(1).alias("d"), F.lit(0).alias("p"))
        .unionAll(
            payments.filter(contract).select(
                "contract_id", F.lit(0).alias("d"), F.lit(1).alias("p")
            )
        )
        .groupBy("contract_id")
        .agg(F.sum("d").alias("d"), F.sum("p").alias("p"))
    )
    return per_contract.agg(
        F.count_if(F.col("p") > 0).alias("paying"),
        F.count_if(F.col("p") > 1).alias("paying_repeatedly"),
        F.max("d").alias("most_dispositions"),
    ).withColumn(
        "repeat_share",
        F.try_divide(F.col("paying_repeatedly").cast("double"), F.col("paying")),
    )


def collapsed_payments(payments: DataFrame) -> DataFrame:
    """Payments the attribution counts once although they are several rows."""
    return (
        payments.filter(F.col("contract_id").isNotNull() & (F.col("amount_local") > 0))
        .groupBy("contract_id", "pay_timestamp_utc", "amount_local")
        .agg(F.count("*").alias("n"))
        .agg(F.sum(F.col("n") - 1).alias("collapsed"))
    )
