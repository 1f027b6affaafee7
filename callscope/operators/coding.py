"""Calls linked to dispositions through the id typed into the call note."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.functions import note_to_id
from callscope.operators.skew import SPLIT_ROWS, salted_join


def with_candidate_id(calls: DataFrame) -> DataFrame:
    return calls.withColumn("candidate_call_log_id", note_to_id(F.col("call_notes_raw")))


def match_calls(
    calls: DataFrame, dispositions: DataFrame, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Every call, with the disposition its note names if there is one."""
    matched = dispositions.select(
        F.col("call_log_id").alias("matched_call_log_id"),
        F.col("contract_id").alias("matched_contract_id"),
        F.col("disposed_at_utc").alias("matched_disposed_at_utc"),
    )
    joined = salted_join(
        with_candidate_id(calls),
        matched,
        "candidate_call_log_id",
        "matched_call_log_id",
        spread_by="call_id",
        split_rows=split_rows,
    )
    return joined.select(
        "call_id",
        "called_at_local",
        "market",
        "call_type",
        "talk_time_ms",
        "ameyo_user_id",
        "campaign_name",
        "call_notes_raw",
        "candidate_call_log_id",
        "matched_call_log_id",
        "matched_contract_id",
        "matched_disposed_at_utc",
        F.col("matched_call_log_id").isNotNull().alias("is_coded"),
    )


def unmatched_notes(
    calls: DataFrame, dispositions: DataFrame, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Calls whose note is a number that no disposition has."""
    numeric = with_candidate_id(calls).filter(F.col("candidate_call_log_id").isNotNull())
    return salted_join(
        numeric,
        dispositions.select(F.col("call_log_id").alias("known_id")),
        "candidate_call_log_id",
        "known_id",
        spread_by="call_id",
        how="left_anti",
        split_rows=split_rows,
    )
