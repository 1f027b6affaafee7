"""Staging -> intermediate."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.operators.attribution import attribute_payments, with_window_state
from callscope.operators.coding import match_calls
from callscope.operators.skew import SPLIT_ROWS

# Fixed value: the only call type that is certain to be inbound.
INBOUND = "Inbound Team"


def int_calls_coded(
    calls: DataFrame, dispositions: DataFrame, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    return match_calls(calls, dispositions, split_rows)


def int_dispositions_hierarchy(dispositions: DataFrame) -> DataFrame:
    return dispositions.filter(F.col("call_type") == INBOUND).select(
        "call_log_id", "market", "disposed_at_utc", "level_one", "level_two", "level_three"
    )


def int_calls_payment_attribution(
    dispositions: DataFrame,
    payments: DataFrame,
    as_of: datetime,
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    return with_window_state(attribute_payments(dispositions, payments, split_rows), as_of)
