"""Partial aggregates of the marts per date, from which roll-ups of any period are read.

A date's state is replaced whenever the date of its mart is, and published in the same commit. Its
columns are those of the mart that the roll-ups add up, so ``plans.rollups`` takes states as it takes
marts. A state has a row per date, or per date and market or reason levels, however many rows the
mart has; a roll-up reads no mart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.plans import incremental
from callscope.plans.incremental import Scope
from callscope.sources.tables import Tables

SCHEMA = "states"


@dataclass(frozen=True)
class State:
    """Date column of a mart, columns its state keeps apart, and what is added up."""

    day: str
    by: tuple[str, ...]
    sums: Callable[[], list[Column]]


def _sum(column: str) -> Column:
    return F.sum(column).alias(column)


STATES = {
    "fct_coding_rate": State("call_date", (), lambda: [_sum("coded_calls"), _sum("total_calls")]),
    "fct_paid_post_call": State(
        "disposed_date",
        ("is_window_closed",),
        lambda: [
            F.count_if("is_paid_post_call").alias("paid_calls"),
            F.count("*").alias("assessable_calls"),
        ],
    ),
    "fct_value_recovered_usd": State("call_date", ("market",), lambda: [_sum("value_recovered_usd")]),
    "fct_inbound_call_drivers": State(
        "call_date", ("level_one", "level_two", "level_three"), lambda: [_sum("call_count")]
    ),
}


def partial(mart: DataFrame, state: State) -> DataFrame:
    """One row per date and kept columns."""
    return mart.groupBy(state.day, *state.by).agg(*state.sums())


def rebuild(tables: Tables, mart: tuple[str, str], scope: Scope) -> int:
    """States of the dates in scope, after these were written; of all dates if there is no state yet."""
    state = STATES[mart[1]]
    if not tables.exists(SCHEMA, mart[1]):
        scope = Scope.everything()
    rows = tables.read(*mart).filter(scope.holds(F.col(state.day)))
    return incremental.rebuild(tables, partial(rows, state), SCHEMA, mart[1], state.day, scope)


def period(
    tables: Tables, mart: tuple[str, str], since: date | None = None, until: date | None = None
) -> DataFrame:
    """States of the dates from ``since`` to ``until``, both included; without limits also of no date."""
    rows, day = tables.read(SCHEMA, mart[1]), F.col(STATES[mart[1]].day)
    if since is not None:
        rows = rows.filter(day >= F.lit(since))
    if until is not None:
        rows = rows.filter(day <= F.lit(until))
    return rows
