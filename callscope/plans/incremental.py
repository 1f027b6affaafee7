"""Which dates of a mart have to be rebuilt, and rebuilding exactly those.

A payment moves between dispositions at most three days apart, and windows stay open for three
days. So a disposition date has to be rebuilt if rows landed for it or for the three days after it,
or if it may have been open at the last run. The rebuilt dates are replaced as a whole, never row by
row: no row can outlive the state it was built from, and a rerun changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.functions.times import ATTRIBUTION_DAYS
from callscope.sources.tables import Partition, Tables

# Fixed value: days looked back, one more than the attribution window.
LOOKBACK_DAYS = 4


@dataclass(frozen=True)
class Scope:
    """Dates to rebuild: all, or those from ``since`` on plus single older ones; and unknown dates.

    Its size is that of the calendar. As literals the dates prune partitions.
    """

    since: date
    older: frozenset[date] = frozenset()

    @classmethod
    def everything(cls) -> Scope:
        return cls(date.min)

    @property
    def is_everything(self) -> bool:
        return self.since == date.min

    def holds(self, day: Column) -> Column:
        if self.is_everything:
            return F.lit(True)
        inside = day.isNull() | (day >= F.lit(self.since))
        return inside | day.isin([F.lit(d) for d in sorted(self.older)]) if self.older else inside

    def has_partition(self, column: str):
        def check(partition: Partition) -> bool:
            value = partition[column]
            if value is None or self.is_everything:
                return True
            day = date.fromisoformat(value)
            return day >= self.since or day in self.older

        return check

    def and_days_after(self, days: int) -> Scope:
        """Also the days following each date."""
        if self.is_everything:
            return self
        more = {d + timedelta(n) for d in self.older for n in range(days + 1)}
        return Scope(self.since, frozenset(d for d in more if d < self.since))


    def and_days_before(self, days: int) -> Scope:
        """Also the days preceding each date."""
        if self.is_everything:
            return self
        since = self.since - timedelta(days)
        more = {d - timedelta(n) for d in self.older for n in range(days + 1)}
        return Scope(since, frozenset(d for d in more if d < since))


def lookback(
    existing: set[date], days: int, touched: Iterable[date] = (), reach_back: int = 0
) -> Scope:
    """Everything from ``days`` before the newest existing date on.

    Dates that received rows are added with the ``reach_back`` days before them, however late the
    rows are. Nothing existing means a full build.
    """
    if not existing:
        return Scope.everything()
    since = max(existing) - timedelta(days)
    older = {d - timedelta(n) for d in touched for n in range(reach_back + 1)}
    return Scope(since, frozenset(d for d in older if d < since))


def attribution_scope(
    existing: set[date], touched: Iterable[date], as_of: datetime, last_as_of: datetime | None
) -> Scope:
    """Lookback plus one window, also before the last and the present ``as_of`` if earlier."""
    if not existing or last_as_of is None:
        return Scope.everything()
    anchors = {max(existing), as_of.date(), last_as_of.date()}
    return lookback(
        {min(anchors)}, LOOKBACK_DAYS + ATTRIBUTION_DAYS, touched, reach_back=ATTRIBUTION_DAYS
    )


def rebuild(
    tables: Tables,
    df: DataFrame,
    schema: str,
    table: str,
    day: str,
    scope: Scope,
    then_by: Iterable[str] = (),
) -> int:
    """Replace the dates in scope by ``df``, which holds all their rows."""
    by = [day, *then_by]
    if scope.is_everything:
        return tables.overwrite(df, schema, table, by)
    in_scope = scope.has_partition(day)
    days = {v for v in tables.first_values(schema, table) if in_scope({day: v})}
    return tables.replace_partitions(df, schema, table, by, in_scope, days)
