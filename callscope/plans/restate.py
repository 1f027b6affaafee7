"""What a run changed on dates that were published before.

A run replaces whole dates of a mart. Before it is published, the replaced dates are compared with
the version that the last commit shows, row by row on their key, and the differences are kept in
``restated.{mart}`` by commit and date. The old version plus the differences is the new one. Dates
that had no partition before are new, not restated. Only replaced dates are read, and of these only
rows that differ are written; a double that differs in its last digit differs.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callscope.sources.tables import Tables

COMMIT, PUBLISHED_DATE = "commit", "published_date"


def differences(before: DataFrame, after: DataFrame, day: str, key: str) -> DataFrame:
    """(published_date, kind, before, after) of the rows that differ; ``kind`` is added, removed or
    changed. ``key`` is unique within a date; null dates and keys are compared as values."""
    types = dict(before.dtypes)
    columns = after.schema

    def side(rows: DataFrame, name: str, known: dict[str, str]) -> DataFrame:
        # A column that a version does not have yet is null there.
        row = F.struct(
            *[(F.col(f.name) if f.name in known else F.lit(None)).cast(f.dataType).alias(f.name) for f in columns]
        )
        return rows.select(F.col(day).alias(f"{name}_day"), F.col(key).alias(f"{name}_key"), row.alias(name))

    same = F.col("before_day").eqNullSafe(F.col("after_day")) & F.col("before_key").eqNullSafe(F.col("after_key"))
    both = side(before, "before", types).join(side(after, "after", dict(after.dtypes)), same, "full_outer")
    kind = (
        F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    )
    return both.filter(~F.col("before").eqNullSafe(F.col("after"))).select(
        F.coalesce("before_day", "after_day").alias(PUBLISHED_DATE), kind.alias("kind"), "before", "after"
    )


def replay(before: DataFrame, changes: DataFrame, day: str, key: str) -> DataFrame:
    """The version after, from the one before and what was kept."""
    gone = changes.filter(F.col("before").isNotNull()).select(
        F.col(f"before.{day}").alias("gone_day"), F.col(f"before.{key}").alias("gone_key")
    )
    same = F.col(day).eqNullSafe(F.col("gone_day")) & F.col(key).eqNullSafe(F.col("gone_key"))
    return before.join(gone, same, "left_anti").unionByName(
        changes.filter(F.col("after").isNotNull()).select("after.*"), allowMissingColumns=True
    )


def keep(tables: Tables, mart: tuple[str, str], day: str, key: str) -> int:
    """Store the differences that the commit under way will publish. A repeated run replaces them."""
    number = str(tables.number_under_way())
    before, after = tables.replaced(*mart)
    found = differences(before, after, day, key).withColumn(COMMIT, F.lit(int(number)))
    return tables.replace_partitions(
        found,
        "restated",
        mart[1],
        [COMMIT, PUBLISHED_DATE],
        in_scope=lambda p: p[COMMIT] == number,
        first={number},
    )


def changes(tables: Tables, mart: tuple[str, str], commits: Iterable[int] | None = None) -> DataFrame:
    """Differences of the commits given, by default of all; what a failed run noted is left out."""
    last = max(tables.commits(), default=0)
    rows = tables.read("restated", mart[1]).filter(F.col(COMMIT) <= last)
    return rows if commits is None else rows.filter(F.col(COMMIT).isin(list(commits)))


def moved(kept: DataFrame, **measures: Column) -> DataFrame:
    """Per commit and date: rows by kind of change, and each measure summed before and after.

    A measure is a column over ``row``, the row as it was or is. Rows that did not change are in
    neither sum, so the difference of the two is what moved.
    """

    def summed(measure: Column, name: str, side: str) -> Column:
        over = F.when(F.col("side") == side, measure)
        return F.coalesce(F.sum(over), F.lit(0)).alias(f"{name}_{side}")

    sides = F.array(
        *[F.struct(F.lit(s).alias("side"), F.col(s).alias("row")) for s in ("before", "after")]
    )
    rows = kept.select(COMMIT, PUBLISHED_DATE, "kind", F.inline(sides))
    once = F.col("side") == F.lit("before")
    return rows.groupBy(COMMIT, PUBLISHED_DATE).agg(
        *[F.count_if(once & (F.col("kind") == k)).alias(k) for k in ("added", "removed", "changed")],
        *[summed(m, n, s) for n, m in measures.items() for s in ("before", "after")],
    )
