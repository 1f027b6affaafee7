"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callscope.llm.work import Scratch

#: Links that one task turns and writes; fewer tasks than the session's shuffles have only where links are few.
LINKS_PER_TASK = 250_000


def _to_smallest(pairs: DataFrame) -> DataFrame:
    """Each u with the smallest of itself and its neighbours v."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _turn(links: DataFrame) -> DataFrame:
    """One large star, which links larger neighbours to the smallest, and one small star."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    large = both.join(_to_smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    down = large.where("v < u").distinct()
    least = _to_smallest(down)
    moved = down.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    own = least.select(F.col("m").alias("a"), F.col("u").alias("b"))
    return moved.union(own).where("a < b").distinct()


def _mark(links: DataFrame) -> tuple:
    row = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row.n, row.h


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node that a link (a, b) has, component being its smallest node.

    Equal links and links of a node with itself change nothing. Each turn is a written table; the
    number of turns grows with the logarithm of the longest path.
    """
    links = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    current = scratch.store(links, f"{name}-0")
    before, turn = _mark(current), 0
    while before[0]:
        turn += 1
        turned = _turn(current).coalesce(-(-before[0] // LINKS_PER_TASK))
        following = scratch.store(turned, f"{name}-{turn}")
        scratch.drop(f"{name}-{turn - 1}")
        current, now = following, _mark(following)
        if now == before:
            break
        before = now
    stars = current.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.union(current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
