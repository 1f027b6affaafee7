"""Queries over the test tables with their comparison SQL."""

from callscope.queries import checks, ingestion, models, refresh  # noqa: F401
from callscope.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
