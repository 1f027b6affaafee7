"""Code-to-label columns. An unknown code gives null."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Contact-centre codes, tenant codes and their currencies.
MARKET_BY_CENTRE = {1: "Kenya", 2: "Uganda", 3: "Tanzania", 4: "Nigeria"}
MARKET_BY_TENANT = {1001: "Kenya", 1002: "Uganda", 1003: "Tanzania", 1004: "Nigeria"}
CURRENCY_BY_TENANT = {1001: "KES", 1002: "UGX", 1003: "TZS", 1004: "NGN"}
CURRENCIES = ("KES", "UGX", "TZS", "NGN")


def label(code: Column, names: Mapping[int, str]) -> Column:
    """Look ``code`` up in ``names``; stays one codegen'd CASE."""
    (first, name), *rest = names.items()
    out = F.when(code == first, name)
    for value, name in rest:
        out = out.when(code == value, name)
    return out
