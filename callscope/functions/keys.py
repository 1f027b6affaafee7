"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the null marker of the public dbt-utils surrogate key.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def plain_number(value: Column) -> Column:
    """A double as text without exponent and without padding zeros: ``1.0E7`` -> ``10000000.0``.

    Beyond the range of the decimal the double's own text stands.
    """
    digits = F.rtrim(value.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
    padded = F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)
    return F.coalesce(padded, value.cast("string"))


def surrogate_key(*parts: Column) -> Column:
    """md5 over the parts as text, joined by ``-``; a null part counts as a marker."""
    return F.md5(
        F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_MARKER)) for p in parts])
    )
