"""Timestamps without a zone: every calculation is independent of the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

ATTRIBUTION_DAYS = 3


def ntz(value: datetime) -> Column:
    """A literal naive timestamp."""
    if value.tzinfo is not None:
        raise ValueError("expected a naive UTC timestamp")
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def plus_days(at: Column, days: int) -> Column:
    return at + F.make_dt_interval(F.lit(days))


def window_close(disposed_at: Column) -> Column:
    """End, inclusive, of the period in which a payment can belong to a disposition."""
    return plus_days(disposed_at, ATTRIBUTION_DAYS)


def micros(at: Column) -> Column:
    """Microseconds since 1970-01-01 on the clock the timestamp was written in."""
    seconds = F.unix_date(F.to_date(at)).cast("bigint") * 86400 + F.hour(at) * 3600 + F.minute(at) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), at) * 1_000_000).cast("bigint")


def from_micros(us: Column) -> Column:
    """The naive timestamp of ``micros``."""
    second = F.floor(us / 1_000_000).cast("bigint")
    second = F.when(us - second * 1_000_000 < 0, second - 1).otherwise(second)
    day = F.floor(second / 86400)
    fraction = (us - day * 86_400_000_000).cast("decimal(20,6)") / 1_000_000
    midnight = F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction.cast("decimal(18,6)"))
