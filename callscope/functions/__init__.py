"""Column functions."""

from callscope.functions.keys import plain_number, surrogate_key
from callscope.functions.labels import (
    CURRENCIES,
    CURRENCY_BY_TENANT,
    MARKET_BY_CENTRE,
    MARKET_BY_TENANT,
    label,
)
from callscope.functions.text import (
    blank_to_null,
    note_to_id,
    strip_outer_whitespace,
    trim_blanks,
)
from callscope.functions.times import from_micros, micros, ntz, plus_days, window_close

__all__ = [
    "CURRENCIES",
    "CURRENCY_BY_TENANT",
    "MARKET_BY_CENTRE",
    "MARKET_BY_TENANT",
    "blank_to_null",
    "from_micros",
    "label",
    "micros",
    "note_to_id",
    "ntz",
    "plain_number",
    "plus_days",
    "strip_outer_whitespace",
    "surrogate_key",
    "trim_blanks",
    "window_close",
]
