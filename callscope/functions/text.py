"""Free-text cleaning without regular-expression replaces or UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a plain SQL trim removes in the warehouse (Unicode space separators).
BLANKS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)
# The characters of the warehouse's regex class \s.
WHITESPACE = " \t\n\f\r"


def trim_blanks(text: Column) -> Column:
    """Trim space separators at both ends; tabs and newlines stay.

    In text of single-byte characters only the plain space can occur, which trims much faster.
    """
    single_bytes = F.octet_length(text) == F.length(text)
    return F.when(single_bytes, F.trim(text)).otherwise(F.btrim(text, F.lit(BLANKS)))


def blank_to_null(text: Column) -> Column:
    return F.nullif(trim_blanks(text), F.lit(""))


def strip_outer_whitespace(text: Column) -> Column:
    """Remove whitespace, newlines included, at both ends; whitespace inside stays."""
    return F.btrim(text, F.lit(WHITESPACE))


def note_to_id(note: Column) -> Column:
    """Id pasted into a note: digits only but for outer whitespace, else null; null beyond 64 bits.

    The cast ignores the whitespace that the pattern lets through.
    """
    is_id = note.rlike(r"\A[ \t\n\f\r]*+[0-9]++[ \t\n\f\r]*+\z")
    return F.when(is_id, note.try_cast("bigint"))
