"""Tolerant cell parsers: text in, typed value or NULL out — never an error.

Spark 4 runs with ANSI mode on, where ``cast``, ``to_date`` and
``to_timestamp`` raise on bad text and ``getItem`` raises out of range.
Submission data is dirty by nature, so every parser here maps bad text to
NULL (the behaviour of the non-ANSI casts the data model was defined on)
without switching ANSI off for the rest of the session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date and time text formats of the submission files.
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"

# Text that the non-ANSI string->long cast accepts: optional sign, digits with
# an optional fraction (truncated), surrounding blanks.  Exponents, suffixes
# and NaN are rejected.
_LONG_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"
# Exact shape of TIME_FORMAT; the cast that follows checks the calendar.
_TIME_SHAPE = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3}$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field(parts: Column, i: int) -> Column:
    """``parts[i]`` (0-based) or NULL when the array is shorter."""
    return F.get(parts, i)


def to_long(c: Column | str) -> Column:
    """Text -> bigint, truncating a fraction (``'100.0'`` -> 100, ``'-3.9'`` -> -3).

    NULL for anything else, including out-of-range values.
    """
    c = _col(c)
    return F.when(c.rlike(_LONG_TEXT),
                  c.try_cast("decimal(38,18)").try_cast("bigint"))


def to_double(c: Column | str) -> Column:
    """Text -> double (``'1e3'``, ``'NaN'``, ``'5d'`` accepted); NULL otherwise."""
    return _col(c).try_cast("double")


def to_date(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Text -> date in exactly ``fmt``; NULL otherwise."""
    return F.try_to_date(_col(c), fmt)


def to_timestamp(c: Column | str, fmt: str = TIME_FORMAT,
                 ntz: bool = False) -> Column:
    """Text -> timestamp in exactly ``fmt``; NULL otherwise.

    ``ntz=False`` gives a session-time-zone ``timestamp`` (the reference
    type).  ``ntz=True`` gives a zone-free ``timestamp_ntz`` whose wall clock
    equals the text, independent of the session zone.
    """
    c = _col(c)
    if not ntz:
        return F.try_to_timestamp(c, F.lit(fmt))
    if fmt == TIME_FORMAT:
        return F.when(c.rlike(_TIME_SHAPE), c.try_cast("timestamp_ntz"))
    return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
