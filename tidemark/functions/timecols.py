"""Time arithmetic that works for both timestamp flavours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def epoch_seconds(df: DataFrame, col: str) -> Column:
    """Whole seconds since 1970-01-01 00:00:00, rounded down, as bigint.

    ``timestamp`` counts from the UTC epoch, like ``cast(ts as long)``;
    ``timestamp_ntz`` counts from the zone-free epoch wall clock, so the
    value does not depend on the session time zone.  Strings are parsed as
    timestamps first.
    """
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        # Calendar fields of a timestamp_ntz are zone-free; casts to
        # timestamp (as timestampdiff does) would shift by the session zone.
        c = F.col(col)
        return (F.unix_date(c.cast("date")).cast("bigint") * 86400
                + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c))
    c = F.col(col)
    if isinstance(dtype, T.StringType):
        c = c.try_cast("timestamp")
    return F.unix_seconds(c)


def order_number(df: DataFrame, col: str) -> Column | None:
    """An integer that orders and tells apart like the column: microseconds of
    times, days of dates, integers themselves; None for other types."""
    dtype, c = df.schema[col].dataType, F.col(col)
    if isinstance(dtype, T.TimestampNTZType):
        micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
        minutes = F.unix_date(c.cast("date")).cast("bigint") * 1440 + F.hour(c) * 60 + F.minute(c)
        return minutes * 60_000_000 + micros
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("bigint")
    return c.cast("bigint") if isinstance(dtype, T.IntegralType) else None
