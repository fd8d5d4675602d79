"""Quote analytics job: end-of-day tables -> quote-trade analytical table.

Two entry points:

* :func:`analytics_all_dates` — every date at once; the key includes
  ``trade_dt`` so windows never cross days, and each date's close is the
  previous date's last trade.
* :func:`analytics_for_date` — one date (default: the latest trade date)
  with the previous calendar day's close, reading only those two date
  partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import analytics
from tidemark.operators.series import MOVING_AVERAGE_SECONDS
from tidemark.sources import sinks, tables

KEYS = ("trade_dt", "symbol", "exchange")


def analytics_all_dates(trades: DataFrame, quotes: DataFrame,
                        keys: Sequence[str] = KEYS, close_mode: str = "calendar",
                        window_seconds: int = MOVING_AVERAGE_SECONDS,
                        parts: int | None = None, outline: DataFrame | None = None) -> DataFrame:
    """Analytical rows for every quote of every date.  ``outline``: see
    :func:`tidemark.operators.analytics.enrich_quotes`."""
    close = analytics.previous_close(
        trades, keys, mode=close_mode,
        next_dates=quotes.select("trade_dt") if close_mode == "available" else None)
    return analytics.enrich_quotes(trades, quotes, close, keys,
                                   window_seconds=window_seconds, parts=parts, outline=outline)


def analytics_for_date(spark: SparkSession, eod_base: str, day=None,
                       window_seconds: int = MOVING_AVERAGE_SECONDS,
                       parts: int | None = None) -> DataFrame:
    """Analytical rows of one date (default: latest trade date)."""
    if day is None:
        day = tables.latest_date(spark, f"{eod_base}/trade")
    trades, quotes = tables.read_eod_date(spark, eod_base, day)
    prev_trades = tables.with_time(
        tables.read_date(spark, f"{eod_base}/trade", tables.previous_date(day)))
    # The previous day's close, re-labelled with the processed day.
    close = analytics.previous_close(prev_trades, KEYS, mode="calendar")
    return analytics.enrich_quotes(trades, quotes, close, KEYS,
                                   window_seconds=window_seconds, parts=parts)


def run_analytics(spark: SparkSession, eod_base: str, out_base: str, day=None) -> DataFrame:
    """Compute one date and write it to ``<out_base>/date=<day>``."""
    day = day or tables.latest_date(spark, f"{eod_base}/trade")
    out = analytics_for_date(spark, eod_base, day)
    sinks.write_analytics(out, out_base, day)
    return out
