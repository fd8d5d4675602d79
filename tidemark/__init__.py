"""tidemark — Spark-native market-data operators.

Exchange submissions (CSV and JSON text lines) become one typed event schema
with bad-record routing; end-of-day tables keep the latest version of every
event; the quote analytics attach a trailing moving average of trade prices,
the last trade, the previous close and bid/ask price moves to every quote.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
built-in Spark expressions, so Catalyst plans it and the JVM runs it.
"""

from tidemark import schema
from tidemark.functions import cells, timecols
from tidemark.operators import analytics, latest, parse, quality, series
from tidemark.plans import eod, ingest, market_feed, quote_analytics
from tidemark.sources import scratch, sinks, tables, text

__all__ = [
    "analytics", "cells", "eod", "ingest", "latest", "market_feed", "parse",
    "quality", "quote_analytics", "schema", "scratch", "series", "sinks",
    "tables", "text", "timecols",
]
