"""Submission lines -> common events, with bad-record routing.

Both parsers are row-local projections (no shuffle): they stream through
the scan inside one whole-stage-codegen span.  Validity is decided by record
type and field count only; a valid record with unparseable cells keeps its
type and carries NULLs, anything else goes to partition ``B``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.functions import cells

# CSV field positions.
CSV_TRADE_DT, CSV_ARRIVAL_TM, CSV_REC_TYPE, CSV_SYMBOL = 0, 1, 2, 3
CSV_EVENT_TM, CSV_EVENT_SEQ_NB, CSV_EXCHANGE = 4, 5, 6
CSV_BID_PR, CSV_BID_SIZE, CSV_ASK_PR, CSV_ASK_SIZE = 7, 8, 9, 10
CSV_TRADE_PR = 7
# Minimum field counts of a valid quote / trade line.
CSV_QUOTE_FIELDS, CSV_TRADE_FIELDS = 11, 8


_PARTS, _MAP = "_tm_parts", "_tm_map"


def _starts_json(value: Column) -> Column:
    # trim() strips blanks only: a tab before "{" does not count.
    return F.startswith(F.trim(value), F.lit("{"))


def _route(is_q: Column, is_t: Column, rec_type: Column,
           ok: Column | None = None) -> Column:
    valid = is_q | is_t
    if ok is not None:
        valid = ok & valid
    return F.when(valid, rec_type).otherwise(F.lit(schema.BAD))


def parse_csv_lines(lines: DataFrame, value: str = "value",
                    ntz: bool = False) -> DataFrame:
    """Comma-separated submission lines -> common events.

    Lines whose trimmed text starts with ``{`` belong to the JSON feed and
    are dropped.  No quoting, header or field trimming: every line is data.
    """
    v = F.col(value)
    # Split once per line: a separate projection keeps Catalyst from inlining
    # the split into every column expression.
    lines = lines.filter(~_starts_json(v)).select(F.split(v, ",").alias(_PARTS))
    parts = F.col(_PARTS)
    n = F.size(parts)
    f = lambda i: cells.field(parts, i)
    rec_type = f(CSV_REC_TYPE)
    is_q = (rec_type == schema.QUOTE) & (n >= CSV_QUOTE_FIELDS)
    is_t = (rec_type == schema.TRADE) & (n >= CSV_TRADE_FIELDS)
    return (
        lines.select(
            cells.to_date(f(CSV_TRADE_DT)).alias("trade_dt"),
            rec_type.alias("rec_type"),
            f(CSV_SYMBOL).alias("symbol"),
            f(CSV_EXCHANGE).alias("exchange"),
            cells.to_timestamp(f(CSV_EVENT_TM), ntz=ntz).alias("event_tm"),
            cells.to_long(f(CSV_EVENT_SEQ_NB)).alias("event_seq_nb"),
            cells.to_timestamp(f(CSV_ARRIVAL_TM), ntz=ntz).alias("arrival_tm"),
            F.when(is_t, cells.to_double(f(CSV_TRADE_PR))).alias("trade_pr"),
            F.when(is_q, cells.to_double(f(CSV_BID_PR))).alias("bid_pr"),
            F.when(is_q, cells.to_long(f(CSV_BID_SIZE))).alias("bid_size"),
            F.when(is_q, cells.to_double(f(CSV_ASK_PR))).alias("ask_pr"),
            F.when(is_q, cells.to_long(f(CSV_ASK_SIZE))).alias("ask_size"),
            _route(is_q, is_t, rec_type).alias("partition"),
        )
    )


# JSON keys.  The record type is read from ``event_type`` and,
# when that is missing or null, from ``rec_type``; the arrival time comes from
# ``file_tm``.
JSON_TYPE_KEYS = ("event_type", "rec_type")
JSON_ARRIVAL_KEY = "file_tm"


def parse_json_lines(lines: DataFrame, value: str = "value",
                     ntz: bool = False) -> DataFrame:
    """One-object-per-line JSON submissions -> common events.

    Lines whose trimmed text does not start with ``{`` belong to the CSV
    feed and are dropped.  Objects are read as ``map<string,string>``: keys
    are looked up by name, unknown keys are ignored, missing keys give NULL,
    malformed text gives a NULL map and so partition ``B``.
    """
    v = F.col(value)
    # Parse once per line (see parse_csv_lines).
    lines = lines.filter(_starts_json(v)).select(
        F.from_json(v, "map<string,string>").alias(_MAP))
    m = F.col(_MAP)
    k = lambda key: m.getItem(key)
    rec_type = F.coalesce(*(k(t) for t in JSON_TYPE_KEYS))
    is_q = rec_type == schema.QUOTE
    is_t = rec_type == schema.TRADE
    return (
        lines.select(
            cells.to_date(k("trade_dt")).alias("trade_dt"),
            rec_type.alias("rec_type"),
            k("symbol").alias("symbol"),
            k("exchange").alias("exchange"),
            cells.to_timestamp(k("event_tm"), ntz=ntz).alias("event_tm"),
            cells.to_long(k("event_seq_nb")).alias("event_seq_nb"),
            cells.to_timestamp(k(JSON_ARRIVAL_KEY), ntz=ntz).alias("arrival_tm"),
            F.when(is_t, cells.to_double(k("trade_pr"))).alias("trade_pr"),
            F.when(is_q, cells.to_double(k("bid_pr"))).alias("bid_pr"),
            F.when(is_q, cells.to_long(k("bid_size"))).alias("bid_size"),
            F.when(is_q, cells.to_double(k("ask_pr"))).alias("ask_pr"),
            F.when(is_q, cells.to_long(k("ask_size"))).alias("ask_size"),
            _route(is_q, is_t, rec_type, ok=m.isNotNull()).alias("partition"),
        )
    )


def union_events(*frames: DataFrame) -> DataFrame:
    """Union-all by column name of common-event frames (no shuffle)."""
    out = frames[0].select(*schema.EVENT_COLUMNS)
    for f in frames[1:]:
        out = out.unionByName(f.select(*schema.EVENT_COLUMNS))
    return out
