"""End-of-day job: latest run -> corrected trade and quote tables.

Trades and quotes of the latest ingest run are read with partition pruning,
projected to their columns (column pruning reaches the Parquet scan), and
reduced to the latest-arriving version of every event key.

:func:`run_eod` builds the tables from one run; :func:`merge_run` brings a later
run (corrections, late events) into tables that stand, rewriting only the dates
it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import latest
from tidemark.sources import sinks, tables


def corrected(events: DataFrame, rec_type: str, columns: Sequence[str],
              key: Sequence[str] = tuple(schema.EVENT_KEY),
              arrival_col: str = "arrival_tm",
              tiebreakers: Sequence[str] = ()) -> DataFrame:
    """Rows of one record type, latest version per key."""
    rows = events.where(F.col("partition") == rec_type).select(*columns)
    return latest.newest(rows, key, [arrival_col, *tiebreakers])


def eod_trades(events: DataFrame, tiebreakers: Sequence[str] = ()) -> DataFrame:
    return corrected(events, schema.TRADE, schema.TRADE_COLUMNS, tiebreakers=tiebreakers)


def eod_quotes(events: DataFrame, tiebreakers: Sequence[str] = ()) -> DataFrame:
    return corrected(events, schema.QUOTE, schema.QUOTE_COLUMNS, tiebreakers=tiebreakers)


def run_eod(spark: SparkSession, runs_base: str, eod_base: str,
            overwrite: str = "static",
            trade_tiebreakers: Sequence[str] = ("trade_pr",),
            quote_tiebreakers: Sequence[str] = ("bid_pr", "ask_pr", "bid_size",
                                                "ask_size")) -> str:
    """Correct the latest run and write ``<eod_base>/trade`` and
    ``<eod_base>/quote`` partitioned by ``trade_dt``.  Returns the run id.

    Tie-breakers make the winner deterministic when two versions arrive at
    the same time (pass ``()`` for the bare arrival order).
    """
    run_id = tables.latest_run_id(spark, runs_base)
    events = tables.read_run(spark, runs_base, run_id)
    sinks.write_eod(eod_trades(events, trade_tiebreakers), f"{eod_base}/trade", overwrite)
    sinks.write_eod(eod_quotes(events, quote_tiebreakers), f"{eod_base}/quote", overwrite)
    return run_id


def merged_dates(spark: SparkSession, delta: DataFrame, table: str, key: Sequence[str] = tuple(schema.EVENT_KEY),
                 arrival_col: str = "arrival_tm", tiebreakers: Sequence[str] = (),
                 date_col: str = tables.DATE_COL) -> DataFrame | None:
    """The rows that the dates of ``delta`` have in ``table`` after it: the
    latest version of every event key among both.  None for an empty ``delta``.

    Only the folders of those dates are read.  A row of ``delta`` that arrived
    before the one that stands changes nothing, so runs may come in any order
    and more than once.
    """
    # Distinct dates: bounded by the calendar.
    dates = [r[0] for r in delta.select(date_col).distinct().collect()]
    if not dates:
        return None
    known = [d for d in dates if d is not None]
    if tables.partition_values(spark, table, date_col, nulls=True):
        stands = spark.read.parquet(table)
        touched = F.col(date_col).isin(known) if known else F.lit(False)
        if None in dates:
            touched = touched | F.col(date_col).isNull()
        delta = stands.where(touched).select(*delta.columns).unionByName(delta)
    return latest.newest(delta, key, [arrival_col, *tiebreakers])


def merge_run(spark: SparkSession, runs_base: str, eod_base: str, run_id: str | None = None,
              trade_tiebreakers: Sequence[str] = ("trade_pr",),
              quote_tiebreakers: Sequence[str] = ("bid_pr", "ask_pr", "bid_size", "ask_size")) -> str:
    """Bring one run (default: the latest) into ``<eod_base>/trade`` and
    ``/quote``; equal to :func:`run_eod` over all runs merged so far together.

    Dates that the run does not touch are neither read nor written (dynamic
    overwrite).  The new files of a date take their place when the write is
    committed; after a failure before that, the run can be merged again.
    """
    run_id = run_id or tables.latest_run_id(spark, runs_base)
    events = tables.read_run(spark, runs_base, run_id)
    for name, kind, columns, ties in (("trade", schema.TRADE, schema.TRADE_COLUMNS, trade_tiebreakers),
                                      ("quote", schema.QUOTE, schema.QUOTE_COLUMNS, quote_tiebreakers)):
        delta = events.where(F.col("partition") == kind).select(*columns)
        rows = merged_dates(spark, delta, f"{eod_base}/{name}", tiebreakers=ties)
        if rows is not None:
            sinks.write_eod(rows, f"{eod_base}/{name}", overwrite="dynamic")
    return run_id
