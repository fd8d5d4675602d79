"""Quote analytics: last trade, moving average, previous close, price moves.

:func:`enrich_quotes` is the flagship operator.  For every quote it finds,
among the trades of the same key that precede it in
``(event_tm, event_seq_nb, trades-before-quotes)`` order, the last non-NULL
trade price and, independently, the last non-NULL 30-minute moving average;
then it attaches the previous close and the bid/ask moves against it.

Physical shape, chosen for a skewed 100 TB input:

1. trades -> per-second sums and counts (partial aggregation before the
   shuffle, so a hot instrument ships at most one row per second per map
   task) -> trailing averages put together from blocks.  An average stands in
   the timeline as a row of its own, just before the first trade of its second:
   nothing is joined back to the trades.
2. trades, averages and quotes as one timeline, filled by
   :func:`tidemark.operators.series.fill_ranges`: one exchange by key and
   range; keys with too many rows are cut into ranges.
3. the previous close, with a copy for every range of a cut key, joined by key
   and range: the quotes already lie that way, so they are not moved again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import latest, skew
from tidemark.operators.series import (
    DEFAULT_KEYS, MOVING_AVERAGE_SECONDS, fill_ranges, per_second_stats, rolling_average, timeline)
from tidemark.operators.skew import PART


def previous_close(trades: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
                   date_col: str = "trade_dt", time: str = "event_tm",
                   seq: str = "event_seq_nb", price: str = "trade_pr",
                   mode: str = "calendar",
                   next_dates: DataFrame | None = None) -> DataFrame:
    """Closing price of every key and date, labelled with the date it is
    the *previous* close of.

    The close is the price of the day's last trade by (time, seq), NULLs
    last — the trade's price even if it is NULL.  ``mode='calendar'`` labels
    it with the next calendar day; ``mode='available'`` with every later date
    up to the next date that has trades (``next_dates``: a one-column frame
    of the dates to label, default the trade dates themselves).
    Output: keys (with ``date_col``), ``close_pr``.  When ``date_col`` is
    not a key (one loaded date, as in the reference) the close carries no
    date label: it is the close of the given trades, one row per key.
    """
    last = latest.newest(trades.select(*keys, time, seq, price), keys, [time, seq])
    close = last.select(*keys, F.col(price).alias("close_pr"))
    if date_col not in keys:
        return close
    if mode == "calendar":
        return close.withColumn(date_col, F.date_add(F.col(date_col), 1))
    if mode != "available":
        raise ValueError("mode must be 'calendar' or 'available'")
    # Map each trade date to the later dates whose latest earlier trade date
    # it is.  One row per distinct date: bounded by the calendar, not by the
    # data volume, so a single small window is fine.
    tdates = trades.select(F.col(date_col).alias("_tm_d")).distinct()
    targets = (next_dates if next_dates is not None else tdates) \
        .toDF("_tm_d").distinct()
    both = (tdates.withColumn("_tm_is_trade", F.lit(1))
            .unionByName(targets.withColumn("_tm_is_trade", F.lit(0)))
            .groupBy("_tm_d").agg(F.max("_tm_is_trade").alias("_tm_is_trade")))
    w = Window.orderBy("_tm_d").rowsBetween(Window.unboundedPreceding, -1)
    prev = both.select(
        F.col("_tm_d").alias("_tm_target"),
        F.max(F.when(F.col("_tm_is_trade") == 1, F.col("_tm_d"))).over(w)
        .alias("_tm_src")).where(F.col("_tm_src").isNotNull())
    return (close.join(prev, close[date_col] == prev["_tm_src"])
            .select(*[k for k in keys if k != date_col],
                    F.col("_tm_target").alias(date_col), "close_pr")
            .select(*keys, "close_pr"))


def price_moves(df: DataFrame) -> DataFrame:
    """``bid_pr_mv = bid_pr - close_pr``, ``ask_pr_mv = ask_pr - close_pr``."""
    return df.withColumns({"bid_pr_mv": F.col("bid_pr") - F.col("close_pr"),
                           "ask_pr_mv": F.col("ask_pr") - F.col("close_pr")})


def join_close(quotes: DataFrame, close: DataFrame,
               keys: Sequence[str] = ("symbol", "exchange"), parts: int | None = None,
               outline: DataFrame | None = None) -> DataFrame:
    """Left join of the close onto quotes (one close row per key), plus moves.
    Plain equality: a NULL key has no close.  The quotes of a heavy key are
    dealt over several tasks, its close is copied to each."""
    return price_moves(skew.skewed_left_join(quotes, close, list(keys), parts, outline))


def average_rows(trades: DataFrame, keys: Sequence[str], time: str, seq: str, seconds: int) -> DataFrame:
    """A row for each key and second with trades: keys, time and sequence of
    its first trade, ``mov_avg_pr``."""
    averages = rolling_average(per_second_stats(trades, keys, time, "trade_pr", seq), keys, seconds)
    return averages.select(*keys, F.col("_tm_first.t").alias(time), F.col("_tm_first.s").alias(seq),
                           F.col("_tm_avg").alias("mov_avg_pr"))


def enrich_quotes(trades: DataFrame, quotes: DataFrame,
                  close: DataFrame | None = None,
                  keys: Sequence[str] = DEFAULT_KEYS,
                  time: str = "event_tm", seq: str = "event_seq_nb",
                  window_seconds: int = MOVING_AVERAGE_SECONDS,
                  parts: int | None = None, outline: DataFrame | None = None) -> DataFrame:
    """The quote-trade analytical table: one row per quote.

    ``trades``: keys, time, seq, ``trade_pr``; ``quotes``: keys, time, seq,
    bid/ask price and size (plus ``trade_dt`` when it is not a key);
    ``close``: keys, ``close_pr`` with one row per key (see
    :func:`previous_close`), or None for no close; ``outline``: rows with keys,
    time and seq to place cuts by (default: the trades and quotes).

    Output columns: :data:`tidemark.schema.ANALYTIC_COLUMNS`.
    """
    if "trade_dt" not in trades.columns:
        trades = trades.withColumn("trade_dt", F.lit(None).cast("date"))
    keys, none = list(keys), F.lit(None)
    averages = average_rows(trades, keys, time, seq, window_seconds).withColumn("trade_pr", none.cast("double"))
    if "trade_dt" not in keys:
        averages = averages.withColumn("trade_dt", none.cast("date"))
    # An average is seen from the first trade of its second on, as if each
    # trade of the second had it; a NULL one (no price yet) hides none.
    rows = timeline(trades.withColumn("mov_avg_pr", none.cast("double")), quotes, time=time, seq=seq).unionByName(
        timeline(averages, quotes.where("false"), time=time, seq=seq).withColumn("rec_sort", F.lit(-1)))
    if outline is None:
        outline = trades.select(*keys, time, seq).unionByName(quotes.select(*keys, time, seq))
    ranges = skew.cut_ranges(outline, keys, [time, seq], parts)
    ranges.order.append("rec_sort")
    filled = fill_ranges(rows, {"last_trade_pr": "trade_pr", "last_mov_avg_pr": "mov_avg_pr"}, ranges)
    out = filled.where(F.col("rec_type") == schema.QUOTE)
    if close is None:
        out = out.withColumn("close_pr", F.lit(None).cast("double"))
    else:
        # Plain equality of keys: a NULL one has no close.
        known = close.select(*keys, "close_pr").dropna(subset=keys)
        out = out.join(ranges.copies(known).select(PART, "close_pr"), PART, "left")
    return price_moves(out).select(*schema.ANALYTIC_COLUMNS)
