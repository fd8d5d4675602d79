"""Time-series operators on per-instrument event streams.

Scale design (a hot instrument may hold a third of all rows):

* The trailing moving average is computed on a per-second pre-aggregate (sum
  and count of prices per key and second, combined map-side): all rows of one
  second are peers in a whole-second RANGE frame.  Seconds are grouped in
  blocks, and a frame is put together from its own block, whole blocks between,
  and the edge of its first block (:func:`rolling_average`), so no frame has
  more than some 90 rows, and a key-day is spread by block.
* Forward fills never put a whole key into one task.  Keys with too many rows
  are cut into ranges (:class:`tidemark.operators.skew.Ranges`); the range is a
  column, so one exchange by key and range does, and a small table with a row
  for each range of a cut key supplies the value carried in.
* Join keys are packed into one struct column: struct equality treats NULL
  fields as equal, which reproduces window grouping of NULL keys (a plain
  equi-join would drop them).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timecols import epoch_seconds
from tidemark.operators import skew
from tidemark.operators.skew import PART, Ranges

# Defaults of the reference workload.
DEFAULT_KEYS = ("trade_dt", "symbol", "exchange")
MOVING_AVERAGE_SECONDS = 1800
SEC = "_tm_sec"


def per_second_stats(trades: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
                     time: str = "event_tm", price: str = "trade_pr", seq: str | None = None) -> DataFrame:
    """One row per (key, whole second) with trades: keys, ``_tm_sec``, and
    ``_tm_sum`` / ``_tm_cnt``, sum and count of the non-NULL prices; with
    ``seq`` also ``_tm_first``, time and sequence of the first trade."""
    first = [F.min(F.struct(F.col(time).alias("t"), F.col(seq).alias("s"))).alias("_tm_first")] if seq else []
    return (trades.select(*keys, price, *([time, seq] if seq else []), epoch_seconds(trades, time).alias(SEC))
            .groupBy(*keys, SEC)
            .agg(F.sum(price).alias("_tm_sum"), F.count(price).alias("_tm_cnt"), *first))


def block_seconds(seconds: int) -> int:
    """The divisor of ``seconds`` nearest to its root."""
    root = math.sqrt(max(seconds, 1))
    divisors = {d for i in range(1, math.isqrt(max(seconds, 1)) + 1) if seconds % i == 0 for d in (i, max(seconds, 1) // i)}
    return min(divisors, key=lambda d: (abs(d - root), d))


def rolling_average(stats: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
                    seconds: int = MOVING_AVERAGE_SECONDS,
                    out: str = "_tm_avg") -> DataFrame:
    """Add the trailing average over seconds ``[s - seconds, s]`` to
    :func:`per_second_stats` rows (NULL when that span has no price).

    Seconds are dealt into blocks whose length divides ``seconds``.  What a
    second sees is: its own block up to itself; all of the blocks between; and
    of the block ``seconds`` earlier the seconds from ``s - seconds`` on.  Those
    last are copied ``seconds`` ahead, so that they meet the rows that see
    them in one block.  Sums never leave a block and are never subtracted, so
    an infinite price leaves with its second.
    """
    block, own, at = "_tm_block", "_tm_own", "_tm_at"
    names = ("_tm_sum", "_tm_cnt")
    b = block_seconds(seconds)
    rows = [F.struct(F.lit(True).alias(own), F.col(SEC).alias(at))]
    if seconds:
        rows.append(F.struct(F.lit(False).alias(own), (F.col(SEC) + seconds).alias(at)))
    rest = [c for c in stats.columns if c not in (*keys, SEC)]
    # Seconds without a time have peers only.
    seen = (stats.select(*keys, SEC, *rest, F.explode(F.array(*rows)).alias("_tm_row"))
            .select(*keys, SEC, *rest, f"_tm_row.{own}", f"_tm_row.{at}")
            .where(F.col(own) | F.col(at).isNotNull())
            .withColumn(block, F.floor(F.col(at) / b)))
    w = Window.partitionBy(*keys, block).orderBy(at)
    head, tail = w.rangeBetween(Window.unboundedPreceding, 0), w.rangeBetween(0, Window.unboundedFollowing)
    mine = lambda c: F.sum(F.when(F.col(own), F.col(c))).over(head)
    early = lambda c: F.sum(F.when(~F.col(own), F.col(c))).over(tail)
    edges = seen.select("*", *[f(c).alias(f"{c}_{n}") for c in names for f, n in ((mine, "head"), (early, "tail"))]).where(own)
    parts = ["head", "tail"]
    if seconds // b > 1:
        parts.append("mid")
        blocks = stats.withColumn(block, F.floor(F.col(SEC) / b)).groupBy(*keys, block).agg(*[F.sum(c).alias(c) for c in names])
        # A block is seen by the ones after it, whether they hold a trade before it or not.
        between = Window.partitionBy(*keys).orderBy(block).rangeBetween(1 - seconds // b, -1)
        mid = blocks.select(F.struct(*keys, block).alias("_tm_key"), *[
            F.when(F.col(block).isNotNull(), F.sum(c).over(between)).alias(f"{c}_mid") for c in names])
        edges = edges.withColumn("_tm_key", F.struct(*keys, block)).join(mid, "_tm_key", "left")
    total, count = [sum((F.coalesce(f"{c}_{n}", F.lit(0)) for n in parts), F.lit(0)) for c in names]
    return edges.select(*stats.columns, F.when(count > 0, total / count).alias(out))


def moving_average(trades: DataFrame, keys: Sequence[str] = DEFAULT_KEYS,
                   time: str = "event_tm", price: str = "trade_pr",
                   seconds: int = MOVING_AVERAGE_SECONDS, out: str = "mov_avg_pr",
                   parts: int | None = None, outline: DataFrame | None = None) -> DataFrame:
    """Trailing moving average of ``price`` per key over the last ``seconds``.

    Time is truncated to whole seconds, so all trades of one second see each
    other (also later ones) and the window reaches back to the start of
    second ``s - seconds``.  NULL prices are skipped.  The averages are joined
    to the trades with the trades of a heavy second dealt over several tasks
    (``outline``: rows to find heavy seconds in, default the trades).
    """
    avg = rolling_average(per_second_stats(trades, keys, time, price), keys, seconds)
    gs = "_tm_gs"
    second = lambda df: F.struct(*[F.col(k) for k in keys], epoch_seconds(df, time).alias(SEC)).alias(gs)
    right = avg.select(F.struct(*keys, SEC).alias(gs), F.col("_tm_avg").alias(out))
    seen = (outline if outline is not None else trades)
    return skew.skewed_left_join(trades.select("*", second(trades)), right, [gs], parts, seen.select(second(seen))).drop(gs)


# The timeline's columns: type, and where trades and quotes take them from
# (None: not theirs, so NULL).
TIMELINE = (
    ("rec_type", "string", "'T'", "'Q'"),
    ("rec_sort", "int", "0", "1"),
    ("symbol", None, "symbol", "symbol"),
    ("exchange", None, "exchange", "exchange"),
    ("trade_pr", "double", "trade_pr", None),
    ("mov_avg_pr", "double", "mov_avg_pr", None),
    ("bid_pr", "double", None, "bid_pr"),
    ("bid_size", "bigint", None, "bid_size"),
    ("ask_pr", "double", None, "ask_pr"),
    ("ask_size", "bigint", None, "ask_size"),
)


def timeline(trades: DataFrame, quotes: DataFrame,
             date_col: str = "trade_dt", time: str = "event_tm",
             seq: str = "event_seq_nb") -> DataFrame:
    """Union of trades (with ``mov_avg_pr``) and quotes in one layout.

    Trades get ``rec_type='T'``, ``rec_sort=0`` and NULL quote columns;
    quotes get ``rec_type='Q'``, ``rec_sort=1`` and NULL trade columns.
    """
    time_type = trades.schema[time].dataType.simpleString()
    layout = ((date_col, None, date_col, date_col), (time, time_type, time, time),
              (seq, None, seq, seq), *TIMELINE)

    def side(df: DataFrame, source: int) -> DataFrame:
        return df.selectExpr(*[
            (f"cast({row[source] or 'null'} as {row[1]})" if row[1] else row[source]) + f" as `{row[0]}`"
            for row in layout])

    return side(trades, 2).unionByName(side(quotes, 3))


def range_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                parts: int | None = None) -> DataFrame:
    """``df`` with the column ``_tm_part``: a struct of the keys and the number
    of the row's range.  A burst, one dense second or rows without a time (they
    order first) spread over as many ranges as they fill, and keys that no
    more than a ``parts``-th of the rows have stay whole."""
    return skew.cut_ranges(df, keys, order, parts).of(df)


def fill_ranges(df: DataFrame, fills: Mapping[str, str], ranges: Ranges) -> DataFrame:
    """:func:`forward_fill` over given ranges; keeps ``_tm_part``."""
    keys, order = ranges.keys, ranges.order
    d = ranges.of(df)
    w = (Window.partitionBy(PART).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = d.select("*", *[F.last(src, ignorenulls=True).over(w).alias(f"_tm_loc_{o}") for o, src in fills.items()])
    if not ranges.cuts:
        return local.select(*df.columns, PART, *[F.col(f"_tm_loc_{o}").alias(o) for o in fills])
    # Values carried in, only of the keys that were cut: a row for each range.
    ends = d.where(ranges.heavy()).groupBy(PART).agg(*[
        F.max(F.when(F.col(src).isNotNull(), F.struct(*order, F.col(src).alias("v"))))
        .alias(f"_tm_end_{o}") for o, src in fills.items()])
    wb = (Window.partitionBy(*[F.col(PART)[k] for k in keys]).orderBy(F.col(PART)["_tm_range"])
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = ends.select(PART, *[F.last(F.col(f"_tm_end_{o}")["v"], ignorenulls=True).over(wb)
                                .alias(f"_tm_carry_{o}") for o in fills])  # a row for each range
    return local.join(F.broadcast(carry), PART, "left").select(
        *df.columns, PART, *[F.coalesce(f"_tm_loc_{o}", f"_tm_carry_{o}").alias(o) for o in fills])


def forward_fill(df: DataFrame, fills: Mapping[str, str],
                 keys: Sequence[str] = DEFAULT_KEYS,
                 order: Sequence[str] = ("event_tm", "event_seq_nb", "rec_sort"),
                 parts: int | None = None, outline: DataFrame | None = None) -> DataFrame:
    """For every row, the last non-NULL value of each source column among
    the rows of its key up to and including itself (``order`` ascending,
    NULLs first).  ``fills`` maps output name -> source column.

    One exchange, by key and range; ``outline``: rows to place the cuts by
    (see :mod:`tidemark.operators.skew`), default ``df``.
    """
    ranges = skew.cut_ranges(outline if outline is not None else df, keys, order, parts)
    return fill_ranges(df, fills, ranges).drop(PART)
