"""Moving average, fills and the flagship engine against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests import naive
from tidemark import schema
from tidemark.operators import analytics, series

T0 = dt.datetime(2020, 8, 5, 9, 0, 0)


def _at(h, m, s, us=0):
    return dt.datetime(2020, 8, 5, h, m, s, us)


def test_window_fixture_one_symbol(spark):
    # FIXTURES windows table.
    rows = [(_at(9, 0, 0, 100000), 1, 10.0), (_at(9, 0, 0, 900000), 2, 20.0),
            (_at(9, 30, 0, 950000), 3, 30.0), (_at(9, 30, 1), 4, None),
            (_at(10, 30, 1), 5, None)]
    trades = spark.createDataFrame(
        [(dt.date(2020, 8, 5), "SYMA", "NYSE", t, s, p) for t, s, p in rows],
        "trade_dt date, symbol string, exchange string, event_tm timestamp_ntz, "
        "event_seq_nb bigint, trade_pr double")
    got = series.moving_average(trades).orderBy("event_seq_nb").collect()
    assert [r.mov_avg_pr for r in got] == [15.0, 15.0, 20.0, 30.0, None]
    # A quote right after each trade sees the independent fills.
    quotes = spark.createDataFrame(
        [(dt.date(2020, 8, 5), "SYMA", "NYSE", t, s, 1.0, 1, 2.0, 1) for t, s, _ in rows],
        "trade_dt date, symbol string, exchange string, event_tm timestamp_ntz, "
        "event_seq_nb bigint, bid_pr double, bid_size bigint, ask_pr double, ask_size bigint")
    out = analytics.enrich_quotes(trades, quotes, None).orderBy("event_seq_nb").collect()
    assert [r.last_trade_pr for r in out] == [10.0, 20.0, 30.0, 30.0, 30.0]
    assert [r.last_mov_avg_pr for r in out] == [15.0, 15.0, 20.0, 30.0, 30.0]


def _random_market(spark, n_trades, n_quotes, seed, ts_type="timestamp_ntz"):
    rnd = random.Random(seed)
    syms = ["A", "B", None]
    def tm():
        if rnd.random() < 0.03:
            return None
        return T0 + dt.timedelta(seconds=rnd.randrange(0, 4 * 3600),
                                 microseconds=rnd.choice([0, 250000, 999999]))
    def key():
        return (rnd.choice([dt.date(2020, 8, 5), dt.date(2020, 8, 6)]),
                rnd.choice(syms), rnd.choice(["X", "Y"]))
    tr = [(*key(), tm(), rnd.randrange(0, 50), None if rnd.random() < 0.2 else
           round(rnd.uniform(1, 100), 2)) for _ in range(n_trades)]
    qu = [(*key(), tm(), rnd.randrange(0, 50), round(rnd.uniform(1, 100), 2),
           rnd.randrange(1, 9), round(rnd.uniform(1, 100), 2), rnd.randrange(1, 9))
          for _ in range(n_quotes)]
    trades = spark.createDataFrame(
        tr, f"trade_dt date, symbol string, exchange string, event_tm {ts_type}, "
            "event_seq_nb bigint, trade_pr double")
    quotes = spark.createDataFrame(
        qu, f"trade_dt date, symbol string, exchange string, event_tm {ts_type}, "
            "event_seq_nb bigint, bid_pr double, bid_size bigint, ask_pr double, "
            "ask_size bigint")
    # Unique (key, time, seq) per side, as after the end-of-day correction.
    trades = trades.dropDuplicates(["trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb"])
    quotes = quotes.dropDuplicates(["trade_dt", "symbol", "exchange", "event_tm", "event_seq_nb"])
    return trades, quotes


@pytest.mark.parametrize("seed", [1, 7, 60])
def test_moving_average_matches_brute_force(spark, seed):
    trades, _ = _random_market(spark, 600, 0, seed)
    trades = trades.cache()
    cols = [*naive.KEYS, "event_tm", "event_seq_nb", "trade_pr", "mov_avg_pr"]
    assert naive.rows(naive.dicts(series.moving_average(trades)), cols) == \
        naive.rows(naive.averages(naive.dicts(trades)), cols)


@pytest.mark.parametrize("parts", [None, 1, 5, 40])
def test_forward_fill_matches_brute_force(spark, parts):
    trades, quotes = _random_market(spark, 300, 300, seed=10)
    tl = series.timeline(series.moving_average(trades), quotes).cache()
    fills = {"last_trade_pr": "trade_pr", "last_mov_avg_pr": "mov_avg_pr"}
    got = series.forward_fill(tl, fills, naive.KEYS, parts=parts)
    cols = tl.columns + list(fills)
    assert naive.rows(naive.dicts(got), cols) == naive.rows(naive.filled(naive.dicts(tl)), cols)


@pytest.mark.parametrize("parts,ts_type", [(None, "timestamp_ntz"), (7, "timestamp"), (30, "timestamp_ntz")])
def test_enrich_quotes_matches_brute_force(spark, parts, ts_type):
    trades, quotes = (x.cache() for x in _random_market(spark, 400, 400, seed=parts or 0, ts_type=ts_type))
    close = analytics.previous_close(trades, naive.KEYS).cache()
    got = analytics.enrich_quotes(trades, quotes, close, naive.KEYS, parts=parts)
    by_key = {tuple(c[k] for k in naive.KEYS): c["close_pr"] for c in naive.dicts(close)}
    assert got.columns == schema.ANALYTIC_COLUMNS
    assert naive.rows(naive.dicts(got), schema.ANALYTIC_COLUMNS) == naive.rows(
        naive.analytics(naive.dicts(trades), naive.dicts(quotes), by_key), schema.ANALYTIC_COLUMNS)


def test_enrich_quotes_keys_of_a_single_date(spark):
    trades, quotes = _random_market(spark, 300, 300, seed=5)
    day = dt.date(2020, 8, 5)
    trades, quotes = (x.where(F.col("trade_dt") == day).cache() for x in (trades, quotes))
    keys = ["symbol", "exchange"]
    prev = trades.where(F.col("event_seq_nb") < 25)   # stands in for the previous day
    close = analytics.previous_close(prev, keys).cache()
    assert close.columns == keys + ["close_pr"]
    got = analytics.enrich_quotes(trades, quotes, close, keys, parts=6)
    by_key = {tuple(c[k] for k in keys): c["close_pr"] for c in naive.dicts(close)}
    assert naive.rows(naive.dicts(got), schema.ANALYTIC_COLUMNS) == naive.rows(
        naive.analytics(naive.dicts(trades), naive.dicts(quotes), by_key, keys), schema.ANALYTIC_COLUMNS)


def test_previous_close_modes(spark):
    d = lambda x: dt.date(2020, 8, x)
    trades = spark.createDataFrame(
        [(d(3), "A", "X", _at(9, 0, 0), 1, 1.0), (d(3), "A", "X", _at(10, 0, 0), 2, 2.0),
         (d(3), "A", "X", _at(10, 0, 0), 1, 5.0), (d(6), "A", "X", _at(9, 0, 0), 1, 3.0)],
        "trade_dt date, symbol string, exchange string, event_tm timestamp_ntz, "
        "event_seq_nb bigint, trade_pr double")
    cal = {(r.trade_dt, r.close_pr) for r in analytics.previous_close(trades).collect()}
    assert cal == {(d(4), 2.0), (d(7), 3.0)}
    quotes_dates = spark.createDataFrame([(d(4),), (d(5),), (d(6),), (d(7),)], "trade_dt date")
    avail = {(r.trade_dt, r.close_pr) for r in
             analytics.previous_close(trades, mode="available",
                                      next_dates=quotes_dates).collect()}
    assert avail == {(d(4), 2.0), (d(5), 2.0), (d(6), 2.0), (d(7), 3.0)}


def _range_sizes(spark, rows, parts):
    df = spark.createDataFrame(rows, "symbol string, event_tm timestamp_ntz, event_seq_nb long, rec_sort int")
    cut = series.range_parts(df, ["symbol"], ["event_tm", "event_seq_nb", "rec_sort"], parts)
    return [r["count"] for r in cut.groupBy(series.PART).count().collect()]


def test_a_burst_spreads_over_ranges(spark):
    # A whole key within ten seconds, and one row far away.
    rows = [("A", _at(9, 30, i % 10, i % 1000), i, 0) for i in range(20_000)] + [("A", _at(23, 50, 0), 0, 0)]
    assert max(_range_sizes(spark, rows, 20)) <= 2 * 1000


def test_one_second_and_missing_times_spread_over_ranges(spark):
    rows = [("A", _at(9, 30, 0), i, 0) for i in range(10_000)] + [("A", None, i, 0) for i in range(10_000)]
    assert max(_range_sizes(spark, rows, 20)) <= 2 * 1000


def test_sparse_keys_beside_a_hot_one_stay_whole(spark):
    rows = [("hot", _at(9, i // 600, i // 10 % 60), i, 0) for i in range(20_000)]
    rows += [(f"s{i % 500}", _at(9, i % 60, i % 59), i, 0) for i in range(5_000)]
    sizes = _range_sizes(spark, rows, 25)
    assert max(sizes) <= 2 * 1000 and len(sizes) <= 500 + 2 * 25


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_exchange_of_the_timeline_and_no_written_copy(spark):
    trades, quotes = _random_market(spark, 50, 50, seed=1)
    close = analytics.previous_close(trades)
    plan = _plan(analytics.enrich_quotes(trades, quotes, close, parts=1))
    assert plan.count("hashpartitioning(_tm_part") == 2  # the timeline, and the close that is joined where it lies
    assert "FileScan" not in plan and "rangepartitioning" not in plan
    tl = series.timeline(series.moving_average(trades, parts=1), quotes)
    plan = _plan(series.forward_fill(tl, {"last_trade_pr": "trade_pr"}, naive.KEYS, parts=1))
    assert plan.count("hashpartitioning(_tm_part") == 1 and "FileScan" not in plan


@pytest.mark.parametrize("seconds", [0, 1, 7, 60, 1800])
def test_block_averages_match_brute_force(spark, seconds):
    rnd = random.Random(seconds)
    rows = [(rnd.choice(["A", None]), T0 + dt.timedelta(seconds=rnd.choice([rnd.randrange(0, 90), rnd.randrange(0, 9000)]))
             if rnd.random() > 0.05 else None, i, None if rnd.random() < 0.2 else round(rnd.uniform(1, 100), 2))
            for i in range(500)]
    trades = spark.createDataFrame(rows, "symbol string, event_tm timestamp_ntz, event_seq_nb bigint, trade_pr double")
    got = {r.event_seq_nb: r.mov_avg_pr for r in series.moving_average(trades, ["symbol"], seconds=seconds).collect()}
    for sym, tm, i, _ in rows:
        seen = [p for s, t, _, p in rows if s == sym and p is not None and (
            t is None if tm is None else t is not None and 0 <= (tm.replace(microsecond=0) - t).total_seconds() <= seconds)]
        assert got[i] == (pytest.approx(sum(seen) / len(seen)) if seen else None)


def test_an_infinite_price_leaves_with_its_second(spark):
    rows = [("A", T0, 1, float("inf")), ("A", T0 + dt.timedelta(seconds=1800), 2, 5.0),
            ("A", T0 + dt.timedelta(seconds=1801), 3, 7.0), ("A", T0 + dt.timedelta(seconds=2000), 4, float("nan")),
            ("A", T0 + dt.timedelta(seconds=3801), 5, 9.0)]
    trades = spark.createDataFrame(rows, "symbol string, event_tm timestamp_ntz, event_seq_nb bigint, trade_pr double")
    got = [r.mov_avg_pr for r in series.moving_average(trades, ["symbol"]).orderBy("event_seq_nb").collect()]
    assert got[:3] == [float("inf"), float("inf"), 6.0] and got[3] != got[3] and got[4] == 9.0


def test_no_block_frame_is_long():
    b = series.block_seconds(1800)
    assert 1800 % b == 0 and 2 * b <= 100 and 1800 // b <= 100


@pytest.fixture
def plain_joins(spark):
    """No help from adaptive execution or broadcasts, and more tasks."""
    wanted = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _task_sizes(df):
    sizes = sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
    return sizes[-1], sizes[len(sizes) // 2]


def test_a_second_with_a_third_of_the_trades_is_split(spark, plain_joins):
    rows = [("A", T0, i, 1.0) for i in range(10_000)] + [("A", T0 + dt.timedelta(seconds=i), i, 2.0) for i in range(1, 20_000)]
    trades = spark.createDataFrame(rows, "symbol string, event_tm timestamp_ntz, event_seq_nb bigint, trade_pr double")
    out = series.moving_average(trades, ["symbol"], seconds=0)
    assert out.columns == trades.columns + ["mov_avg_pr"]
    most, median = _task_sizes(out)
    assert most <= 2 * median
    assert out.groupBy("mov_avg_pr").count().orderBy("mov_avg_pr").collect() == [(1.0, 10_000), (2.0, 19_999)]


def test_a_symbol_with_a_third_of_the_quotes_is_split(spark, plain_joins):
    quotes = spark.createDataFrame(
        [("HOT", "X", i, 2.0, 3.0) for i in range(10_000)] + [(None, "X", i, 2.0, 3.0) for i in range(5_000)]
        + [(f"S{i % 900}", "X", i, 2.0, 3.0) for i in range(15_000)],
        "symbol string, exchange string, event_seq_nb bigint, bid_pr double, ask_pr double")
    close = spark.createDataFrame([("HOT", "X", 1.0), (None, "X", 9.0)] + [(f"S{i}", "X", 2.0) for i in range(0, 900, 2)],
                                  "symbol string, exchange string, close_pr double")
    out = analytics.join_close(quotes, close)
    assert out.columns == ["symbol", "exchange", "event_seq_nb", "bid_pr", "ask_pr", "close_pr", "bid_pr_mv", "ask_pr_mv"]
    most, median = _task_sizes(out)
    assert most <= 2 * median
    got = {(r.symbol if r.symbol in ("HOT", None) else int(r.symbol[1:]) % 2, r.close_pr): r["count"]
           for r in out.withColumn("symbol", F.when(F.col("symbol").startswith("S"), F.concat(
               F.lit("S"), F.substring("symbol", 2, 9).cast("int") % 2)).otherwise(F.col("symbol")))
           .groupBy("symbol", "close_pr").count().collect()}
    odd = sum(1 for i in range(15_000) if (i % 900) % 2)
    assert got == {("HOT", 1.0): 10_000, (None, None): 5_000, (1, None): odd, (0, 2.0): 15_000 - odd}


def test_enriched_quotes_of_a_hot_key_are_cut_and_right(spark, plain_joins):
    trades, quotes = (x.cache() for x in _random_market(spark, 500, 500, seed=21))
    hot = quotes.withColumns({"symbol": F.lit("A"), "exchange": F.lit("X"), "trade_dt": F.lit(dt.date(2020, 8, 5)),
                              "event_seq_nb": F.col("event_seq_nb") + 100 + F.monotonically_increasing_id()})
    quotes = quotes.unionByName(hot).cache()
    close = analytics.previous_close(trades, naive.KEYS).cache()
    got = analytics.enrich_quotes(trades, quotes, close, naive.KEYS)
    by_key = {tuple(c[k] for k in naive.KEYS): c["close_pr"] for c in naive.dicts(close)}
    assert naive.rows(naive.dicts(got), schema.ANALYTIC_COLUMNS) == naive.rows(
        naive.analytics(naive.dicts(trades), naive.dicts(quotes), by_key), schema.ANALYTIC_COLUMNS)


def test_an_outline_changes_nothing_but_the_cuts(spark):
    trades, quotes = (x.cache() for x in _random_market(spark, 300, 300, seed=4))
    plain = analytics.enrich_quotes(trades, quotes, None, naive.KEYS, parts=9)
    other = analytics.enrich_quotes(trades, quotes, None, naive.KEYS, parts=9,
                                    outline=quotes.where("symbol = 'A'").select(*naive.KEYS, "event_tm", "event_seq_nb"))
    cols = schema.ANALYTIC_COLUMNS
    assert naive.rows(naive.dicts(plain), cols) == naive.rows(naive.dicts(other), cols)
