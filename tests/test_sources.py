"""Scans and sinks: recursive text scan, run and date tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark import schema
from tidemark.plans import eod, ingest, market_feed, quote_analytics
from tidemark.sources import scratch, sinks, tables, text


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def test_scratch_is_under_checkpoint_dir(spark):
    root = scratch.checkpoint_root(spark)
    path = scratch.scratch_path(spark, "x")
    assert path.startswith(f"{root}/tidemark/{spark.sparkContext.applicationId}/x-")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"
            getConf = staticmethod(Conf)
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError):
        scratch.checkpoint_root(Session())


def test_text_scan_recursive_glob(spark):
    ev = _events(spark)
    csv_root, json_root = market_feed.write_submissions(
        spark, ev, scratch.scratch_path(spark, "subm"))
    lines = text.read_lines(spark, csv_root)
    n_even = ev.where(F.col("event_id") % 2 == 0).count()
    n_noise = ev.where((F.col("event_id") % 2 == 1) & (F.col("event_id") % 5 == 0)).count()
    assert lines.count() == n_even + n_noise          # the .json folder is skipped
    events = ingest.parse_roots(spark, csv_root, json_root)
    assert events.count() == ev.count()                # noise lines dropped


def test_run_ingest_observes_counts(spark):
    ev = _events(spark)
    base = scratch.scratch_path(spark, "it")
    csv_root, json_root = market_feed.write_submissions(spark, ev, f"{base}/in")
    run_id, counts = ingest.run_ingest(spark, csv_root, json_root, f"{base}/runs",
                                       run_id="20240101_000000_000001")
    assert counts["rows"] == ev.count() == counts["Q"] + counts["T"] + counts["B"]
    written = tables.read_table(spark, f"{base}/runs")
    assert written.where(F.col("partition") == "T").count() == counts["T"]
    assert tables.latest_run_id(spark, f"{base}/runs") == run_id


def test_no_run_is_an_error(spark, tmp_path):
    for base in (str(tmp_path), str(tmp_path / "missing")):
        with pytest.raises(ValueError):
            tables.latest_run_id(spark, base)
        with pytest.raises(ValueError):
            tables.latest_date(spark, base)


def test_a_repeated_run_replaces_the_first(spark):
    feed = market_feed.market_events(_events(spark))
    base = scratch.scratch_path(spark, "runs")
    sinks.write_run(feed, base, "20240101_000000_000001")
    sinks.write_run(feed.where("partition = 'T'"), base, "20240101_000000_000001")
    assert {r.partition for r in tables.read_latest_run(spark, base).select("partition").distinct().collect()} == {"T"}


def test_latest_run_and_eod_overwrite_modes(spark):
    feed = market_feed.market_events(_events(spark))
    base = scratch.scratch_path(spark, "runs")
    sinks.write_run(feed.limit(10), base, "20240101_000000_000001")
    sinks.write_run(feed, base, "20240102_000000_000002")
    latest = tables.read_latest_run(spark, base)
    assert latest.count() == feed.count()
    eod_base = scratch.scratch_path(spark, "eod")
    assert eod.run_eod(spark, base, eod_base) == "20240102_000000_000002"
    trade = tables.read_table(spark, f"{eod_base}/trade")
    n_dates = trade.select("trade_dt").distinct().count()
    assert n_dates > 1
    # static overwrite of one date drops the others; dynamic keeps them
    one = trade.where(F.col("trade_dt") == tables.latest_date(spark, f"{eod_base}/trade"))
    dyn = scratch.scratch_path(spark, "dyn")
    sinks.write_eod(trade, dyn)
    sinks.write_eod(one, dyn, overwrite="dynamic")
    assert tables.read_table(spark, dyn).select("trade_dt").distinct().count() == n_dates
    sinks.write_eod(one, dyn, overwrite="static")
    assert tables.read_table(spark, dyn).select("trade_dt").distinct().count() == 1


def test_date_selection_prunes_partitions(spark):
    feed = market_feed.market_events(_events(spark))
    eod_base = scratch.scratch_path(spark, "eod")
    sinks.write_eod(eod.eod_trades(feed), f"{eod_base}/trade")
    sinks.write_eod(eod.eod_quotes(feed), f"{eod_base}/quote")
    day = tables.latest_date(spark, f"{eod_base}/trade")
    assert tables.previous_date(day) == day - dt.timedelta(days=1)
    trades, _ = tables.read_eod_date(spark, eod_base, day)
    plan = trades._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_dt" in plan
    out = quote_analytics.analytics_for_date(spark, eod_base)
    assert out.columns == schema.ANALYTIC_COLUMNS
    assert out.count() == tables.read_date(spark, f"{eod_base}/quote", day).count()
    assert tables.previous_available_date(spark, f"{eod_base}/trade") < day


def test_eod_scan_prunes_columns_and_partitions(spark):
    base = scratch.scratch_path(spark, "runs")
    sinks.write_run(market_feed.market_events(_events(spark)), base, "20240101_000000_000001")
    trades = eod.eod_trades(tables.read_run(spark, base, "20240101_000000_000001"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = trades._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [line for line in plan.split("\n") if "FileScan parquet" in line][0]
    assert "PartitionFilters: [isnotnull(partition" in scan
    read_schema = scan[scan.index("ReadSchema"):]
    assert "bid_pr" not in read_schema and "trade_pr" in read_schema


def test_null_trade_date_lands_in_default_partition(spark):
    rows = spark.createDataFrame(
        [(None, "A", 1.0), (dt.date(2024, 1, 2), "B", 2.0)],
        "trade_dt date, symbol string, trade_pr double")
    path = scratch.scratch_path(spark, "nulldt")
    sinks.write_eod(rows, path)
    back = {r.symbol: r.trade_dt for r in tables.read_table(spark, path).collect()}
    assert back == {"A": None, "B": dt.date(2024, 1, 2)}


def test_run_analytics_writes_date_folder_and_preview(spark):
    feed = market_feed.market_events(_events(spark))
    eod_base = scratch.scratch_path(spark, "eod")
    sinks.write_eod(eod.eod_trades(feed), f"{eod_base}/trade")
    sinks.write_eod(eod.eod_quotes(feed), f"{eod_base}/quote")
    out_base = scratch.scratch_path(spark, "analytics")
    out = quote_analytics.run_analytics(spark, eod_base, out_base)
    day = tables.latest_date(spark, f"{eod_base}/trade")
    written = spark.read.parquet(f"{out_base}/date={day}")
    assert written.count() == out.count() > 0
    assert set(written.columns) == set(schema.ANALYTIC_COLUMNS)
    text_schema, head = tables.preview(written, 5)
    assert text_schema.startswith("struct<symbol:string") and head.count() == 5
    # all dates at once: one date=... folder per trade date (dynamic overwrite)
    all_dates = quote_analytics.analytics_all_dates(eod.eod_trades(feed), eod.eod_quotes(feed))
    multi = scratch.scratch_path(spark, "analytics_all")
    sinks.write_analytics(all_dates, multi)
    assert (spark.read.parquet(multi).select("date").distinct().count()
            == all_dates.select("trade_dt").distinct().count())
