"""Registered queries: one per operator family, over the driver's tables.

Every query reads ``events`` (the only table with a time stream) through the
fixed market-data mapping of :mod:`tidemark.plans.market_feed`, over the
whole table.  Queries that exercise sinks and scans write to a fresh folder
below the session's shared checkpoint folder and read it back.

Times stay ``timestamp_ntz`` so that results do not depend on the session
time zone; moving averages are rounded to 6 decimals for comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import analytics, latest, parse, quality, series
from tidemark.plans import eod, ingest, market_feed, quote_analytics
from tidemark.sources import scratch, sinks, tables, text

Query = Callable[[SparkSession, str], DataFrame]

# Fixed run ids of the run-table checks (older, newer).
RUN_OLD, RUN_NEW = "20240101_000000_000001", "20240102_000000_000002"
# Job looked up by the job-status lookup check.
LOOKUP_JOB = "error_2024-01-15"
TOP_N = 20
# Instrument looked up by the clustered-table check.
LOOKUP_SYMBOL, LOOKUP_EXCHANGE = "S1", "NYSE"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/events.parquet")


def _feed(spark: SparkSession, d: str, corrections: bool = True) -> DataFrame:
    return market_feed.market_events(_events(spark, d), corrections)


def _trades(spark: SparkSession, d: str, feed: DataFrame | None = None) -> DataFrame:
    return eod.eod_trades(feed if feed is not None else _feed(spark, d), ["trade_pr"])


def _quotes(spark: SparkSession, d: str, feed: DataFrame | None = None) -> DataFrame:
    return eod.eod_quotes(feed if feed is not None else _feed(spark, d), ["bid_pr"])


def _eod_pair(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Corrected trades and quotes built on one feed DataFrame."""
    feed = _feed(spark, d)
    return _trades(spark, d, feed), _quotes(spark, d, feed)


def _round(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _submission_roots(spark: SparkSession, d: str) -> tuple[str, str]:
    root = scratch.scratch_path(spark, "submissions")
    return market_feed.write_submissions(spark, _events(spark, d), root)


# --- parsing and ingest -------------------------------------------------

def csv_parse_events(spark, d):
    return parse.parse_csv_lines(market_feed.csv_lines(_events(spark, d)), ntz=True)


def json_parse_events(spark, d):
    return parse.parse_json_lines(market_feed.json_lines(_events(spark, d)), ntz=True)


def ingest_union(spark, d):
    csv_root, json_root = _submission_roots(spark, d)
    return ingest.parse_roots(spark, csv_root, json_root, ntz=True)


def ingest_partition_counts(spark, d):
    return quality.counts_by(ingest_union(spark, d), "partition", name="n_rows")


def bad_record_routing(spark, d):
    ev = _events(spark, d)
    both = parse.union_events(
        parse.parse_csv_lines(market_feed.csv_lines(ev), ntz=True),
        parse.parse_json_lines(market_feed.json_lines(ev), ntz=True))
    return both.where(F.col("partition") == schema.BAD)


def _wall_clock(df: DataFrame) -> DataFrame:
    """Session-zone timestamps as the wall clock they show, so that results
    do not depend on the session time zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("event_tm", "arrival_tm")})


def csv_parse_timestamps(spark, d):
    return _wall_clock(parse.parse_csv_lines(market_feed.csv_lines(_events(spark, d))))


def json_parse_timestamps(spark, d):
    return _wall_clock(parse.parse_json_lines(market_feed.json_lines(_events(spark, d))))


def text_scan(spark, d):
    # Every line of both roots, by root and format.
    csv_root, json_root = _submission_roots(spark, d)
    lines = (text.read_lines(spark, csv_root).withColumn("root", F.lit("csv"))
             .unionByName(text.read_lines(spark, json_root).withColumn("root", F.lit("json"))))
    return lines.groupBy("root", F.col("value").startswith("{").alias("is_json")).agg(
        F.count(F.lit(1)).alias("n_lines"))


def ingest_job(spark, d):
    """The whole job through its sink: rows written, rows observed."""
    base = scratch.scratch_path(spark, "ingest-job")
    run_id, seen = ingest.run_ingest(spark, *_submission_roots(spark, d), base, RUN_NEW, ntz=True)
    written = quality.counts_by(tables.read_run(spark, base, run_id), "partition", name="n_written")
    observed = F.create_map(*[F.lit(x) for p in (schema.QUOTE, schema.TRADE, schema.BAD)
                              for x in (p, int(seen[p] or 0))])
    return written.withColumn("n_observed", observed[F.col("partition")].cast("bigint"))


# --- run tables and end-of-day ---------------------------------------------

def _write_runs(spark, d) -> str:
    base = scratch.scratch_path(spark, "runs")
    sinks.write_run(_feed(spark, d, corrections=False), base, RUN_OLD)
    sinks.write_run(_feed(spark, d), base, RUN_NEW)
    return base


def parquet_partition_roundtrip(spark, d):
    base = scratch.scratch_path(spark, "run")
    sinks.write_run(_feed(spark, d), base, RUN_NEW)
    return tables.read_partition(spark, base, run_id=RUN_NEW, partition=schema.TRADE)


def retried_run(spark, d):
    # The first try also wrote bad records; the second replaces the run.
    base = scratch.scratch_path(spark, "retried")
    sinks.write_run(_feed(spark, d, corrections=False), base, RUN_OLD)
    sinks.write_run(_feed(spark, d), base, RUN_NEW)
    sinks.write_run(_feed(spark, d).where(F.col("partition") != schema.BAD), base, RUN_NEW)
    return quality.counts_by(tables.read_table(spark, base), "run_id", "partition", name="n_rows")


def latest_run(spark, d):
    return tables.read_latest_run(spark, _write_runs(spark, d)).withColumn("run_id", F.lit(RUN_NEW))


def _write_eod(spark, d) -> str:
    runs = _write_runs(spark, d)
    eod_base = scratch.scratch_path(spark, "eod")
    eod.run_eod(spark, runs, eod_base)
    return eod_base


def latest_trade_date(spark, d):
    base = f"{_write_eod(spark, d)}/trade"
    rows = tables.read_date(spark, base, tables.latest_date(spark, base))
    return rows.agg(F.max("trade_dt").alias("latest_dt")).withColumn(
        "previous_dt", F.date_sub("latest_dt", 1))


def previous_trade_date(spark, d):
    base = f"{_write_eod(spark, d)}/trade"
    rows = tables.read_date(spark, base, tables.previous_available_date(spark, base))
    return rows.agg(F.max("trade_dt").alias("previous_dt"))


def eod_trades_latest(spark, d):
    return _trades(spark, d)


def eod_quotes_latest(spark, d):
    return _quotes(spark, d)


def latest_with_tiebreaker(spark, d):
    # Latest event of every symbol, exchange and day: hot keys (six per day).
    return latest.newest(_feed(spark, d), ["trade_dt", "symbol", "exchange"],
                         ["arrival_tm", "event_seq_nb", "rec_type"])


def eod_counts_by_date(spark, d):
    base = _write_eod(spark, d)
    t = quality.counts_by(tables.read_table(spark, f"{base}/trade"), "trade_dt", name="n_rows")
    q = quality.counts_by(tables.read_table(spark, f"{base}/quote"), "trade_dt", name="n_rows")
    return (t.withColumn("table_name", F.lit("trade"))
            .unionByName(q.withColumn("table_name", F.lit("quote"))))


def eod_incremental(spark, d):
    """Runs brought in one by one: late corrections before what they correct,
    and once more after it."""
    runs, base = scratch.scratch_path(spark, "delta-runs"), scratch.scratch_path(spark, "merged-eod")
    late = F.col("arrival_tm") > F.col("event_tm")
    sinks.write_run(_feed(spark, d, corrections=False), runs, RUN_OLD)
    sinks.write_run(_feed(spark, d).where(late), runs, RUN_NEW)
    for run_id in (RUN_NEW, RUN_OLD, RUN_NEW):
        eod.merge_run(spark, runs, base, run_id)
    trades, quotes = (tables.read_table(spark, f"{base}/{n}") for n in ("trade", "quote"))
    return trades.withColumn("rec_type", F.lit(schema.TRADE)).unionByName(
        quotes.withColumn("rec_type", F.lit(schema.QUOTE)), allowMissingColumns=True)


def eod_footer_counts(spark, d):
    base = _write_eod(spark, d)
    t, q = (tables.footer_counts(spark, f"{base}/{n}", ["trade_dt"], ["event_seq_nb"]) for n in ("trade", "quote"))
    return t.withColumn("table_name", F.lit("trade")).unionByName(q.withColumn("table_name", F.lit("quote")))


def clustered_lookup(spark, d):
    """One instrument's trades out of a clustered table."""
    base = scratch.scratch_path(spark, "clustered")
    sinks.write_clustered(_trades(spark, d), base, ["trade_dt"], ["symbol", "exchange", "event_tm"], {"event_seq_nb": 10_000})
    return tables.lookup_rows(spark, base, {"symbol": LOOKUP_SYMBOL, "exchange": LOOKUP_EXCHANGE})


def correction_counts(spark, d):
    feed = _feed(spark, d)
    trades, quotes = _trades(spark, d, feed), _quotes(spark, d, feed)
    before = feed.where(F.col("partition") != schema.BAD) \
        .select(F.col("partition").alias("rec_type"))
    after = (trades.select(F.lit(schema.TRADE).alias("rec_type"))
             .unionByName(quotes.select(F.lit(schema.QUOTE).alias("rec_type"))))
    return quality.before_after_counts(before, after, "rec_type")


# --- time series and analytics ----------------------------------------------

def trade_moving_average(spark, d):
    feed = _feed(spark, d)
    return _round(series.moving_average(_trades(spark, d, feed), outline=feed.where(F.col("partition") == schema.TRADE)),
                  "mov_avg_pr")


def previous_close(spark, d):
    return analytics.previous_close(_trades(spark, d))


def previous_close_available(spark, d):
    tr, qu = _eod_pair(spark, d)
    return analytics.previous_close(tr, mode="available", next_dates=qu.select("trade_dt"))


def close_join(spark, d):
    # J1 as a standalone join: quotes of every date with the previous close.
    feed = _feed(spark, d)
    tr, qu = _trades(spark, d, feed), _quotes(spark, d, feed)
    return analytics.join_close(qu, analytics.previous_close(tr), ["trade_dt", "symbol", "exchange"],
                                outline=feed.where(F.col("partition") == schema.QUOTE))


def _timeline(spark, d):
    """The timeline, and the uncorrected rows it comes from as its outline."""
    feed = _feed(spark, d)
    tr, qu = _trades(spark, d, feed), _quotes(spark, d, feed)
    averaged = series.moving_average(tr, outline=feed.where(F.col("partition") == schema.TRADE))
    return series.timeline(averaged, qu), feed.where(F.col("partition") != schema.BAD)


def event_timeline(spark, d):
    return _round(_timeline(spark, d)[0], "mov_avg_pr")


def forward_fill_quotes(spark, d):
    rows, outline = _timeline(spark, d)
    filled = series.forward_fill(
        rows, {"last_trade_pr": "trade_pr", "last_mov_avg_pr": "mov_avg_pr"}, outline=outline)
    return _round(filled.where(F.col("rec_type") == schema.QUOTE),
                  "mov_avg_pr", "last_mov_avg_pr")


def _analytics(spark, d):
    feed = _feed(spark, d)
    return quote_analytics.analytics_all_dates(_trades(spark, d, feed), _quotes(spark, d, feed),
                                               outline=feed.where(F.col("partition") != schema.BAD))


def quote_trade_analytics(spark, d):
    return _round(_analytics(spark, d), "mov_avg_pr", "last_mov_avg_pr")


def latest_date_analytics(spark, d):
    out = quote_analytics.analytics_for_date(spark, _write_eod(spark, d))
    return _round(out, "mov_avg_pr", "last_mov_avg_pr")


def analytics_job(spark, d):
    """The job through its sink, read back from the date's folder."""
    base, out = _write_eod(spark, d), scratch.scratch_path(spark, "analytics")
    quote_analytics.run_analytics(spark, base, out)
    return _round(tables.read_table(spark, out).drop("date"), "mov_avg_pr", "last_mov_avg_pr")


def string_time_analytics(spark, d):
    """End-of-day tables whose times are text, as other writers leave them."""
    base = scratch.scratch_path(spark, "text-times")
    for name, rows in zip(("trade", "quote"), _eod_pair(spark, d), strict=True):
        sinks.write_eod(rows.withColumn("event_tm", F.col("event_tm").cast("string")), f"{base}/{name}")
    out = quote_analytics.analytics_for_date(spark, base)
    return _round(out.withColumn("event_tm", F.col("event_tm").cast("timestamp_ntz")),
                  "mov_avg_pr", "last_mov_avg_pr")


def quote_row_reconciliation(spark, d):
    """Rows, not only counts: the analytics against their quotes, and quotes of
    which each date has lost its first row and doubled its last."""
    feed = _feed(spark, d)
    quotes = _quotes(spark, d, feed).drop("arrival_tm")
    enriched = quote_analytics.analytics_all_dates(
        _trades(spark, d, feed), quotes, outline=feed.where(F.col("partition") != schema.BAD)).select(*quotes.columns)
    row = F.struct("event_tm", "event_seq_nb", "symbol", "exchange")
    ends = quotes.groupBy("trade_dt").agg(F.min(row).alias("least"), F.max(row).alias("most"))
    times = F.when(row == F.col("least"), 0).otherwise(1) + F.when(row == F.col("most"), 1).otherwise(0)
    damaged = (quotes.join(ends, "trade_dt").withColumn("again", F.explode(F.array_repeat(F.lit(1), times)))
               .select(*quotes.columns))
    return quality.reconcile_rows(quotes, enriched, ["trade_dt"]).withColumn("table_name", F.lit("enriched")).unionByName(
        quality.reconcile_rows(quotes, damaged, ["trade_dt"]).withColumn("table_name", F.lit("damaged")))


def quote_reconciliation(spark, d):
    tr, qu = _eod_pair(spark, d)
    return quality.reconcile(qu, quote_analytics.analytics_all_dates(tr, qu))


def null_fill_count(spark, d):
    return quality.null_count(_analytics(spark, d), "last_trade_pr")


def top_quotes(spark, d):
    return _round(quality.top_rows(_analytics(spark, d),
                                   ["symbol", "event_tm", "exchange", "event_seq_nb"], TOP_N),
                  "mov_avg_pr", "last_mov_avg_pr")


# --- job status -------------------------------------------------------------

def _jobs(spark, d) -> tuple[DataFrame, DataFrame]:
    ev = _events(spark, d).withColumn("day", F.col("ts").cast("date"))
    current = (ev.groupBy("event_type", "day").agg(F.max("ts").alias("t"))
               .select(*latest.job_status_rows(latest.daily_job_id("event_type", "day"),
                                               F.lit("success"), F.col("t"))))
    errors = (ev.where(F.col("event_type") == "error").groupBy("day")
              .agg(F.min("ts").alias("t"))
              .select(*latest.job_status_rows(latest.daily_job_id(F.lit("error"), "day"),
                                              F.lit("retried"), F.col("t"))))
    audits = (ev.groupBy("day").agg(F.max("ts").alias("t"))
              .select(*latest.job_status_rows(latest.daily_job_id(F.lit("audit"), "day"),
                                              F.lit("success"), F.col("t"))))
    return current, errors.unionByName(audits)


def job_status_upsert(spark, d):
    current, updates = _jobs(spark, d)
    return latest.upsert_latest(current, updates)


def job_status_lookup(spark, d):
    return latest.lookup(job_status_upsert(spark, d), "job_id", LOOKUP_JOB)


QUERIES: dict[str, Query] = {
    "csv_parse_events": csv_parse_events,
    "json_parse_events": json_parse_events,
    "ingest_union": ingest_union,
    "ingest_partition_counts": ingest_partition_counts,
    "bad_record_routing": bad_record_routing,
    "csv_parse_timestamps": csv_parse_timestamps,
    "json_parse_timestamps": json_parse_timestamps,
    "text_scan": text_scan,
    "ingest_job": ingest_job,
    "retried_run": retried_run,
    "analytics_job": analytics_job,
    "string_time_analytics": string_time_analytics,
    "parquet_partition_roundtrip": parquet_partition_roundtrip,
    "latest_run": latest_run,
    "latest_trade_date": latest_trade_date,
    "previous_trade_date": previous_trade_date,
    "eod_trades_latest": eod_trades_latest,
    "eod_quotes_latest": eod_quotes_latest,
    "latest_with_tiebreaker": latest_with_tiebreaker,
    "eod_counts_by_date": eod_counts_by_date,
    "eod_incremental": eod_incremental,
    "eod_footer_counts": eod_footer_counts,
    "clustered_lookup": clustered_lookup,
    "correction_counts": correction_counts,
    "trade_moving_average": trade_moving_average,
    "previous_close": previous_close,
    "previous_close_available": previous_close_available,
    "close_join": close_join,
    "event_timeline": event_timeline,
    "forward_fill_quotes": forward_fill_quotes,
    "quote_trade_analytics": quote_trade_analytics,
    "latest_date_analytics": latest_date_analytics,
    "quote_reconciliation": quote_reconciliation,
    "quote_row_reconciliation": quote_row_reconciliation,
    "null_fill_count": null_fill_count,
    "top_quotes": top_quotes,
    "job_status_upsert": job_status_upsert,
    "job_status_lookup": job_status_lookup,
}
