"""Incremental end-of-day tables, row fingerprints, footers and data skipping."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schema
from tidemark.operators import quality
from tidemark.plans import eod
from tidemark.sources import scratch, sinks, tables

D = lambda n: dt.date(2020, 8, n)
AT = lambda n, h=9, s=0: dt.datetime(2020, 8, n, h, 0, s)
EVENT = ("trade_dt date, rec_type string, symbol string, exchange string, event_tm timestamp_ntz, event_seq_nb long, "
         "arrival_tm timestamp_ntz, trade_pr double, bid_pr double, bid_size long, ask_pr double, ask_size long, partition string")


def trade(day, seq, arrival, price, symbol="A"):
    return (day, "T", symbol, "X", AT(day.day, 9) if day else None, seq, arrival, price, None, None, None, None, "T")


def quote(day, seq, arrival, bid, symbol="A"):
    return (day, "Q", symbol, "X", AT(day.day, 9), seq, arrival, None, bid, 1, bid + 1, 2, "Q")


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def files(base):
    return {os.path.join(d, n) for d, _, names in os.walk(base.removeprefix("file:")) for n in names if n.endswith(".parquet")}


@pytest.fixture
def runs(spark):
    """Three runs: two dates; a correction, a late event and a row that arrived
    earlier than what stands; a new date and one without a date."""
    base = scratch.scratch_path(spark, "runs")
    data = {
        "1": [trade(D(3), 1, AT(3, 10), 1.0), trade(D(3), 2, AT(3, 10), 2.0), trade(D(4), 1, AT(4, 10), 3.0), quote(D(3), 5, AT(3, 10), 7.0)],
        "2": [trade(D(3), 1, AT(3, 12), 1.5), trade(D(3), 2, AT(3, 8), 99.0), trade(D(3), 3, AT(6, 8), 5.0)],
        "3": [trade(D(5), 1, AT(5, 10), 6.0), trade(None, 1, AT(5, 10), 8.0), trade(D(5), 1, AT(5, 10), 6.5), quote(D(5), 1, AT(5, 9), 1.0)]}
    for run_id, found in data.items():
        sinks.write_run(spark.createDataFrame(found, EVENT), base, run_id)
    whole = spark.createDataFrame([r for found in data.values() for r in found], EVENT)
    return base, whole


@pytest.mark.parametrize("order", ["123", "321", "2113", "12323"])
def test_merged_runs_equal_a_full_rebuild(spark, runs, order):
    base, whole = runs
    out = scratch.scratch_path(spark, "eod")
    for run_id in order:
        assert eod.merge_run(spark, base, out, run_id) == run_id
    trades, quotes = (spark.read.parquet(f"{out}/{n}") for n in ("trade", "quote"))
    assert rows(trades.select(*schema.TRADE_COLUMNS)) == rows(eod.eod_trades(whole, ["trade_pr"]))
    assert rows(quotes.select(*schema.QUOTE_COLUMNS)) == rows(eod.eod_quotes(whole, ["bid_pr"]))


def test_a_merge_leaves_other_dates_alone(spark, runs):
    base, _ = runs
    out = scratch.scratch_path(spark, "eod")
    for run_id in "13":
        eod.merge_run(spark, base, out, run_id)
    before = files(out)
    eod.merge_run(spark, base, out, "2")  # touches one date, has no quotes
    changed = {f.split("/trade_dt=")[1].split("/")[0] for f in before ^ files(out)}
    assert changed == {"2020-08-03"}
    assert {f for f in before if "/quote/" in f} <= files(out)


def test_an_empty_run_changes_nothing(spark, runs):
    base, whole = runs
    sinks.write_run(whole.where("false").unionByName(spark.createDataFrame([(*trade(D(3), 1, None, 1.0)[:12], "B")], EVENT)), base, "4")
    out = scratch.scratch_path(spark, "eod")
    eod.merge_run(spark, base, out, "1")
    before = files(out)
    eod.merge_run(spark, base, out, "4")
    assert files(out) == before


# --- fingerprints ---------------------------------------------------------------------

ROWS = [(1, "a", 1.5, None), (1, "a", 1.5, None), (2, None, None, D(3)), (None, "x", float("nan"), D(4)), (3, "b", 0.0, None)]
ROW = "k long, s string, v double, d date"


def reconciled(spark, a, b, by=(), row=ROW):
    return [tuple(r) for r in quality.reconcile_rows(spark.createDataFrame(a, row), spark.createDataFrame(b, row), by).collect()]


def test_fingerprints_do_not_depend_on_order(spark):
    shuffled = ROWS[:]
    random.Random(1).shuffle(shuffled)
    assert reconciled(spark, ROWS, shuffled) == [(5, 5, True, True)]
    one, two = (quality.fingerprint(spark.createDataFrame(x, ROW).repartition(n)).collect() for x, n in ((ROWS, 1), (shuffled, 4)))
    assert one == two


@pytest.mark.parametrize("damaged", [
    ROWS[1:] + [ROWS[2]],                       # one lost, another doubled
    ROWS[2:] + [ROWS[4]] * 2,                   # a pair lost, another row thrice: its xor stays
    [(2, None, None, D(3))] + ROWS[:2] + [(None, "x", float("nan"), D(4)), (3, "b", 0.5, None)],  # a value changed
    ROWS[:2] + [(2, None, None, None), (None, "x", float("nan"), D(3)), ROWS[4]],  # a value moved to another row
])
def test_fingerprints_tell_tables_apart(spark, damaged):
    assert reconciled(spark, ROWS, damaged) == [(5, 5, True, False)]


def test_nulls_in_other_columns_are_other_rows(spark):
    assert reconciled(spark, [(None, "1", None, None)], [(None, None, None, None)])[0][3] is False
    a = spark.createDataFrame([(None, 1), (1, None)], "x int, y int")
    h = [r[0] for r in a.select(quality.row_hash(a)).collect()]
    assert h[0] != h[1]
    assert reconciled(spark, [], []) == [(0, 0, True, True)]


def test_rows_are_reconciled_by_group(spark):
    moved = [(r[0], r[1], r[2], r[3]) for r in ROWS[:3]] + [(3, "x", float("nan"), D(4)), ROWS[4]]
    got = {r[0]: r[1:] for r in reconciled(spark, ROWS, moved, ["k"])}
    assert got == {1: (2, 2, True, True), 2: (1, 1, True, True), None: (1, 0, False, False), 3: (1, 2, False, False)}


# --- footers and skipping --------------------------------------------------------------

def test_counts_come_from_footers(spark):
    base = scratch.scratch_path(spark, "footers")
    df = spark.range(5000).select(F.when(F.col("id") % 7 > 0, F.date_add(F.lit(D(1)), (F.col("id") % 7).cast("int"))).alias("trade_dt"),
                                  "id", F.col("id").cast("string").alias("text"))
    sinks.write_eod(df, base)
    found = tables.footer_counts(spark, base, ["trade_dt"], ["id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id)]" in plan.replace("PushedAggregation: [COUNT(*)", "PushedAggregation: [COUNT(*)")
    assert "PushedGroupBy: [trade_dt]" in plan and "text" not in plan
    want = df.groupBy("trade_dt").agg(F.count("*"), F.min("id"), F.max("id"))
    assert rows(found) == rows(want)
    assert tables.footer_counts(spark, base).collect() == [(5000,)]
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def scanned(df):
    """Rows that the scan of a plan has read, after running it."""
    out = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return out, leaves.apply(0).metrics().apply("numOutputRows").value()


def test_lookups_skip_row_groups(spark):
    base, plain = scratch.scratch_path(spark, "clustered"), scratch.scratch_path(spark, "plain")
    n = 60_000
    df = spark.range(n).select(
        F.lit(D(3)).alias("trade_dt"), F.concat(F.lit("S"), F.pmod(F.xxhash64("id"), F.lit(200))).alias("symbol"),
        F.col("id").alias("event_seq_nb"), F.concat(F.lit("job"), F.xxhash64(F.col("id")).cast("string")).alias("job_id"))
    sinks.write_clustered(df, base, ["trade_dt"], ["symbol"], {"job_id": 3000}, files=4, row_group_bytes=64 << 10)
    sinks.write_eod(df.repartition(4), plain)
    out, read = scanned(tables.lookup_rows(spark, base, {"trade_dt": D(3), "symbol": "S17"}))
    assert len(out) == df.where("symbol = 'S17'").count() and len(out) <= read < n / 4
    wanted = df.where("event_seq_nb = 4321").first()["job_id"]
    out, read = scanned(tables.lookup_rows(spark, base, {"job_id": wanted}))  # not clustered: the Bloom filter tells
    assert [r["event_seq_nb"] for r in out] == [4321] and read < n / 4
    out, read = scanned(tables.lookup_rows(spark, plain, {"job_id": wanted}))
    assert [r["event_seq_nb"] for r in out] == [4321] and read == n
    out, read = scanned(tables.lookup_rows(spark, base, {"job_id": "none"}))
    assert out == [] and read < n / 4


def test_a_hot_date_is_written_by_several_tasks(spark):
    base = scratch.scratch_path(spark, "hot-date")
    df = spark.range(20_000).select(F.when(F.col("id") < 15_000, F.lit(D(3))).otherwise(F.lit(D(4))).alias("trade_dt"),
                                    (F.col("id") % 100).alias("k"), "id")
    sinks.write_clustered(df, base, ["trade_dt"], ["k"], files=8)
    assert sum("trade_dt=2020-08-03" in f for f in files(base)) >= 5
    assert rows(spark.read.parquet(base).select("trade_dt", "k", "id")) == rows(df)
