"""Latest version per key, upsert and lookup."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import latest


def test_newest_null_arrival(spark):
    df = spark.createDataFrame(
        [(1, None, "a"), (1, 2020, "b"), (1, 2021, "c"), (2, None, "z")],
        "k int, arrival int, v string")
    got = {r.k: r.v for r in latest.newest(df, ["k"], ["arrival"]).collect()}
    assert got == {1: "c", 2: "z"}


def test_newest_tiebreaker_and_null_key_group(spark):
    df = spark.createDataFrame(
        [(None, 5, 1.0), (None, 5, 3.0), (None, 4, 9.0), ("a", 1, 2.0)],
        "k string, arrival int, p double")
    got = sorted((r.k or "", r.p) for r in
                 latest.newest(df, ["k"], ["arrival", "p"]).collect())
    assert got == [("", 3.0), ("a", 2.0)]


def test_newest_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest.newest(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_upsert_newer_write_wins(spark):
    cur = spark.createDataFrame(
        [("j_2024-01-01", "failed", dt.datetime(2024, 1, 1, 10)),
         ("j_2024-01-02", "success", dt.datetime(2024, 1, 2, 10))],
        "job_id string, status string, updated_time timestamp")
    upd = spark.createDataFrame(
        [("j_2024-01-01", "success", dt.datetime(2024, 1, 1, 9)),
         ("j_2024-01-03", "running", dt.datetime(2024, 1, 3, 9))],
        "job_id string, status string, updated_time timestamp")
    got = {r.job_id: r.status for r in latest.upsert_latest(cur, upd).collect()}
    assert got == {"j_2024-01-01": "success", "j_2024-01-02": "success",
                   "j_2024-01-03": "running"}
    assert latest.lookup(latest.upsert_latest(cur, upd), "job_id", "nope").count() == 0


def test_daily_job_id(spark):
    df = spark.createDataFrame([("nightly_load", dt.date(2024, 1, 5))], "n string, d date")
    assert df.select(latest.daily_job_id("n", "d")).first()[0] == "nightly_load_2024-01-05"
