"""Tolerant cell parsing (ANSI on): bad text -> NULL, never an error."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tidemark.functions import cells


def _one(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_to_long(spark):
    vals = ["100.0", "-3.9", " 7 ", ".5", "5.", "1e3", "5d", "NaN", "abc", "",
            "9223372036854775808", "9223372036854775807", None]
    got = _one(spark, vals, cells.to_long)
    assert got == [100, -3, 7, 0, 5, None, None, None, None, None, None,
                   9223372036854775807, None]


def test_to_double(spark):
    got = _one(spark, ["1e3", "NaN", "5d", "abc", "", "75.30"], cells.to_double)
    assert got[0] == 1000.0 and math.isnan(got[1]) and got[2] == 5.0
    assert got[3] is None and got[4] is None and got[5] == 75.3


def test_to_date(spark):
    got = _one(spark, ["2020-08-05", "2020-08-05 ", "20200805", "",
                       "2020-08-05 01:02:03"], cells.to_date)
    assert got == [dt.date(2020, 8, 5), None, None, None, None]


def test_to_timestamp_both_flavours(spark):
    vals = ["2020-08-05 09:30:00.123", "2020-08-05 09:30:00",
            "2020-08-05 09:30:00.123456", "2020-8-5 09:30:00.123",
            "2020-02-30 09:30:00.123", " 2020-08-05 09:30:00.123", None]
    ntz = _one(spark, vals, lambda c: cells.to_timestamp(c, ntz=True))
    assert ntz == [dt.datetime(2020, 8, 5, 9, 30, 0, 123000)] + [None] * 6
    ltz = _one(spark, vals, cells.to_timestamp)
    assert ltz[0] is not None and ltz[1:] == [None] * 6


def test_field_out_of_range_is_null(spark):
    df = spark.createDataFrame([("a,b",)], "s string")
    row = df.select(cells.field(F.split("s", ","), 5).alias("x")).first()
    assert row.x is None
