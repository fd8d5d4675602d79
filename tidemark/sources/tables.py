"""Partitioned Parquet tables: run selection, date selection, date reads.

The latest run or date comes from the folder listing, without opening a file;
reads then name the run's folder or filter the date column by a literal, which
prunes directories (``PartitionFilters`` in the plan).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

RUN_COL = "run_id"
PARTITION_COL = "partition"
DATE_COL = "trade_dt"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def read_table(spark: SparkSession, base: str) -> DataFrame:
    """A whole partitioned Parquet table with partition discovery."""
    return spark.read.parquet(base)


def read_partition(spark: SparkSession, base: str, **equals) -> DataFrame:
    """Rows whose partition columns equal the given values (pruned scan)."""
    df = spark.read.parquet(base)
    for col, value in equals.items():
        df = df.where(F.col(col) == F.lit(value))
    return df


def partition_values(spark: SparkSession, base: str, column: str, nulls: bool = False) -> list[str]:
    """Values of the ``column=value`` folders of ``base``, sorted.

    A folder listing: no file of the table is opened.  A missing folder has
    no values; the null partition is one only with ``nulls``.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
    found = {n.partition("=")[2] for n in names if n.startswith(f"{column}=")}
    return sorted(found if nulls else found - {NULL_PARTITION})


def latest_run_id(spark: SparkSession, base: str, run_col: str = RUN_COL) -> str:
    """Largest run id (ids are fixed-width UTC stamps, so name order is time
    order).  Raises ``ValueError`` when there is no run."""
    runs = partition_values(spark, base, run_col)
    if not runs:
        raise ValueError(f"no run found in {base}")
    return runs[-1]


def read_run(spark: SparkSession, base: str, run_id: str, run_col: str = RUN_COL) -> DataFrame:
    """One run of a run table: only its folder is listed and read."""
    return spark.read.parquet(f"{base}/{run_col}={run_id}")


def read_latest_run(spark: SparkSession, base: str, run_col: str = RUN_COL) -> DataFrame:
    """The latest run of a run table."""
    return read_run(spark, base, latest_run_id(spark, base, run_col), run_col)


def dates(spark: SparkSession, base: str, date_col: str = DATE_COL) -> list[_dt.date]:
    """The dates of a date-partitioned table, ascending."""
    return [_dt.date.fromisoformat(v) for v in partition_values(spark, base, date_col)]


def latest_date(spark: SparkSession, base: str, date_col: str = DATE_COL) -> _dt.date:
    """The latest date of a date-partitioned table; ``ValueError`` if none."""
    found = dates(spark, base, date_col)
    if not found:
        raise ValueError(f"no date found in {base}")
    return found[-1]


def previous_available_date(spark: SparkSession, base: str, date_col: str = DATE_COL) -> _dt.date | None:
    """The latest date before the latest one (None if there is only one)."""
    found = dates(spark, base, date_col)
    return found[-2] if len(found) > 1 else None


def previous_date(day: _dt.date) -> _dt.date:
    """The calendar day before ``day``."""
    return day - _dt.timedelta(days=1)


def read_date(spark: SparkSession, base: str, day, date_col: str = DATE_COL) -> DataFrame:
    """One date of a date-partitioned table; keeps the date column."""
    return spark.read.parquet(base).where(F.col(date_col) == F.lit(day))


def with_time(df: DataFrame, time_col: str = "event_tm") -> DataFrame:
    """``df`` with a text ``time_col`` as ``timestamp`` (bad times: NULL);
    other types stay."""
    if not isinstance(df.schema[time_col].dataType, StringType):
        return df
    return df.withColumn(time_col, F.col(time_col).try_cast("timestamp"))


def footer_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster whose Parquet scans answer counts, least
    and greatest values from file footers.  Its settings are its own; frames
    read through it keep them."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_counts(spark: SparkSession, base: str, by: Sequence[str] = (), extremes: Sequence[str] = (),
                  name: str = "n_rows") -> DataFrame:
    """Rows of a Parquet table, per value of its partition columns ``by``, and
    ``min_<c>`` / ``max_<c>`` of ``extremes``, from file footers alone: no
    column of any row is read.

    Footers hold extremes of integers, floats, dates and booleans; for other
    types (times, texts, or where a writer left them out) use a plain aggregate.
    A table without files has no schema and is an error, as in any scan.
    """
    table = footer_session(spark).read.parquet(base)
    wanted = [F.count(F.lit(1)).alias(name)]
    for c in extremes:
        wanted += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return table.groupBy(*by).agg(*wanted)


def lookup_rows(spark: SparkSession, base: str, equals: dict) -> DataFrame:
    """Rows whose columns equal the given values.  Partition columns choose
    folders; in tables of :func:`tidemark.sources.sinks.write_clustered` the
    others choose row groups, by their least and greatest values and their
    Bloom filters."""
    df = spark.read.parquet(base)
    for column, value in equals.items():
        df = df.where(F.col(column) == F.lit(value))
    return df


def read_eod_date(spark: SparkSession, eod_base: str, day) -> tuple[DataFrame, DataFrame]:
    """(trades, quotes) of one date from an end-of-day table root."""
    return (with_time(read_date(spark, f"{eod_base}/trade", day)),
            with_time(read_date(spark, f"{eod_base}/quote", day)))


def preview(df: DataFrame, n: int = 5) -> tuple[str, DataFrame]:
    """Schema text and the first ``n`` rows (for inspection)."""
    return df.schema.simpleString(), df.limit(n)
