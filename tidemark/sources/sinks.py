"""Partitioned Parquet sinks.

Writes go straight from the producing tasks (no repartition to one file per
partition value: one hot date or type would then be written by one task).
Overwrite scope is explicit: ``static`` replaces the whole table (the
reference behaviour), ``dynamic`` replaces only the partitions written.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_run_id(now: _dt.datetime | None = None) -> str:
    """Fixed-width UTC run id ``YYYYMMDD_HHMMSS_ffffff``."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%d_%H%M%S_%f")


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str],
                      overwrite: str = "static") -> None:
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", overwrite)
     .partitionBy(*partition_cols).parquet(path))


def write_clustered(df: DataFrame, path: str, partition_cols: Sequence[str], cluster_by: Sequence[str],
                    bloom: Mapping[str, int] | None = None, files: int | None = None, overwrite: str = "static",
                    row_group_bytes: int | None = None) -> None:
    """A partitioned table that lookups can skip through.

    Rows are dealt by ranges of the partition columns and then of
    ``cluster_by`` (sampled cuts, ``files`` ranges, default the shuffle
    partitions), and sorted alike in each file: a value of the leading cluster
    columns lies in few row groups, whose least and greatest values tell.  A
    hot partition value spreads over several files.  ``bloom``: columns with a
    Bloom filter in every row group, and how many different values one holds;
    for equality lookups on columns that are not clustered.
    """
    order = [*partition_cols, *cluster_by]
    columns = [F.col(c) for c in order]
    dealt = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
    writer = dealt.sortWithinPartitions(*order).write.mode("overwrite").option("partitionOverwriteMode", overwrite)
    for column, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true") \
            .option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.partitionBy(*partition_cols).parquet(path)


def write_run(events: DataFrame, base: str, run_id: str,
              partition_col: str = "partition") -> None:
    """One ingest run as ``run_id=<id>/partition=<T|Q|B>``.  The run's folder
    is replaced whole, so a repeated run leaves nothing of an earlier try;
    other runs stay."""
    write_partitioned(events, f"{base}/run_id={run_id}", [partition_col])


def write_eod(df: DataFrame, path: str, overwrite: str = "static") -> None:
    """End-of-day table partitioned by ``trade_dt``."""
    write_partitioned(df, path, ["trade_dt"], overwrite)


def write_analytics(df: DataFrame, base: str, day=None) -> None:
    """Analytical table: ``date=<day>`` folder for one day, else one folder
    per ``trade_dt`` (dynamic overwrite)."""
    if day is not None:
        df.write.mode("overwrite").parquet(f"{base}/date={day}")
    else:
        write_partitioned(df.withColumn("date", F.col("trade_dt")), base,
                          ["date"], overwrite="dynamic")
