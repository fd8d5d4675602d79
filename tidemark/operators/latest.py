"""Latest version per key, keyed upserts and lookups.

:func:`newest` ranks the rows of a key and keeps the first.  Catalyst turns
that into a ``WindowGroupLimit``: a partial top-1 per key runs on the map
side before the shuffle, so even a key holding a third of all rows sends
at most one row per map task across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def newest(df: DataFrame, by: Sequence[str], ranking: Sequence[str | Column]) -> DataFrame:
    """One row of every ``by`` group: the one that ranks highest.

    ``ranking`` compares from its first entry on, larger first, NULL last.
    Rows that tie on all of it are interchangeable, so one of them is kept
    arbitrarily.  NULLs in ``by`` are a group like any other value.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in ranking]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*[c.desc_nulls_last() for c in columns]))
    return df.select("*", place.alias("_tm_place")).where("_tm_place = 1").select(*df.columns)


def upsert_latest(current: DataFrame, updates: DataFrame,
                  key_cols: Sequence[str] = ("job_id",),
                  time_col: str = "updated_time") -> DataFrame:
    """Insert-or-replace by key: a row of ``updates`` replaces the row of
    ``current`` with the same key; other rows of ``current`` stay.

    The newer write wins even when its time column is older (a priority flag
    ranks first).  Among several updates of one key the latest time wins.
    """
    write = "_tm_write"
    both = (current.withColumn(write, F.lit(0))
            .unionByName(updates.select(*current.columns).withColumn(write, F.lit(1))))
    return newest(both, key_cols, [write, time_col]).drop(write)


def lookup(df: DataFrame, key_col: str, value) -> DataFrame:
    """Rows whose key equals ``value`` (empty when missing)."""
    return df.filter(F.col(key_col) == F.lit(value))


def daily_job_id(name: Column | str, day: Column | str) -> Column:
    """``<name>_<yyyy-MM-dd>`` job id of a daily run."""
    name = F.col(name) if isinstance(name, str) else name
    day = F.col(day) if isinstance(day, str) else day
    return F.concat_ws("_", name, F.date_format(day, "yyyy-MM-dd"))


def job_status_rows(job_id: Column, status: Column, updated_time: Column) -> list[Column]:
    """Projection onto the job-status layout."""
    return [job_id.alias("job_id"), status.alias("status"),
            updated_time.alias("updated_time")]

