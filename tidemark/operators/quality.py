"""Data-quality measures: counts, reconciliation, NULL counts, previews.

All are aggregates (partial + final, map-side combined) returning small
DataFrames; nothing is collected unless the caller asks.  ``fingerprint`` and
``reconcile_rows`` compare the rows themselves, whatever their order.  ``observe_counts``
measures while another action (a write) runs, saving a second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def counts_by(df: DataFrame, *cols: str, name: str = "n") -> DataFrame:
    """Rows per value of ``cols``."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def null_count(df: DataFrame, col: str, name: str = "n_null") -> DataFrame:
    """Rows where ``col`` is NULL."""
    return df.agg(F.count_if(F.col(col).isNull()).alias(name))


def reconcile(before: DataFrame, after: DataFrame, name_in: str = "n_in",
              name_out: str = "n_out") -> DataFrame:
    """One row: rows before and after a step, and whether they agree.

    One aggregate over a tagged union (both inputs scanned once, no join).
    """
    side = "_tm_side"
    both = (before.select(F.lit(0).alias(side))
            .unionByName(after.select(F.lit(1).alias(side))))
    return (both.agg(F.count_if(F.col(side) == 0).alias(name_in),
                     F.count_if(F.col(side) == 1).alias(name_out))
            .withColumn("matched", F.col(name_in) == F.col(name_out)))


def row_hash(df: DataFrame, columns: Sequence[str] | None = None, seed: int = 0) -> Column:
    """64 bits of a row.  Which columns are NULL counts too (a hash skips
    NULLs, so that (NULL, 1) and (1, NULL) would be alike), and a column's type."""
    columns = list(columns) if columns is not None else df.columns
    whole = [F.col(f"`{c}`") for c in columns]
    nulls = F.concat(F.lit(""), *[F.when(c.isNull(), "1").otherwise("0") for c in whole])
    types = ",".join(df.schema[c].dataType.simpleString() for c in columns)
    return F.xxhash64(F.lit(f"{seed} {types}"), nulls, *whole)


_PRINT = ("rows", "hash_sum", "hash_xor")


def _print_of(weight: Column | None = None) -> list[Column]:
    """Row count, exact sum and exclusive or of two independent row hashes:
    order does not matter, a lost row and a doubled one do not cancel."""
    one = (lambda c: c) if weight is None else (lambda c: F.when(weight, c))
    return [F.count(one(F.lit(1))).alias("rows"),
            F.coalesce(F.sum(one(F.col("_tm_h1").cast("decimal(38,0)"))), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"),
            F.coalesce(F.bit_xor(one(F.col("_tm_h2"))), F.lit(0)).cast("bigint").alias("hash_xor")]


def fingerprint(df: DataFrame, by: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """``rows``, ``hash_sum`` and ``hash_xor`` of the rows (per value of
    ``by``): equal for equal multisets of rows, and for others with a chance of
    some 2**-64.  Map columns have no hash; leave them out of ``columns``."""
    columns = columns if columns is not None else df.columns
    hashed = df.select(*by, row_hash(df, columns).alias("_tm_h1"), row_hash(df, columns, 1).alias("_tm_h2"))
    return hashed.groupBy(*by).agg(*_print_of())


def reconcile_rows(before: DataFrame, after: DataFrame, by: Sequence[str] = (),
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Per value of ``by`` (NULL is one): rows before and after a step, whether
    the counts agree (``same_count``) and whether the rows do (``same_rows``).

    One aggregate over a tagged union; both inputs are read once.  Columns are
    matched by name and have to have the same types to be equal.
    """
    columns = list(columns) if columns is not None else before.columns
    side = "_tm_side"
    tagged = [df.select(*by, row_hash(df, columns).alias("_tm_h1"), row_hash(df, columns, 1).alias("_tm_h2"), F.lit(k).alias(side))
              for k, df in enumerate((before, after))]
    sides = [F.struct(*_print_of(F.col(side) == k)).alias(f"_tm_{k}") for k in range(2)]
    both = tagged[0].unionByName(tagged[1]).groupBy(*by).agg(*sides)
    return both.select(*by, F.col("_tm_0.rows").alias("n_in"), F.col("_tm_1.rows").alias("n_out"),
                       (F.col("_tm_0.rows") == F.col("_tm_1.rows")).alias("same_count"),
                       (F.col("_tm_0") == F.col("_tm_1")).alias("same_rows"))


def before_after_counts(before: DataFrame, after: DataFrame, by: str,
                        name_in: str = "n_before",
                        name_out: str = "n_after") -> DataFrame:
    """Rows per value of ``by`` before and after a step, in one aggregate."""
    side = "_tm_side"
    both = (before.select(by, F.lit(0).alias(side))
            .unionByName(after.select(by, F.lit(1).alias(side))))
    return both.groupBy(by).agg(F.count_if(F.col(side) == 0).alias(name_in),
                                F.count_if(F.col(side) == 1).alias(name_out))


def top_rows(df: DataFrame, order: Sequence[str | Column], n: int = 20) -> DataFrame:
    """First ``n`` rows in ``order`` (a top-k: partial top-n per task)."""
    return df.orderBy(*order).limit(n)


def observe_counts(df: DataFrame, name: str, col: str,
                   values: Sequence[str]) -> tuple[DataFrame, Observation]:
    """Attach per-value row counts that fill in when ``df`` is next run."""
    obs = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(F.col(col) == F.lit(v)).alias(str(v)) for v in values]
    return df.observe(obs, *exprs), obs
