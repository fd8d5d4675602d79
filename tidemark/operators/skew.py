"""Keys that hold too many rows for one task, and what is done about them.

A *heavy-hitter sketch* (``approx_top_k`` over key hashes, one aggregate row)
names the keys that hold more than a ``parts``-th of the rows.  There are fewer
than ``parts`` of them, so everything derived from them is bounded by the
number of partitions, not by the data:

* :func:`skewed_left_join` deals the rows of a heavy key over several salts and
  replicates the other side for those keys only;
* :class:`Ranges` cuts a heavy key into ranges of about equal row counts by
  *quantile sketches* (KLL) of its order columns.  The range is then a column of
  every row, found by a search in the key's cuts, so ordered work on a key
  needs one exchange, by key and range.

Sketches may be taken of an ``outline``: any rows with the same keys and order
columns and about the same distribution (raw rows in place of derived ones).  A
bad outline costs balance, never correctness.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timecols import order_number

#: Struct of the keys and the number of the range.
PART = "_tm_part"
_RANGE, _HASH, _COPIES, _CUTS, _SALT = "_tm_range", "_tm_hash", "_tm_copies", "_tm_cuts", "_tm_salt"
#: KLL sketches have a rank error of about 2 / k.
_SKETCH = 4096
_TRACKED = 1 << 20
#: Salts for each task's share of a heavy key: salts meet in a task by chance.
_FINE = 4
_LOW = -(1 << 63)


def default_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


@dataclass
class Heavy:
    """Rows of the outline, and rows by hash of the heavy keys."""

    rows: int
    held: dict[int, int]
    parts: int

    def pieces(self, n: int) -> int:
        """In how many pieces ``n`` rows go."""
        return max(1, math.ceil(n * self.parts / max(self.rows, 1)))


def heavy_keys(outline: DataFrame, keys: Sequence[str], parts: int | None = None) -> Heavy:
    """Keys with more than a ``parts``-th of the rows (default: the shuffle
    partitions); one pass, one row to the driver."""
    parts = parts or default_parts(outline.sparkSession)
    if parts < 2:
        return Heavy(0, {}, parts)
    k = min(parts, _TRACKED // 8)
    top = F.call_function("approx_top_k", F.col(_HASH), F.lit(k), F.lit(max(1024, 8 * k)))
    found = outline.select(key_hash(keys).alias(_HASH)).agg(F.count(F.lit(1)).alias("n"), top.alias("top")).first()
    n = found["n"]
    return Heavy(n, {r["item"]: r["count"] for r in found["top"] or [] if r["count"] * parts > n}, parts)


def skewed_left_join(left: DataFrame, right: DataFrame, on: Sequence[str], parts: int | None = None,
                     outline: DataFrame | None = None) -> DataFrame:
    """``left`` left-joined with ``right``, which has few rows for each key.

    A heavy key's rows of ``left`` are dealt over several salts by a hash of
    the whole row, and its rows of ``right`` are copied to each.  Struct keys
    match field by field, NULL fields too; plain NULL keys match nothing, but
    are dealt out like others.  Rows equal in every column stay together.
    """
    heavy = heavy_keys(outline if outline is not None else left, on, parts)
    copies = [(h, heavy.pieces(_FINE * n)) for h, n in heavy.held.items()]
    if not copies:
        return left.join(right, list(on), "left")
    known = F.broadcast(left.sparkSession.createDataFrame(copies, f"{_HASH} long, {_COPIES} int"))  # < parts rows
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in left.schema if not isinstance(f.dataType, T.MapType)])
    n = F.coalesce(_COPIES, F.lit(1))
    dealt = (left.withColumn(_HASH, key_hash(on)).join(known, _HASH, "left")
             .withColumn(_SALT, F.pmod(whole, n).cast("int")).drop(_HASH, _COPIES))
    copied = (right.withColumn(_HASH, key_hash(on)).join(known, _HASH, "left")
              .withColumn(_SALT, F.explode(F.sequence(F.lit(0), n - 1))).drop(_HASH, _COPIES))
    return dealt.join(copied, [*on, _SALT], "left").drop(_SALT)


@dataclass
class Ranges:
    """Cuts of the heavy keys: of each hash, sorted (first, second) places of
    the order columns; a range begins at its cut."""

    spark: SparkSession
    keys: list[str]
    order: list[str]
    cuts: dict[int, list[tuple[int, int]]]

    def _known(self) -> DataFrame:
        # Fewer than twice as many cuts as partitions.
        return F.broadcast(self.spark.createDataFrame(
            list(self.cuts.items()), f"{_HASH} long, {_CUTS} array<struct<t:long,s:long>>"))

    def heavy(self) -> Column:
        return key_hash(self.keys).isin(list(self.cuts))

    def part(self, number: Column) -> Column:
        return F.struct(*[F.col(k) for k in self.keys], number.cast("int").alias(_RANGE))

    def of(self, df: DataFrame) -> DataFrame:
        """``df`` with :data:`PART`."""
        if not self.cuts:
            return df.withColumn(PART, self.part(F.lit(0)))
        place = F.struct(*[c.alias(n) for c, n in zip(_places(df, self.order), "ts", strict=True)])
        steps = [1 << i for i in reversed(range(max(map(len, self.cuts.values())).bit_length()))]
        cuts = F.col(_CUTS)
        # How many cuts are not after the row: a binary search.
        found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
            F.get(cuts, at + step - 1) <= place, at + step).otherwise(at))
        return (df.withColumn(_HASH, key_hash(self.keys)).join(self._known(), _HASH, "left")
                .withColumn(PART, self.part(F.when(cuts.isNull(), 0).otherwise(found))).drop(_HASH, _CUTS))

    def copies(self, df: DataFrame) -> DataFrame:
        """``df`` with a row for every range of its key: :data:`PART`."""
        if not self.cuts:
            return df.withColumn(PART, self.part(F.lit(0)))
        each = F.sequence(F.lit(0), F.when(F.col(_CUTS).isNull(), 0).otherwise(F.size(_CUTS)))
        return (df.withColumn(_HASH, key_hash(self.keys)).join(self._known(), _HASH, "left")
                .withColumn(_RANGE, F.explode(each)).withColumn(PART, self.part(F.col(_RANGE))).drop(_HASH, _CUTS, _RANGE))


def _places(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The first two order columns as integers, NULL least."""
    found = [order_number(df, c) for c in list(order)[:2]]
    found = [F.lit(0).cast("bigint") if c is None else F.coalesce(c, F.lit(_LOW)) for c in found]
    return (found + [F.lit(0).cast("bigint")])[:2]


def _quantiles(rows: DataFrame, column: str, pieces: dict[tuple, int], by: Sequence[str]) -> dict[tuple, list[int]]:
    """The cuts of each group's ``column`` between as many equal pieces as
    ``pieces`` says: a sketch and a grid of quantiles for each group."""
    grid = 4 * max(pieces.values())
    ranks = F.array(*[F.lit(i / grid) for i in range(1, grid)])
    found = (rows.groupBy(*by).agg(F.kll_sketch_agg_bigint(column, _SKETCH).alias("q"))
             .select(*by, F.kll_sketch_get_quantile_bigint("q", ranks).alias("q")).collect())
    held = {tuple(r[c] for c in by): r["q"] for r in found}
    return {k: [q[round(i * grid / pieces[k]) - 1] for i in range(1, pieces[k])] for k, q in held.items()}


def cut_ranges(outline: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int | None = None) -> Ranges:
    """Ranges of the heavy keys by ``order`` (ascending, NULLs first).

    The first order column is cut at the quantiles of its sketch.  Quantiles
    that coincide tell an instant that holds more than a range (a burst, or
    rows without a time); it is cut further at quantiles of the second column.
    Order columns that are neither times nor integers are not cut.
    """
    spark, keys, order = outline.sparkSession, list(keys), list(order)
    heavy = heavy_keys(outline, keys, parts)
    pieces = {h: heavy.pieces(n) for h, n in heavy.held.items() if heavy.pieces(n) > 1}
    if not pieces or order_number(outline, order[0]) is None:
        return Ranges(spark, keys, order, {})
    t, s = _places(outline, order)
    rows = outline.select(key_hash(keys).alias(_HASH), t.alias("t"), s.alias("s")).where(F.col(_HASH).isin(list(pieces)))
    first = _quantiles(rows, "t", {(h,): n for h, n in pieces.items()}, [_HASH])
    cuts = {h: sorted((v, _LOW) for v in set(q)) for (h,), q in first.items()}
    bursts = {(h, v): q.count(v) + 1 for (h,), q in first.items() for v in set(q) if q.count(v) > 1}
    if bursts:
        known = F.broadcast(spark.createDataFrame(list(bursts), f"{_HASH} long, t long"))  # < parts rows
        for (h, v), q in _quantiles(rows.join(known, [_HASH, "t"]), "s", bursts, [_HASH, "t"]).items():
            cuts[h] = sorted({*cuts[h], *((v, x) for x in q), (v + 1, _LOW)})
    return Ranges(spark, keys, order, cuts)
