"""Hard-negative mining with Strassen products of integer tiles.

Components become integers, ``floor(scale * x)``; a score is the integer inner
product of a row with an anchor, so every result is exact.

1. Rows are written once as *tiles* of at most ``TILE`` rows: ids, labels and
   the matrix, in the narrowest integers that hold it.  The anchors, a stated
   query set, are dealt into tiles of their own.
2. Every anchor tile meets every candidate tile, in groups of a few pairs, so
   any number of either spreads over the cluster.  Scores of a pair come from
   :func:`strassen`: both sides are zero-padded to even sizes and multiplied
   with seven products of halves, recursively; additions are integer additions.
3. *Positive heaps* keep the first ``positives`` rows of an anchor's label; a
   group merges the heaps of its pairs, Spark merges those of the groups (a
   top-k by anchor that combines before its shuffle).
4. With the positives known, a second walk over the same pairs keeps a *window
   heap* for each anchor and positive: the first ``negatives`` rows of another
   label whose score lies in the positive's window.  They merge alike.

Higher scores come first, ties by smaller id, null ids last; rows equal in both
are interchangeable.

Defined results: rows with a null label, a null vector or null or non-finite
components take no part; a row with a null id is a candidate, never an anchor;
a repeated row is another row, as a candidate and as an anchor; an anchor
without another row of its label has no result, nor has a positive with an empty
window (as if its score is negative); vectors of different lengths and scores beyond
2**53 / 100 are an error; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import only, ship
from tidemark.sources.scratch import materialise

POSITIVES, NEGATIVES = 5, 3
#: Window of a negative's score, in hundredths of the positive's.
LEAST, MOST = 50, 95
SCALE = 256
TILE = 2048
LEAF = 32
#: Candidate tiles of a group of pairs, about.
GROUP_TILES = 4
#: Rows of an anchor tile whose scores are looked at together.
_STRIP = 256


# --- products ------------------------------------------------------------------------

def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact product of two integer matrices: in doubles where every partial
    sum is an integer that a double holds."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of int64 matrices; exact whenever the result fits (integer
    arithmetic wraps, so steps between may not)."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return _leaf(a, b)
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    x, y, z = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:x, :y], a[:x, y:], a[x:, :y], a[x:, y:]
    b11, b12, b21, b22 = b[:y, :z], b[:y, z:], b[y:, :z], b[y:, z:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * x, 2 * z), np.int64)
    out[:x, :z] = p1 + p4 - p5 + p7
    out[:x, z:] = p3 + p5
    out[x:, :z] = p2 + p4
    out[x:, z:] = p1 - p2 + p3 + p6
    return out[:m, :n]


# --- heaps ---------------------------------------------------------------------------

#: A heap entry: its heap (anchor, then place of the positive), score, id or none.
_ENTRY = ("anchor", "place", "score", "id", "no_id", "row")


def first_of(entries: dict[str, np.ndarray], k: int) -> dict[str, np.ndarray]:
    """The first ``k`` entries of every heap: how heaps merge."""
    if not len(entries["score"]):
        return entries
    order = np.lexsort((entries["row"], entries["id"], entries["no_id"], -entries["score"], entries["place"], entries["anchor"]))
    entries = {c: v[order] for c, v in entries.items()}
    new = np.r_[True, (entries["anchor"][1:] != entries["anchor"][:-1]) | (entries["place"][1:] != entries["place"][:-1])]
    starts = np.flatnonzero(new)
    rank = np.arange(len(new)) - starts[np.cumsum(new) - 1]
    return {c: v[rank < k] for c, v in entries.items()}


def _best(scores: np.ndarray, fits: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (anchor, candidate) of each anchor's ``k`` highest scores among
    those that fit, with all ties of the last."""
    low = np.iinfo(np.int64).min
    held = np.where(fits, scores, low)
    if held.shape[1] > k:
        last = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
        keep = held >= last[:, None]
    else:
        keep = np.ones_like(fits)
    return np.nonzero(keep & fits)


class _Tile:
    """One side of a pair, as numpy arrays."""

    def __init__(self, value: dict) -> None:
        self.row, self.label = (np.frombuffer(value[c], np.int64) for c in ("row", "label"))
        self.id, self.no_id = np.frombuffer(value["id"], np.int64), np.frombuffer(value["no_id"], np.int8)
        self.x = np.frombuffer(value["x"], f"<i{value['width']}").astype(np.int64).reshape(len(self.row), -1)
        self.bounds = np.frombuffer(value["bounds"], np.int64).reshape(len(self.row), -1) if value.get("bounds") else None


def _scores(a: _Tile, c: _Tile) -> np.ndarray:
    if a.x.shape[1] != c.x.shape[1]:
        raise ValueError("vectors differ in length")
    bound = float(np.abs(a.x).max(initial=0)) * float(np.abs(c.x).max(initial=0)) * a.x.shape[1]
    if bound * 100 >= 2.0 ** 63:
        raise ValueError("components are too large for exact scores")
    return strassen(a.x, np.ascontiguousarray(c.x.T))


def positive_heaps(a: _Tile, c: _Tile, k: int) -> dict[str, np.ndarray]:
    """The first ``k`` other rows of each anchor's label within a pair."""
    scores = _scores(a, c)
    parts = []
    for at in range(0, len(a.row), _STRIP):
        s = slice(at, at + _STRIP)
        fits = (a.label[s, None] == c.label[None, :]) & (a.row[s, None] != c.row[None, :])
        i, j = _best(scores[s], fits, k)
        parts.append(_entries(a, c, at + i, np.zeros(len(i), np.int64), j, scores[at + i, j]))
    return first_of(_joined(parts), k)


def window_heaps(a: _Tile, c: _Tile, k: int, least: int, most: int) -> dict[str, np.ndarray]:
    """For each anchor and positive (its score in ``a.bounds``; no more
    positives: the least integer) the first ``k`` rows of other labels inside
    the window."""
    scores = _scores(a, c)
    parts = []
    for at in range(0, len(a.row), _STRIP):
        s = slice(at, at + _STRIP)
        other, hundred = a.label[s, None] != c.label[None, :], 100 * scores[s]
        for place in range(a.bounds.shape[1]):
            p = a.bounds[s, place]
            known = p > np.iinfo(np.int64).min
            p = np.where(known, p, 0)
            fits = other & known[:, None] & (hundred >= least * p[:, None]) & (hundred <= most * p[:, None])
            i, j = _best(scores[s], fits, k)
            parts.append(_entries(a, c, at + i, np.full(len(i), place + 1), j, scores[at + i, j]))
    return first_of(_joined(parts), k)


def _entries(a: _Tile, c: _Tile, i: np.ndarray, place: np.ndarray, j: np.ndarray, score: np.ndarray) -> dict[str, np.ndarray]:
    return dict(zip(_ENTRY, (a.row[i], place, score, c.id[j], c.no_id[j], c.row[j]), strict=True))


def _joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    return {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c in _ENTRY}


# --- Spark ---------------------------------------------------------------------------

_TILE_TYPE = ("tile long, row binary, id binary, no_id binary, label binary, x binary, width int, bounds binary")


def integers(vectors: DataFrame, label: Column, vec_id: str = "vec_id", embedding: str = "embedding",
             scale: int = SCALE) -> DataFrame:
    """id, label, x (array of long) and a row number of the rows that take
    part; written.  ``label`` is computed from the input's columns."""
    df = vectors.select(F.col(f"`{vec_id}`").cast("bigint").alias("id"), label.cast("bigint").alias("label"),
                        F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform("e", lambda c: F.floor(c * F.lit(float(scale))))
    return materialise(df.where(F.col("label").isNotNull() & F.col("e").isNotNull() & finite)
                       .select("id", "label", x.alias("x"), F.monotonically_increasing_id().alias("row")), "integers")


def _tiles(rows: DataFrame, tile: int) -> DataFrame:
    """``rows``: id, label, x, row and bounds (array of long or null).  Written
    as tiles, numbered."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= tile:
                whole = pa.Table.from_batches(held).combine_chunks()
                for at in range(0, count - count % tile, tile):
                    yield _packed(whole.slice(at, tile))
                rest = whole.slice(count - count % tile)
                held, count = rest.to_batches(), rest.num_rows
        if count:
            yield _packed(pa.Table.from_batches(held))

    packed = rows.select("id", "label", "x", "row", "bounds").mapInArrow(emit, _TILE_TYPE)
    return materialise(packed.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def _packed(rows: pa.Table) -> pa.RecordBatch:
    column = {c: rows[c].combine_chunks() for c in rows.column_names}
    x = column["x"].flatten().to_numpy(zero_copy_only=False)
    size = np.diff(column["x"].offsets.to_numpy())
    if len(size) and (size != size[0]).any():
        raise ValueError("vectors differ in length")
    most = int(np.abs(x).max(initial=0))
    width = next(w for w in (2, 4, 8) if most < 1 << (8 * w - 1))
    no_id = column["id"].is_null().to_numpy(zero_copy_only=False).astype(np.int8)
    values = {"row": column["row"].to_numpy(), "id": column["id"].fill_null(0).to_numpy(), "no_id": no_id,
              "label": column["label"].to_numpy(), "x": x.astype(f"<i{width}"),
              "bounds": column["bounds"].flatten().to_numpy(zero_copy_only=False)}
    held = {c: np.ascontiguousarray(v).tobytes() for c, v in values.items()}
    held["bounds"] = held["bounds"] or None
    return pa.RecordBatch.from_arrays(
        [pa.array([0], pa.int64()), *[pa.array([held[c]], pa.binary()) for c in ("row", "id", "no_id", "label", "x")],
         pa.array([width], pa.int32()), pa.array([held["bounds"]], pa.binary())],
        names=["tile", "row", "id", "no_id", "label", "x", "width", "bounds"])


_HEAP_TYPE = "anchor long, place long, score long, id long, row long"


def _walk(anchors: DataFrame, candidates: DataFrame, heaps: Callable[[_Tile, _Tile], dict[str, np.ndarray]],
          k: int) -> DataFrame:
    """Heap entries of every pair of tiles, merged within a group of pairs and
    by heap over all."""
    # Each anchor tile meets each candidate tile in one group, which is about
    # one anchor tile and ``GROUP_TILES`` candidate tiles.
    n_i, n_g = max(1, anchors.count()), max(1, math.ceil(candidates.count() / GROUP_TILES))
    bucket = lambda n: F.pmod(F.xxhash64("tile"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("i", bucket(n_i)).withColumn("g", every(n_g))
    c = candidates.withColumn("g", bucket(n_g)).withColumn("i", every(n_i))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        held = _joined([])
        for x in left.to_pylist():
            for y in right.to_pylist():
                held = first_of(_joined([held, heaps(_Tile(x), _Tile(y))]), k)
        return _written(held)

    found = a.groupBy("i", "g").cogroup(c.groupBy("i", "g")).applyInArrow(score, _HEAP_TYPE)
    place = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(
        F.desc("score"), F.asc_nulls_last("id"), "row"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def _written(entries: dict[str, np.ndarray]) -> pa.Table:
    names = ["anchor", "place", "score", "id", "row"]
    none = entries["no_id"].astype(bool)
    return pa.table([pa.array(entries[c].astype(np.int64), mask=none if c == "id" else None) for c in names], names=names)


def mine(vectors: DataFrame, is_anchor: Column, label: Column, vec_id: str = "vec_id", embedding: str = "embedding",
         positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
         scale: int = SCALE, tile: int = TILE) -> DataFrame:
    """anchor_id, positive_id, positive_rank, rank (both from 1), negative_id,
    positive_score, negative_score.  ``label`` is an expression over the
    input's columns, ``is_anchor`` one over ``id`` and ``label``."""
    ship(vectors.sparkSession)
    rows = integers(vectors, label, vec_id, embedding, scale)
    none = F.array().cast("array<bigint>")
    asked = rows.where(F.col("id").isNotNull() & is_anchor)
    whole = lambda df: max(1, math.ceil(df.count() / tile))
    candidates = _tiles(rows.withColumn("bounds", none).repartition(whole(rows)), tile)
    n = whole(asked)
    anchors = _tiles(asked.withColumn("bounds", none).repartition(n), tile)
    first = materialise(_walk(anchors, candidates, lambda a, c: positive_heaps(a, c, positives), positives)
                        .select("anchor", "rank", "score", "id"), "positives")
    # At most ``positives`` entries for each anchor.
    by_rank = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda r: F.coalesce(
        F.get(F.filter("held", lambda h: h["rank"] == r), F.lit(0))["score"], F.lit(-(1 << 63))))
    bounds = first.groupBy("anchor").agg(F.collect_list(F.struct("rank", "score")).alias("held")).select(
        F.col("anchor").alias("row"), by_rank.alias("bounds"))
    known = _tiles(asked.join(bounds, "row").repartition(n), tile)
    found = _walk(known, candidates, lambda a, c: window_heaps(a, c, negatives, least, most), negatives)
    names = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    pairs = first.select("anchor", F.col("rank").cast("bigint").alias("place"), F.col("id").alias("positive_id"),
                         F.col("score").alias("positive_score"))
    return (found.join(pairs, ["anchor", "place"]).join(names, "anchor").select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("positive_rank"), F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
