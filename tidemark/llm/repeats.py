"""Repeated-passage removal: maximal repeats from an interval tree over
enhanced suffix arrays.

A byte is removed if a string of ``length`` bytes that covers it also starts
anywhere else, in the same text or another.

1. *Anchors* bring equal strings together.  Every ``length``-byte string has
   one anchor: of the k-grams in it the one with the least hash, the leftmost
   of equals.  Equal strings have equal anchors at the same place, so all
   occurrences of a string share the anchor's key.  One in about 85 positions
   is an anchor.  Its *context* holds every string it can be the anchor of.
2. Keys that occur once are dropped by an aggregation.  A context that occurs
   twice or more is covered whole, wherever it occurs; one occurrence stands
   for all from here on.  A text is looked at once, however many copies it has;
   texts with copies are covered whole.
3. Different contexts of one key are dealt out by key.  A task merges what
   overlaps in a text, so that each position stands there once, builds the
   suffix array of the positions with ``length`` bytes in common, keeps the
   classes with different left neighbours, and scans their longest common
   prefixes with a stack: each interval of the tree with different left
   neighbours is a maximal repeat, and all its occurrences are marked.
4. The suffix array of a key with more than ``HOT`` contexts (a passage in very
   many surroundings) does not fit into a task; it is sorted by Spark, and
   longest common prefixes are taken of neighbours.  All strings of a context
   hold its anchor, so what is covered reaches from the leftmost repeated
   string's start to the rightmost one's end.  Of contexts that go on alike
   after the anchor, the longest common prefix of what precedes it, read
   backwards, tells the leftmost; of contexts that are alike before it, the same
   holds the other way; strings that two contexts share though they differ on
   both sides are counted, where the bounds that the neighbours set leave open
   whether there are any.
5. The marks of a text are merged; a text's copies share its result.

Defined results: a null text counts as empty; texts shorter than ``length``
lose nothing; repeated rows are copies, so long ones are removed whole; null
ids ride along; an empty table gives an empty result; other columns are not
read by :func:`find` and kept by :func:`remove`.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, only, ship, text_or_empty
from tidemark.llm.jaccard import text_key
from tidemark.operators.skew import skewed_left_join
from tidemark.sources.scratch import materialise

LENGTH = 200
#: Bytes of an anchor.
GRAM = 32
HOT = 4_000
BATCH_BYTES = 2 << 20
#: Bytes of suffixes that are compared at once.
SLICE_BYTES = 1 << 20
_PIECE = 1 << 22
_UNITS = 100_000
_PLACE = np.uint64((1 << 24) - 1)
_C = np.uint64(0x9E3779B97F4A7C15)
_D = np.uint64(0xBF58476D1CE4E5B9)


# --- anchors ----------------------------------------------------------------------

def gram_hashes(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """64-bit hashes of all grams, by doubling; a last step overlaps."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _C
    step = 1
    while step < gram:
        ahead = min(step, gram - step)
        if len(h) <= ahead:
            return h[:0]
        a = h[:-ahead]
        h = ((a ^ (a >> np.uint64(29))) * _D) + h[ahead:]
        step += ahead
    h = (h ^ (h >> np.uint64(32))) * _C
    return h ^ (h >> np.uint64(29))


def _window_least(x: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while step * 2 <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def anchors(text: bytes, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and keys of the anchors of a text."""
    places, keys = [], []
    for at in range(0, max(1, len(text) - length + 1), _PIECE):
        part = np.frombuffer(text, np.uint8)[at:at + _PIECE + length - 1]
        if len(part) < length:
            continue
        h = gram_hashes(part, gram)
        place = np.arange(len(h), dtype=np.uint64)
        # The hash decides, then the place; equal texts order alike.
        least = _window_least((h & ~_PLACE) | place, length - gram + 1) & _PLACE
        p = least[np.r_[True, least[1:] != least[:-1]]].astype(np.int64)
        places.append(p + at)
        keys.append(h[p])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    p, k = np.concatenate(places), np.concatenate(keys)
    p, first = np.unique(p, return_index=True)
    return p, k[first]


def context(place: int, size: int, length: int = LENGTH, gram: int = GRAM) -> tuple[int, int]:
    """Start and end of what strings with this anchor can cover."""
    return max(0, place - (length - gram)), min(size, place + length)


# --- enhanced suffix array -----------------------------------------------------------

def _common(a: bytes, b: bytes) -> int:
    """Length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while lo + 1 < hi:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def _sorted_suffixes(at: list[tuple[int, int]], segments: list[bytes]) -> tuple[list[tuple[int, int]], list[int]]:
    """The (segment, place) pairs in the order of their suffixes, and the
    longest common prefix of each with the one before (-1 for the first).
    Slices of about ``SLICE_BYTES`` together are held at a time; further bytes
    are read only where slices are equal."""
    order: list[tuple[int, int]] = []
    common: list[int] = []
    todo = [(at, 0, -1)]  # (equal so far, bytes compared, common prefix with the one before)
    while todo:
        members, depth, first = todo.pop()
        step = max(64, SLICE_BYTES // len(members))
        slices = sorted((segments[s][p + depth:p + depth + step], s, p) for s, p in members)
        groups: list[tuple[bytes, int, list[tuple[int, int]]]] = []
        for part, s, p in slices:
            if not groups or groups[-1][0] != part:
                groups.append((part, depth + _common(groups[-1][0], part) if groups else first, []))
            groups[-1][2].append((s, p))
        if len(groups) == 1 and len(groups[0][0]) == step and len(members) > 1:
            todo.append((members, depth + step, first))
            continue
        below = []
        for part, same, equal in groups:
            if len(equal) > 1 and len(part) == step:
                below.append((equal, depth + step, same))
            else:  # one suffix, or several that end here
                below.append((equal, -1, same))
        # In order: those that are settled go out as soon as all before them are.
        for equal, deep, same in reversed(below):
            todo.append((equal, deep, same))
        while todo and todo[-1][1] < 0:
            equal, _, same = todo.pop()
            order += equal
            common += [same] + [len(segments[equal[0][0]]) - equal[0][1]] * (len(equal) - 1)
    return order, common


def _repeats(segments: list[bytes], length: int) -> Iterator[tuple[list[tuple[int, int]], list[tuple[int, int, int]]]]:
    """Suffixes that share ``length`` bytes, as sorted (segment, place) pairs,
    and their maximal repeats as (size, first, end): a row per interval."""
    joined = np.frombuffer(b"".join(segments), np.uint8)
    sizes = np.array([len(s) for s in segments], np.int64)
    starts = np.cumsum(sizes) - sizes
    if not len(joined):
        return
    end = np.repeat(starts + sizes, sizes)
    place = np.flatnonzero(np.arange(len(joined)) + length <= end)
    if not len(place):
        return
    # Suffixes that share ``length`` bytes stand together: one sort of the
    # hashes of those bytes.  The scan below compares the bytes themselves.
    name = gram_hashes(joined, length)[place]
    by_name = np.argsort(name, kind="stable")
    order, names = place[by_name], name[by_name]
    first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]])
    ends = np.r_[first[1:], len(order)]
    # Left neighbours; none at the start of a segment.
    left = np.where(np.isin(order, starts), -1, joined[np.maximum(order - 1, 0)].astype(np.int64))
    low, high = np.minimum.reduceat(left, first), np.maximum.reduceat(left, first)
    for k in np.flatnonzero((ends - first > 1) & ((low != high) | (low < 0))):
        at = order[first[k]:ends[k]]
        s = np.searchsorted(starts, at, side="right") - 1
        where, common = _sorted_suffixes(list(zip(s.tolist(), (at - starts[s]).tolist(), strict=True)), segments)
        yield where, list(_intervals([segments[s][p - 1] if p else -1 for s, p in where], common, length))


def maximal_repeats(segments: list[bytes], length: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(size, occurrences as (segment, place)) of every repeat of at least
    ``length`` bytes that no left neighbour extends in all its occurrences."""
    return [(size, where[a:b]) for where, found in _repeats(segments, length) for size, a, b in found]


def _intervals(lefts: list[int], common: list[int], length: int) -> Iterator[tuple[int, int, int]]:
    """Stack scan of a sorted run of suffixes: size, first and end of each
    interval with different left neighbours (-1, none, differs from all)."""
    both = lambda a, b: a if a == b else -1
    stack: list[tuple[int, int, int]] = []  # (common prefix, first suffix, left neighbour of all or -1)
    for i in range(1, len(lefts) + 1):
        same = common[i] if i < len(lefts) else -1
        start, left = i - 1, lefts[i - 1]
        while stack and stack[-1][0] > same:
            size, start, inner = stack.pop()
            left = both(inner, left)
            if left < 0:
                yield size, start, i
        if stack and stack[-1][0] == same:
            stack[-1] = (same, stack[-1][1], both(stack[-1][2], left))
        elif same >= length:
            stack.append((same, start, left))


def marked(contexts: list[tuple[bytes, int, bytes]], length: int) -> list[tuple[bytes, int, int]]:
    """(unit, start, end) of repeats among contexts ``(unit, start, bytes)``;
    contexts of a unit that meet become one segment."""
    units, offsets, parts = [], [], []
    for unit, start, data in sorted(contexts):
        if units and units[-1] == unit and start <= offsets[-1] + len(parts[-1]):
            parts[-1] += data[max(0, offsets[-1] + len(parts[-1]) - start):]
        else:
            units.append(unit)
            offsets.append(start)
            parts.append(bytearray(data))
    segments = [bytes(x) for x in parts]
    marks = []
    for where, found in _repeats(segments, length):
        # Inner intervals come first and are longer: the first to reach a
        # suffix marks it, and what is marked is stepped over.
        after = list(range(len(where) + 1))
        for size, a, b in found:
            i = a
            while i < b:
                if after[i] == i:
                    s, p = where[i]
                    marks.append((units[s], offsets[s] + p, offsets[s] + p + size))
                ahead = max(after[i], i + 1)
                after[i] = max(ahead, b)
                i = ahead
    return marks


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


# --- Spark ---------------------------------------------------------------------------

_ANCHOR = "key bigint, context bigint, unit binary, place bigint"


def _anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # copies add nothing
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                keys, contexts, places, rows = [], [], [], []
                for i, (unit, text) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True)):
                    if unit in seen:
                        continue
                    if len(seen) >= _UNITS:
                        seen.clear()
                    seen.add(unit)
                    data = text.encode()
                    p, k = anchors(data, length, gram)
                    keys.append(k)
                    places.append(p)
                    rows.append(np.full(len(p), i))
                    for q in p.tolist():
                        a, b = context(q, len(data), length, gram)
                        contexts.append(xxhash.xxh3_64_intdigest(data[a:b], q - a))
                if contexts:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)),
                         pa.array(np.array(contexts, np.uint64).view(np.int64)),
                         batch.column(0).take(pa.array(np.concatenate(rows))), pa.array(np.concatenate(places))],
                        names=["key", "context", "unit", "place"])

    return texts.mapInArrow(emit, _ANCHOR)


def _neighbours(rows: DataFrame) -> DataFrame:
    """id and reach: the longest common prefix of ``value`` with that of another
    row of the same ``part``; no row of a part alone.  ``rows``: id (unique),
    part (bigint), value (bytes).

    Spark sorts by part and value, and neighbours are compared; the first and
    last rows of the sorted partitions, two each, once more among themselves.
    """
    def reaches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int64()),
                 pa.array([h[2] if h[4] else None for h in held], pa.binary()), pa.array([h[3] for h in held], pa.int32()),
                 pa.array([h[4] for h in held], pa.bool_())], names=["id", "part", "value", "reach", "edge"])

        last = None  # id, part, value, reach (-1: no other), whether at an end
        for batch in batches:
            held = []
            for i, part, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shared = _common(last[2], value) if last is not None and last[1] == part else -1
                if last is not None:
                    held.append((*last[:3], max(last[3], shared), last[4]))
                last = (i, part, value, shared, last is None)
            yield out(held)
        if last is not None:
            yield out([(*last[:4], True)])

    schema = "id bigint, part bigint, value binary, reach int, edge boolean"
    ordered = rows.select("id", "part", "value").repartitionByRange("part", "value").sortWithinPartitions("part", "value")
    found = materialise(ordered.mapInArrow(reaches, schema), "reaches")
    ends = found.where("edge").select("id", "part", "value").repartition(1).sortWithinPartitions("part", "value")  # two a partition
    both = found.select("id", "reach").unionByName(ends.mapInArrow(reaches, schema).select("id", "reach"))
    return both.groupBy("id").agg(F.max("reach").alias("reach")).where("reach >= 0")


def _hot_marks(contexts: DataFrame, length: int, gram: int) -> DataFrame:
    """unit, start and end of what is covered of contexts of hot keys, one row
    each.  ``contexts``: key, unit, place, before (bytes ahead of the anchor,
    backwards) and after (bytes from the anchor on)."""
    rows = materialise(contexts.withColumns({
        "id": F.monotonically_increasing_id(), "before_part": F.xxhash64("key", "before"), "after_part": F.xxhash64("key", "after")}), "hot")

    def other(side: str) -> DataFrame:
        """By part: how far a context that differs on this side goes along."""
        kinds = rows.groupBy(f"{side}_part").agg(F.first("key").alias("part"), F.first(side).alias("value")) \
            .withColumnRenamed(f"{side}_part", "id")
        return _neighbours(kinds).select(F.col("id").alias(f"{side}_part"), F.col("reach").alias(f"{side}_other"))

    def alike(side: str, value: str) -> DataFrame:
        """By context: how far one that is equal on this side goes along on the
        other."""
        return _neighbours(rows.select("id", F.col(f"{side}_part").alias("part"), F.col(value).alias("value"))) \
            .select("id", F.col("reach").alias(f"{side}_alike"))

    both = (rows.join(other("before"), "before_part", "left").join(other("after"), "after_part", "left")
            .join(alike("after", "before"), "id", "left").join(alike("before", "after"), "id", "left"))
    # A string begins o bytes ahead of the anchor, for o from low to high.
    size = {side: F.octet_length(side) for side in ("before", "after")}
    found = {"after": (length - size["after"], F.col("after_alike")), "before": (length - F.col("before_alike"), size["before"])}
    spans = [F.when(low <= high, F.struct(low.alias("low"), high.alias("high"))) for low, high in found.values()]
    both = materialise(both.select(
        "id", "key", "unit", "place", "before", "after", *[x.alias(f"by_{side}") for side, x in zip(found, spans, strict=True)],
        F.greatest(length - F.col("after_other"), F.lit(0)).alias("low"), F.col("before_other").alias("high")), "bounds")
    # Offsets that any context of the key leaves open: its own bounds reach
    # beyond what it is known to share.
    first, last = F.greatest("by_after.high", "by_before.high"), F.least("by_after.low", "by_before.low")
    open_ = F.filter(F.sequence("low", "high"), lambda o: first.isNull() | (o > first) | (o < last))
    asked = (both.where("low <= high").select("key", F.explode(open_).alias("o")).distinct()
             .groupBy("key").agg(F.collect_list("o").alias("asked")))  # at most ``length`` of them
    asking = skewed_left_join(both.where("low <= high").select("id", "key", "before", "after", "low", "high"), asked, ["key"])

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, before, after, low, high, offsets in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data, at = before[::-1] + after, len(before)
                held: dict[bytes, tuple[int, int, int]] = {}  # a string that comes again in its context is one row
                for o in offsets:
                    if low <= o <= high:
                        name = xxhash.xxh3_128_digest(data[at - o:at - o + length])
                        least, most, n = held.get(name, (o, o, 0))
                        held[name] = (min(least, o), max(most, o), n + 1)
                rows += [(i, name, *x) for name, x in held.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int32()),
                 pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.int64())], names=["id", "string", "least", "most", "n"])

    tried = materialise(asking.where(F.col("asked").isNotNull()).select("id", "before", "after", "low", "high", "asked")
                        .mapInArrow(strings, "id bigint, string binary, least int, most int, n bigint"), "strings")
    again = tried.groupBy("string").agg(F.sum("n").alias("times")).where("times > 1").select("string")
    counted = tried.join(again, "string").groupBy("id").agg(F.struct(F.min("least").alias("low"), F.max("most").alias("high")).alias("counted"))
    all_ = both.join(counted, "id", "left")
    ways = ("by_after", "by_before", "counted")
    first = F.greatest(*[F.col(f"{w}.high") for w in ways])  # NULLs are skipped
    last = F.greatest(F.least(*[F.col(f"{w}.low") for w in ways]), F.lit(0))
    return all_.where(first.isNotNull()).select("unit", (F.col("place") - first).alias("start"), (F.col("place") - last + length).alias("end"))


def _spans(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """unit, text and the sorted merged spans of each distinct text that has
    any.  ``texts``: unit (binary), text (string)."""
    texts = texts.where(F.octet_length("text") >= length)
    copied = texts.groupBy("unit").agg(F.count("*").alias("n")).where("n > 1").select("unit")
    found = _anchors(texts, length, gram)
    keys = found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    repeated = materialise(found.join(keys, "key"), "anchors")
    pairs = repeated.groupBy("key", "context").agg(
        F.count("*").alias("n"), F.min(F.struct("unit", "place")).alias("one"))
    ways = pairs.groupBy("key").agg(F.count("*").alias("ways"))
    pairs = materialise(pairs.join(ways, "key"), "contexts")
    whole = (repeated.join(pairs.where("n > 1").select("key", "context"), ["key", "context"])
             .select("unit", "place", F.lit(None).cast("bigint").alias("key"), F.lit(0).cast("bigint").alias("ways"))
             .distinct())  # copies of a text: once
    look = pairs.where("ways > 1").select("one.unit", "one.place", "key", "ways")
    per_unit = whole.unionByName(look).groupBy("unit").agg(F.collect_list(F.struct("place", "key", "ways")).alias("places")) \
        .join(copied.withColumn("copied", F.lit(True)), "unit", "full")
    # One row per distinct text, copies combined before they are moved.
    one = texts.groupBy("unit").agg(F.first("text").alias("text"))
    none = F.array().cast("array<struct<place:bigint,key:bigint,ways:bigint>>")
    held = materialise(one.join(per_unit, "unit").select(
        "unit", "text", F.coalesce("places", none).alias("places"), F.coalesce("copied", F.lit(False)).alias("copied")), "texts")

    def cut(hot: bool):
        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for unit, text, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    data, rows = text.encode(), []
                    for x in places:
                        if x["key"] is None or (x["ways"] > HOT) != hot:
                            continue
                        p = x["place"]
                        a, b = context(p, len(data), length, gram)
                        rows.append((x["key"], unit, p, data[a:p][::-1], data[p:b]) if hot else (x["key"], unit, a, data[a:b]))
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=(
                            ["key", "unit", "place", "before", "after"] if hot else ["key", "unit", "start", "data"]))
        return emit

    looked = held.select("unit", "text", "places")
    hot = look.where(F.col("ways") > HOT)
    hot_marks = held.where("false").select("unit", F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("end"))
    if not hot.isEmpty():
        hot_marks = _hot_marks(looked.mapInArrow(cut(True), "key bigint, unit binary, place bigint, before binary, after binary"), length, gram)

    n = look.where(F.col("ways") <= HOT).count()
    batches = max(1, math.ceil(n * 2 * length / BATCH_BYTES))

    def scan(group: pa.Table) -> pa.Table:
        rows = marked(list(zip(*(group[c].to_pylist() for c in ("unit", "start", "data")), strict=True)), length)
        return pa.table({"unit": pa.array([r[0] for r in rows], pa.binary()),
                         "start": pa.array([r[1] for r in rows], pa.int64()),
                         "end": pa.array([r[2] for r in rows], pa.int64())})

    marks = (looked.mapInArrow(cut(False), "key bigint, unit binary, start bigint, data binary")
             .withColumn("batch", F.pmod(F.xxhash64("key"), F.lit(batches))).groupBy("batch")
             .applyInArrow(scan, "unit binary, start bigint, end bigint").unionByName(hot_marks)
             .groupBy("unit").agg(F.collect_list(F.struct("start", "end")).alias("marks")))
    every = held.join(marks, "unit", "left").select(
        "unit", "text", "copied", F.transform(F.filter("places", lambda x: x["key"].isNull()), lambda x: x["place"]).alias("whole"),
        F.coalesce("marks", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("marks"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, copied_, whole_, marks_ in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                data = text.encode()
                spans = merged([context(p, len(data), length, gram) for p in whole_]
                               + [(m["start"], m["end"]) for m in marks_]) if not copied_ else [(0, len(data))]
                kept, at = [], 0
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                kept.append(data[at:])
                kept = b"".join(kept)
                for column, v in zip(out, (len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                                      kept.decode(errors="replace")),
                                     strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.string()), pa.array(out[3], pa.string())],
                names=["unit", "n_removed", "n_spans", "kept_sha256", "kept"])

    return every.mapInArrow(settle, "unit binary, n_removed bigint, n_spans bigint, kept_sha256 string, kept string") \
        .where("n_spans > 0")


def _plain(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    ship(docs.sparkSession)
    df = only(docs, [doc_id, text]).toDF("doc_id", "text")
    return df.select("doc_id", text_or_empty(F.col("text")).alias("text")).withColumn("unit", text_key(F.col("text")))


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    df = _plain(docs, doc_id, text)
    spans = _spans(df.select("unit", "text"), length, gram).drop("kept")
    zero = F.lit(0).cast("bigint")
    return (df.select("doc_id", "unit", F.octet_length("text").cast("bigint").alias("n_bytes"),
                      F.sha2(F.col("text").cast("binary"), 256).alias("whole"))
            .join(spans, "unit", "left")
            .select("doc_id", "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"),
                    F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("kept_sha256", "whole").alias("kept_sha256")))


def remove(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``docs`` with the repeated bytes cut out; where a cut splits a
    character, its remaining bytes become replacement characters."""
    unit = fresh(docs, "unit")
    df = _plain(docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text}`").alias("text")), "doc_id", "text")
    keyed = docs.withColumn(unit, text_key(text_or_empty(F.col(f"`{text}`"))))
    cut_out = fresh(keyed, "kept")
    kept = _spans(df.select("unit", "text"), length, gram).select(F.col("unit").alias(unit), F.col("kept").alias(cut_out))
    clean = F.coalesce(F.col(cut_out), F.col(f"`{text}`"))
    return (keyed.join(kept, unit, "left").withColumn(text, clean).select(*[F.col(f"`{c}`") for c in docs.columns]))
