"""Best-fit packing: sum-of-squares packing of token sequences.

:func:`tokenise` gives every document its token ids and cuts longer ones into
full pieces; :func:`pack` places the pieces into sequences of ``capacity``
tokens.  A piece goes to the open sequence, or a new one, after which the sum
over all gaps of (open sequences with that gap) squared is smallest; ties go
to the smallest gap, and an open sequence before a new one.

Only lengths decide, so pieces are dealt evenly (round robin, whatever their
ids) into groups of at most about ``group_rows``, each packed by itself by one
task with a table of ``capacity`` counters; a group leaves a handful of
sequences open, some hundredths of a percent.  Each group is packed in its
order and in order of falling length, and the better of the two stays.

White space parts the tokenizer's words.  A batch of texts is split and reduced
to its different words at once; letters and the signs after them are then looked
up apart, in a memory bounded by ``_MEMORY`` entries for each worker, and the ids
of the batch are gathered from it as arrays.  What was not met before goes through
the tokenizer itself; a full memory keeps the half met in most batches.

Defined results: a null or empty text is one piece holding only the end id;
repeated rows are separate documents; an empty table gives an empty result;
other columns are not read by :func:`tokenise` and carried by :func:`pack`.
"""

from __future__ import annotations

import math
import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import fresh, only, ship
from tidemark.sources.scratch import materialise

CAPACITY = 4096
END_ID = 1
GROUP_ROWS = 100_000
_MEMORY = 400_000
#: Ids remembered, for each word that fits into the memory.
_IDS_A_WORD = 8
#: Words longer than this are not remembered.
_LONG_WORD = 64
#: Texts and words (unless a text has more) that are looked up together.
_BATCH, _BATCH_CHARS = 500, 4_000_000
#: Signs that end a word and are a piece of their own.
_SIGNS = ".,;:!?#*$%&|<>"
#: Special ids are written with this, in letters that the case matters of.
_SPECIAL = "<|"


class _Words:
    """Token ids of words, a row each in growing arrays.  When full, it keeps the
    half of them (and of the ids) that was asked for most often."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.row: dict[str, int] = {}
        self.start, self.ids = np.zeros(1, np.int32), np.zeros(0, np.uint32)
        self.asked = np.zeros(0, np.int32)

    def forget(self) -> None:
        """Keeps the words asked for most often, of equals the latest."""
        known = np.fromiter(self.row.values(), np.int64, len(self.row))
        order = known[np.lexsort((-known, -self.asked[known]))][:_MEMORY // 2]
        size = np.diff(self.start)
        order = order[np.cumsum(size[order]) <= _IDS_A_WORD * _MEMORY // 2]
        kept = np.sort(order)
        new = np.full(len(size), -1, np.int64)
        new[kept] = np.arange(len(kept))
        self.row = {w: n for w, n in zip(self.row, new[known].tolist(), strict=True) if n >= 0}
        self.ids, ends = _gathered(self.ids, self.start[kept], size[kept])
        self.start, self.asked = ends.astype(np.int32), self.asked[kept] // 2

    def rows(self, words: list[str]) -> np.ndarray:
        """Rows of different words: ``ids[start[r]:start[r + 1]]`` are theirs."""
        found, missing = self.look_up(words)
        if missing:
            if len(self.asked) + len(missing) > _MEMORY or len(self.ids) > _IDS_A_WORD * _MEMORY:
                self.forget()
                found, missing = self.look_up(words)
            new = [words[i] for i in missing]
            ids = self.learn(new)
            first = len(self.asked)
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            self.start = np.r_[self.start, self.start[-1] + np.cumsum(size, dtype=np.int32)]
            self.ids = np.r_[self.ids, np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))]
            self.asked = np.r_[self.asked, np.zeros(len(new), np.int32)]
            found[missing] = np.arange(first, first + len(new))
            self.row.update(zip(new, range(first, first + len(new)), strict=True))
            for w in [w for w in new if len(w) > _LONG_WORD]:
                del self.row[w]
        self.asked[found] += 1
        return found

    def look_up(self, words: list[str]) -> tuple[np.ndarray, list[int]]:
        """Rows of words (-1: not known), and the places of those not known."""
        found = np.fromiter(map(self.row.get, words, repeat(-1)), np.int32, len(words))
        return found, np.flatnonzero(found < 0).tolist()

    def learn(self, words: list[str]) -> list[list[int]]:
        """Ids of new words, each by itself."""
        out: list = [None] * len(words)
        tokenize = self.tokenizer.model.tokenize
        lettered: list[int] = []
        single: list[int] = []
        for i, w in enumerate(words):
            if w.isascii() and w.isalpha() and w.islower():
                # Such letters are one piece, as they stand.
                out[i] = [t.id for t in tokenize(w)]
            elif _one_piece(w):
                lettered.append(i)
            else:
                single.append(i)
        # Other letters go through the tokenizer many at a time, in one line; it
        # tells which piece an id belongs to.
        for at in range(0, len(lettered), 4000):
            part = lettered[at:at + 4000]
            found = self.tokenizer.encode(" ".join([words[i] for i in part]), add_special_tokens=False)
            ids, piece = found.ids, np.array(found.word_ids, np.int64)
            first = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]]).tolist()
            if len(first) != len(part):
                single += part
                continue
            for i, a, b in zip(part, first, [*first[1:], len(ids)], strict=True):
                out[i] = ids[a:b]
        for at in range(0, len(single), 4000):
            part = single[at:at + 4000]
            for i, e in zip(part, self.tokenizer.encode_batch([words[i] for i in part], add_special_tokens=False), strict=True):
                out[i] = e.ids
        return out


_known: dict[str, _Words] = {}


def _one_piece(word: str) -> bool:
    """Whether the tokenizer takes a word as one piece of letters."""
    return word.isalpha() and word.lower().isalpha() and unicodedata.is_normalized("NFC", word)


def _listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


def _gathered(ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``ids[first:first + size]`` of all runs on end, and where each begins (and
    the end)."""
    ends = np.r_[0, np.cumsum(size, dtype=np.int64)]
    at = np.repeat((first - ends[:-1]).astype(np.int32), size)
    at += np.arange(len(at), dtype=np.int32)
    return ids[at], ends


def _parted(words: pa.Array) -> tuple[pa.Array, np.ndarray, list[str]]:
    """Different words as the tokenizer parts them: letters (or, where they are
    not plain, the whole word), which words end in signs, and these signs."""
    stems = pc.ascii_rtrim(words, characters=_SIGNS)
    plain = pc.ascii_is_alpha(stems)
    signs = (pc.binary_length(words).to_numpy(zero_copy_only=False)
             - pc.binary_length(stems).to_numpy(zero_copy_only=False))
    cut = plain.to_numpy(zero_copy_only=False)
    other = np.flatnonzero(~cut & (signs > 0))
    cut[other] = [_one_piece(s) for s in _listed(stems.take(pa.array(other)))]
    keys = pc.if_else(pa.array(cut), stems, words)
    # The tokenizer lower-cases ASCII letters, but for special ids.
    lower = pc.and_not(pc.string_is_ascii(keys), pc.match_substring(keys, _SPECIAL))
    keys = pc.if_else(lower, pc.ascii_lower(keys), keys)
    ending = np.flatnonzero(cut & (signs > 0))
    tails = [w[-n:] for w, n in zip(_listed(words.take(pa.array(ending))), signs[ending].tolist(), strict=True)]
    return keys, ending, tails


def _encoded(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of some texts, and where each text's begin (and the end)."""
    if path not in _known:
        _known[path] = _Words(path)
    known = _known[path]
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    words = pc.dictionary_encode(lists.flatten())
    n = len(words.dictionary)
    keys, ending, tails = _parted(words.dictionary)
    coded = pc.dictionary_encode(pa.concat_arrays([keys, pa.array(tails, pa.large_string())]))
    row = known.rows(_listed(coded.dictionary))[coded.indices.to_numpy(zero_copy_only=False)]
    # Ids of the different words: each one's key, then its signs.
    first, size = np.zeros(2 * n, np.int32), np.zeros(2 * n, np.int32)
    for place, rows in ((2 * np.arange(n), row[:n]), (2 * ending + 1, row[n:])):
        first[place], size[place] = known.start[rows], known.start[rows + 1] - known.start[rows]
    ids, ends = _gathered(known.ids, first, size)
    ends = ends[::2]
    word = words.indices.to_numpy(zero_copy_only=False)
    ids, ends = _gathered(ids, ends[word], np.diff(ends)[word])
    return ids, ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]


def encode(texts: list[str | None], path: str) -> list[bytes]:
    """Token ids of each text, little-endian unsigned 32-bit, without an end."""
    ids, at = _encoded(pa.array(texts, pa.string()), path)
    return [ids[a:b].astype("<u4").tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def _slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """First and length of runs of texts that are looked up together."""
    size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    at, held = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > at and (held + n > _BATCH_CHARS or i - at >= _BATCH):
            yield at, i - at
            at, held = i, 0
        held += n
    if at < len(size):
        yield at, len(size) - at


def tokenise(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
             capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32 and (unless
    switched off) ids (bytes)."""
    ship(docs.sparkSession)
    df = only(docs, [doc_id, text]).toDF("doc_id", "text").withColumn("text", F.col("text").cast("string"))
    schema = StructType([StructField("doc_id", df.schema["doc_id"].dataType)]).add("piece", "integer") \
        .add("start", "long").add("length", "long").add("ids_crc32", "long")
    if with_ids:
        schema = schema.add("ids", "binary")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first, n in _slices(whole.column(1)):
                batch = whole.slice(first, n)
                ids, at = _encoded(batch.column(1), tokenizer_path)
                # Each text's ids and its end id.
                at = at + np.arange(n + 1)
                data = np.full(at[-1], end_id, "<u4")
                inside = np.ones(at[-1], bool)
                inside[at[1:] - 1] = False
                data[inside] = ids
                size = np.diff(at)
                count = -(-size // capacity)
                doc = np.repeat(np.arange(n), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, size[doc] - start)
                place = at[doc] + start
                view = memoryview(data).cast("B")
                parts = [view[4 * a:4 * (a + m)] for a, m in zip(place.tolist(), length.tolist(), strict=True)]
                columns = [batch.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                           pa.array(length), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                if with_ids:
                    columns.append(pa.array([bytes(x) for x in parts], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.mapInArrow(pieces, schema)


def sum_of_squares(lengths: list[int], capacity: int) -> tuple[list[int], list[int], int]:
    """Bin and offset of each length, and how many bins were opened."""
    twice = np.zeros(capacity + 1, np.int64)  # twice the open bins, by gap
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, made = [], [], 0
    for n in lengths:
        gap = capacity
        if n < capacity:
            change = np.where(twice[n:capacity] > 0, twice[:capacity - n] - twice[n:capacity], 1 << 60)
            change[0] -= 1  # a filled bin counts for no gap
            j = int(change.argmin())
            if change[j] < 1 << 59 and change[j] + 2 <= twice[capacity - n] + 1:
                gap = j + n
        if gap == capacity:
            at, made = made, made + 1
        else:
            at = open_bins[gap].pop()
            twice[gap] -= 2
        bins.append(at)
        offsets.append(capacity - gap)
        if gap > n:
            open_bins[gap - n].append(at)
            twice[gap - n] += 2
    return bins, offsets, made


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY,
         group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` (underscored if taken).
    Lengths lie in 1 .. capacity."""
    ship(pieces.sparkSession)
    n = max(1, math.ceil(pieces.count() / group_rows))
    names = [fresh(pieces, "sequence_id"), fresh(pieces, "offset")]
    schema = StructType([*pieces.schema.fields, *(StructField(c, LongType()) for c in names)])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (found := list(batches)):
            return
        rows = pa.Table.from_batches(found)
        lengths = np.array(rows[length].to_pylist(), np.int64)
        best = None
        for order in (np.arange(len(lengths)), np.argsort(-lengths, kind="stable")):
            bins, offsets, made = sum_of_squares(lengths[order].tolist(), capacity)
            if best is None or made < best[2]:
                best = ([0] * len(lengths), [0] * len(lengths), made)
                for i, b, o in zip(order.tolist(), bins, offsets, strict=True):
                    best[0][i], best[1][i] = b, o
        first = TaskContext.get().partitionId() << 40
        rows = rows.append_column(names[0], pa.array([first + b for b in best[0]], pa.int64()))
        yield from rows.append_column(names[1], pa.array(best[1], pa.int64())).to_batches(10_000)

    return pieces.repartition(n).mapInArrow(placed, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, its doc_ids in order, and
    their ids one after another (at most ``capacity`` tokens)."""
    return (packed.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
            .select("sequence_id", F.col("parts.doc_id").alias("doc_ids"),
                    F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids")))


def pack_documents(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text",
                   capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Tokenises and packs ``docs``.  The pieces are written once, so that the
    tokenizer runs once; their ids are written only if ``with_ids``."""
    pieces = materialise(tokenise(docs, tokenizer_path, doc_id, text, capacity, end_id, with_ids), "pieces")
    return pack(pieces, "length", capacity)
