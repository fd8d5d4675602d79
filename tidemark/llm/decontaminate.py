"""Benchmark decontamination by latent semantic retrieval.

1. *Tokens.*  Every text becomes the benchmark's word numbers, 0 for words no
   item has; written once, all later passes read these.
2. *Weights.*  Document frequencies over the whole corpus give each word
   ``idf / sqrt(df)``: TF-IDF with unit columns, so that the words that tell
   an item from others carry the space.  Words in more than ``COMMON`` of the
   documents have no latent weight, unless an item has no rarer ones (they
   still count in step 5).
3. *Randomised SVD.*  Passages of ``PASSAGE`` words, the items among them, are
   the rows of a matrix A.  Two distributed passes compute ``A^T (A Q)`` for a
   random, then an orthonormal basis Q; every core adds up its part, the parts
   are added in a tree of bounded fan-in, and only the words x rank matrix of
   one block of items reaches the driver.
4. *Candidates.*  Passages at every ``STRIDE`` words are projected and compared
   with the block's items by cosine.
5. *Checks.*  A candidate counts if the longest common subsequence of item and
   the words around the passage covers ``LEAST_LCS`` of the item (paraphrases
   and partial copies keep most words in order).  If the benchmark has an
   ``answer`` column, at least half of the words of the item's answer have to
   stand there too; an item without one is judged by the subsequence alone.

The benchmark is the query set: it is read in blocks of ``BLOCK_ITEMS`` items,
each compared with all passages, so what is sent to the tasks is bounded by a
block (its words times its rank).

Defined results: a null or wordless text matches nothing, nor does a null or
wordless item; items of fewer than ``SHORT_ITEM`` words have to occur whole;
repeated rows give repeated results, equal items each their own; an empty
table gives an empty result; other columns are not read by :func:`find` and
kept by :func:`clean`.  Whole texts are searched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidemark.llm.common import fresh, only, ship, text_or_empty
from tidemark.llm.jaccard import text_key
from tidemark.sources.scratch import materialise

PASSAGE = 48
STRIDE = 16
BLOCK_ITEMS = 256
OVERSAMPLE = 32
COMMON = 0.02
LEAST_COSINE = 0.3
LEAST_LCS = 0.6
SHORT_ITEM = 6
#: Words of an item that have a latent weight at least, however common.
LEAST_KNOWN = 8
SEED = 11
_ADDED_BYTES = 64 << 20
_WORD = re.compile(r"[^\W_]+")


def words_in(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class Block:
    """A block of items: their words numbered from 1."""

    def __init__(self, items: list[tuple]) -> None:
        self.ids = [i for i, _, _ in items]
        words = [words_in(t) for _, t, _ in items]
        answers = [words_in(a) for _, _, a in items]
        self.number = {w: k + 1 for k, w in enumerate(sorted({w for ws in words + answers for w in ws}))}
        self.items = [np.array([self.number[w] for w in ws], np.int32) for ws in words]
        self.answers = [{self.number[w] for w in a} for a in answers]
        #: Words of its answer that an item needs at least.
        self.needed = [-(-len(a) // 2) for a in self.answers]

    def weigh(self, df: np.ndarray, n_docs: int) -> np.ndarray:
        """Weights by word number; words of answers alone have none."""
        idf = np.log((1 + n_docs) / (1 + df)) + 1
        known = (df <= COMMON * n_docs) | (df <= 2)
        asked = np.zeros(len(df), bool)
        for item in self.items:
            asked[item] = True
        known &= asked
        for item in self.items:
            rare = sorted(set(item.tolist()), key=lambda w: (-idf[w], w))
            if known[rare].sum() < LEAST_KNOWN:
                known[rare[:LEAST_KNOWN]] = True
        known[0] = False
        self.weight = np.where(known, idf / np.sqrt(np.maximum(df, 1)), 0.0)
        return self.weight


def lcs(masks: dict[int, int], n: int, region: list[int]) -> int:
    """Length of the longest common subsequence of an item of ``n`` words,
    given as a mask of places for each word, and a region (bit-parallel)."""
    full = (1 << n) - 1
    v = full
    for w in region:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def masks_of(item: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        out[w] = out.get(w, 0) | (1 << i)
    return out


# --- passes over the tokens -----------------------------------------------------------

def _tokens(docs: DataFrame, block: Block) -> DataFrame:
    """id and terms (word numbers) of every text."""
    number = block.number
    schema = StructType([docs.schema["id"], StructField("terms", ArrayType(IntegerType()))])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [np.fromiter((number.get(w, 0) for w in words_in(t)), np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.list_(pa.int32()))],
                                             names=["id", "terms"])

    return materialise(docs.select("id", "text").mapInArrow(emit, schema), "terms")


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All terms of a batch, and where each document's begin (and the end)."""
    lists = batch.column(batch.schema.get_field_index("terms"))
    lists = lists.cast(pa.list_(pa.int32()))
    ends = lists.offsets.to_numpy()
    return lists.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]], ends - ends[0]


def _per_core(tokens: DataFrame) -> DataFrame:
    """``tokens`` in as many partitions as there are cores, or fewer: what each
    of them adds up does not grow in number with the data."""
    return tokens.coalesce(max(1, tokens.sparkSession.sparkContext.defaultParallelism))


def _added(parts: DataFrame, count: int) -> np.ndarray:
    """The sum of all partitions' arrays (column ``a``, float64 bytes), added
    up in a tree; a task reads some ``_ADDED_BYTES`` and holds one array."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count)
        for batch in batches:
            for a in batch.column(0).to_pylist():
                total += np.frombuffer(a, np.float64)
        yield pa.RecordBatch.from_pydict({"a": [total.tobytes()]})

    fan = max(2, min(32, _ADDED_BYTES // (8 * count + 1)))
    n = parts.sparkSession.sparkContext.defaultParallelism
    while n > 1:
        n = -(-n // fan)
        parts = parts.repartition(n).mapInArrow(add, "a binary")
    rows = parts.collect()  # one array
    return sum((np.frombuffer(bytes(r[0]), np.float64) for r in rows), np.zeros(count))


def _frequencies(tokens: DataFrame, n_words: int) -> tuple[np.ndarray, int]:
    """Document frequencies by word number, and how many documents there are."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_words + 2)
        for batch in batches:
            terms, ends = _flat(batch)
            doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            seen = np.unique(doc.astype(np.int64) * (n_words + 1) + terms)
            total[:-1] += np.bincount(seen % (n_words + 1), minlength=n_words + 1)
            total[-1] += batch.num_rows
        yield pa.RecordBatch.from_pydict({"a": [total.tobytes()]})

    total = _added(_per_core(tokens.select("terms")).mapInArrow(count, "a binary"), n_words + 2)
    return total[:-1], int(total[-1])


def gram_times(terms: np.ndarray, row: np.ndarray, weight: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``A^T (A basis)`` of the passages ``row`` (sorted) with these terms."""
    out = np.zeros_like(basis)
    keep = weight[terms] > 0
    terms, row = terms[keep], row[keep]
    if not len(terms):
        return out
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    size = np.diff(np.r_[first, len(row)])
    lone = size == 1  # such a row adds to its own word only
    alone = np.bincount(terms[first[lone]], minlength=len(basis))
    out += (alone * weight ** 2)[:, None] * basis
    many = np.repeat(~lone, size)
    terms, size = terms[many], size[~lone]
    for at in range(0, len(size), 2000):  # some MB at a time
        a = int(size[:at].sum())
        t, n = terms[a:a + int(size[at:at + 2000].sum())], size[at:at + 2000]
        projected = np.add.reduceat(weight[t][:, None] * basis[t], np.cumsum(n) - n, axis=0)
        order = np.argsort(t, kind="stable")
        t_sorted = t[order]
        starts = np.flatnonzero(np.r_[True, t_sorted[1:] != t_sorted[:-1]])
        spread = np.add.reduceat(projected[np.repeat(np.arange(len(n)), n)[order]], starts, axis=0)
        out[t_sorted[starts]] += weight[t_sorted[starts]][:, None] * spread
    return out


def _passages(terms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Passage number of each term: PASSAGE words each, none across texts."""
    size = np.diff(ends)
    rows = -(-size // PASSAGE)
    at = np.arange(len(terms)) - np.repeat(ends[:-1], size)
    return np.repeat(np.cumsum(rows) - rows, size) + at // PASSAGE


def _basis(tokens: DataFrame, block: Block) -> np.ndarray:
    """Right singular vectors, a row per word number."""
    weight, n = block.weight, len(block.weight)
    rank = min(n, len(block.items) + OVERSAMPLE)
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((n, rank)))[0]
    items = np.concatenate(block.items) if block.items else np.zeros(0, np.int32)
    item_row = np.repeat(np.arange(len(block.items)), [len(i) for i in block.items])
    for _ in range(2):
        sent = q.astype(np.float32)

        def multiply(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            total = np.zeros(sent.shape)
            for batch in batches:
                terms, ends = _flat(batch)
                total += gram_times(terms, _passages(terms, ends), weight.astype(np.float32), sent)
            yield pa.RecordBatch.from_pydict({"a": [total.tobytes()]})

        y = _added(_per_core(tokens.select("terms")).mapInArrow(multiply, "a binary"), n * rank).reshape(n, rank)
        y = y + gram_times(items, item_row, weight, q)
        last, q = q, np.linalg.qr(y)[0]
    # Rayleigh-Ritz: the best directions first.
    values, vectors = np.linalg.eigh((last.T @ y + y.T @ last) / 2)
    return (last @ vectors[:, ::-1]).astype(np.float32)


def _search(tokens: DataFrame, block: Block, basis: np.ndarray) -> DataFrame:
    """id, item (number), cosine and lcs share of every match."""
    weight = block.weight.astype(np.float32)
    projected = weight[:, None] * basis
    items = np.stack([projected[i].sum(axis=0) if len(i) else np.zeros(basis.shape[1], np.float32) for i in block.items])
    norm = np.linalg.norm(items, axis=1, keepdims=True)
    items = np.divide(items, norm, out=np.zeros_like(items), where=norm > 1e-9)
    places, sizes = [masks_of(i) for i in block.items], [len(i) for i in block.items]
    answers, needed = block.answers, block.needed
    schema = StructType([tokens.schema["id"]]).add("item", "integer").add("cosine", "double").add("lcs", "double")

    def matches(terms: np.ndarray, ends: np.ndarray) -> list[tuple[int, int, float, float]]:
        size = np.diff(ends)
        n_blocks = -(-size // STRIDE) + PASSAGE // STRIDE  # a gap between texts
        first_block = np.cumsum(n_blocks) - n_blocks
        known = np.flatnonzero(weight[terms] > 0)
        doc = np.searchsorted(ends, known, side="right") - 1
        at = first_block[doc] + (known - ends[doc]) // STRIDE
        if not len(known):
            return []
        starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        held, n_held = at[starts], np.diff(np.r_[starts, len(at)])
        sums = np.add.reduceat(projected[terms[known]], starts, axis=0)
        span = PASSAGE // STRIDE
        windows = np.unique(np.concatenate([held - i for i in range(span)]))
        total = np.zeros((len(windows), sums.shape[1]), np.float32)
        n_terms = np.zeros(len(windows), np.int64)
        for i in range(span):
            k = np.minimum(np.searchsorted(held, windows + i), len(held) - 1)
            hit = held[k] == windows + i
            total[hit] += sums[k[hit]]
            n_terms[hit] += n_held[k[hit]]
        use = n_terms > 1
        windows, total = windows[use], total[use]
        norms = np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
        cosine = (total / norms) @ items.T
        found: dict[tuple[int, int], tuple[float, float]] = {}
        for w, k in np.argwhere(cosine >= LEAST_COSINE).tolist():
            d = int(np.searchsorted(first_block, max(windows[w], 0) + (span - 1), side="right") - 1)
            begin = int(ends[d]) + (int(windows[w]) - int(first_block[d])) * STRIDE
            region = terms[max(int(ends[d]), begin - sizes[k]):min(int(ends[d + 1]), begin + PASSAGE + sizes[k])].tolist()
            share = lcs(places[k], sizes[k], region) / sizes[k]
            near = answers[k].intersection(region)
            if share >= (LEAST_LCS if sizes[k] >= SHORT_ITEM else 1) and len(near) >= needed[k]:
                old = found.get((d, k), (0.0, 0.0))
                found[d, k] = (max(old[0], float(cosine[w, k])), max(old[1], share))
        return [(d, k, c, s) for (d, k), (c, s) in sorted(found.items())]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 200):
                batch = whole.slice(start, 200)
                rows = matches(*_flat(batch))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array([r[0] for r in rows])), pa.array([r[1] for r in rows], pa.int32()),
                         pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows])], names=schema.names)

    return tokens.mapInArrow(search, schema)


# --- operator -----------------------------------------------------------------------

def _blocks(benchmark: DataFrame, item_id: str, text: str, answer: str | None) -> Iterator[Block]:
    """The items in blocks; one block at a time is on the driver."""
    columns = [F.col(f"`{item_id}`"), F.col(f"`{text}`").cast("string"),
               F.col(f"`{answer}`").cast("string") if answer else F.lit(None).cast("string")]
    held = []
    for row in benchmark.select(*columns).toLocalIterator():
        held.append(tuple(row))
        if len(held) == BLOCK_ITEMS:
            yield Block(held)
            held = []
    if held:
        yield Block(held)


def _matches(docs: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, answer: str | None) -> DataFrame:
    """id, item_id, cosine, lcs of every match; ``docs``: id, text."""
    spark = docs.sparkSession
    ship(spark)
    out = None
    for block in _blocks(benchmark, item_id, item_text, answer):
        if not block.number:
            continue
        tokens = _tokens(docs, block)
        block.weigh(*_frequencies(tokens, len(block.number)))
        found = _search(tokens, block, _basis(tokens, block))
        names = spark.createDataFrame([(i, v) for i, v in enumerate(block.ids)], StructType(
            [StructField("item", IntegerType())]).add("item_id", benchmark.schema[item_id].dataType))
        found = found.join(F.broadcast(names), "item").drop("item")  # at most BLOCK_ITEMS rows
        out = found if out is None else out.unionByName(found)
    if out is None:
        kind = dict(benchmark.dtypes)[item_id]
        return docs.where("false").select("id", F.lit(0.0).alias("cosine"), F.lit(0.0).alias("lcs"),
                                          F.lit(None).cast(kind).alias("item_id"))
    return out


def find(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
         item_text: str = "text", answer: str | None = None) -> DataFrame:
    """doc_id, item_id, cosine and lcs (share of the item) of every match."""
    df = only(docs, [doc_id, text]).toDF("id", "text").withColumn("text", F.col("text").cast("string"))
    return _matches(df, benchmark, item_id, item_text, answer).select(F.col("id").alias("doc_id"), "item_id", "cosine", "lcs")


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
          item_text: str = "text", answer: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose text matches no item."""
    key = fresh(docs, "key")
    keyed = docs.withColumn(key, text_key(text_or_empty(F.col(f"`{text}`"))))
    df = keyed.select(F.col(key).alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    found = materialise(_matches(df, benchmark, item_id, item_text, answer).select(F.col("id").alias(key)).distinct(), "matches")
    return keyed.join(found, key, "left_anti").drop(key)
