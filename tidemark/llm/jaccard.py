"""N-gram Jaccard join: a MinHash LSH forest with exact verification.

Equal texts are one *class* from the start.  Every class gets ``trees`` labels
of ``depth`` MinHash values; the labels of a tree, sorted, are a prefix trie.

1. *How far prefixes are shortened.*  Two sets at the threshold share a prefix
   of length d in a tree with probability ``threshold ** d``; :func:`depth_for`
   gives the longest prefix with which some tree finds them with the target
   recall.  Below it no prefix is shortened.
2. *Longest prefixes first.*  The rows of a tree that share the shortest prefix
   stand together, sorted by the rest of their labels, so neighbours share the
   longest prefixes of the trie.  Neighbours whose whole signatures agree as
   often as sets at the threshold would (:func:`least_agreement`) are joined.
3. *Shortened only where needed.*  Rows that share a prefix and are already
   joined, in this tree or an earlier one, are not looked at again.  Where a
   prefix holds rows that are not, it is shortened: all its rows that are not
   joined are compared, by signature.  The first trees are contracted before
   the others are read, so a group of copies is one row from then on.
4. *Verification.*  What has been joined is a candidate component; rows that
   merely share a template are in none.  Its classes are compared by exact set
   intersection in blocks of bounded size: every pair of blocks is a group of
   its own, so a component of any size spreads over the cluster, and what a
   group returns is a row per class (its links, and the least class it is
   linked to), never the pairs.  Shingle sets of the same documents are counted
   together, so a block costs a small matrix product.

Result per document: ``class_id`` (least doc_id of the documents connected by
links), ``text_id`` (least doc_id of the documents with the same text) and
``n_links`` (other texts with similarity at or above the threshold).

Defined results: words are runs of characters other than space and the
controls 9 to 13; a text of fewer than five words has one shingle, all its
words; null counts as empty; texts without a word are linked to nothing but
form one class by their equal text; repeated rows are copies; null ids come
after all others, a class of only null ids has a null class_id; an empty table
gives an empty result; other columns are not read by :func:`join` and kept by
:func:`deduplicate`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import fresh, only, ship, text_or_empty
from tidemark.llm.components import components
from tidemark.sources.scratch import materialise

WORDS = 5
THRESHOLD = 0.8
TREES = 32
DEPTH = 8
RECALL = 0.9999
SEED = 7
#: Trees that are contracted before the others.
FIRST_TREES = 4
#: Standard deviations by which signatures of sets at the threshold may differ.
DEVIATIONS = 4.0
#: Rows of a prefix that are compared in one group.
GROUP_ROWS = 1024
BLOCK_ROWS = 1024
BLOCK_SHINGLES = 600_000
_MEMORY = 500_000
_KEYS = 100_000
_PRIME = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """64-bit hashes of words; forgets all when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _MEMORY:
            self.clear()
        out = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = out
        return out


_words = _Words()


def words_in(text: str) -> list[str]:
    for blank in "\t\n\x0b\x0c\r":
        text = text.replace(blank, " ")
    return [w for w in text.split(" ") if w]


def shingles(text: str, n: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles."""
    h = np.fromiter(map(_words.__getitem__, words_in(text)), np.uint64)
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = (out ^ (out >> np.uint64(29))) * _PRIME + h[i:len(h) - n + 1 + i]
        out = (out ^ (out >> np.uint64(32))) * _PRIME
        out ^= out >> np.uint64(29)
    return np.unique(out)


def depth_for(threshold: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix with which two sets at the threshold are found with
    the wanted recall; two thirds of what may be lost are lost here, the rest
    by :func:`least_agreement`."""
    while depth > 1 and (1 - threshold ** depth) ** trees > (1 - recall) * 2 / 3:
        depth -= 1
    return depth


def least_agreement(threshold: float, values: int, deviations: float = DEVIATIONS) -> int:
    """How many of the bytes of two signatures agree at least, if the sets are
    at the threshold; bytes of different values agree by chance."""
    share = threshold + (1 - threshold) / 256
    return max(0, math.floor(values * share - deviations * math.sqrt(values * share * (1 - share))))


_factors: dict[tuple[int, int], np.ndarray] = {}


def minhashes(s: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> np.ndarray:
    """MinHash values of a set of 64-bit hashes: trees x depth."""
    n = trees * depth
    if (n, seed) not in _factors:
        rng = np.random.default_rng(seed)
        _factors[n, seed] = (rng.integers(0, 1 << 31, (n, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1))
    factor = _factors[n, seed]
    x = (s >> np.uint64(32)).astype(np.uint32)
    least = np.full(n, np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 512):
            np.minimum(least, (x[at:at + 512] * factor).min(axis=1), out=least)
    return least.reshape(trees, depth)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _PRIME
    return h ^ (h >> np.uint64(29))


def labels(values: np.ndarray, used: int) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Of each tree a hash of its shortest prefix, and the next two values, by
    which the trie is sorted on; and a byte of every value."""
    wide = values.astype(np.uint64)
    prefix = np.arange(len(values), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(used):
            prefix = _mixed(prefix * _PRIME + wide[:, i])
        signature = (_mixed(wide + np.uint64(1)) >> np.uint64(40)).astype(np.uint8).tobytes()
    rest = np.zeros(len(values), np.uint64)
    for i in range(used, min(used + 2, values.shape[1])):
        rest = (rest << np.uint64(32)) | wide[:, i]
    return prefix.view(np.int64), rest.view(np.int64), signature


def text_key(text: Column) -> Column:
    """128 bits that tell texts apart."""
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, 16)


def _classes(df: DataFrame, n: int, threshold: float, trees: int, depth: int, recall: float) -> DataFrame:
    """A row per distinct text: key, node, least doc_id, size, and of a text
    with words the prefixes and rests of its labels and its signature."""
    ship(df.sparkSession)
    used = depth_for(threshold, trees, depth, recall)
    longs = pa.list_(pa.int64())

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()  # a text that comes again is not labelled again
        for batch in batches:
            columns: list[list] = [[], [], [], []]
            for key, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                row: tuple = (None, None, None, None)
                if key not in seen:
                    s = shingles(text, n)
                    row = (len(s), *(labels(minhashes(s, trees, depth), used) if len(s) else ([], [], None)))
                    if len(seen) >= _KEYS:
                        seen.clear()
                    seen.add(key)
                for column, v in zip(columns, row, strict=True):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(columns[0], pa.int64()), pa.array(columns[1], longs),
                 pa.array(columns[2], longs), pa.array(columns[3], pa.binary())],
                names=["key", "doc_id", "size", "prefixes", "rests", "signature"])

    found = StructType.fromDDL("size bigint, prefixes array<bigint>, rests array<bigint>, signature binary")
    schema = StructType([df.schema["key"], df.schema["doc_id"], *found.fields])
    first = [F.first(c, ignorenulls=True).alias(c) for c in ("size", "prefixes", "rests", "signature")]
    nodes = df.select("key", "doc_id", "text").mapInArrow(label, schema).groupBy("key").agg(F.min("doc_id").alias("text_id"), *first)
    return materialise(nodes.withColumn("node", F.monotonically_increasing_id()), "classes")


_EDGE = "u bigint, v bigint"


def _like(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, least: int, threshold: float) -> np.ndarray:
    """Whether signatures agree often enough, of sets whose sizes allow it."""
    agree = (a == b).sum(axis=-1) >= least
    return agree & (np.minimum(size_a, size_b) >= threshold * np.maximum(size_a, size_b) * (1 - 1e-12))


def _settled(label: np.ndarray, *groups: np.ndarray) -> np.ndarray:
    """Least label that rows reach through equal values of the groups."""
    groups = tuple(np.unique(g, return_inverse=True)[1] for g in groups)
    while True:
        new = label
        for g in groups:
            least = np.full(g.max(initial=-1) + 1, len(label))
            np.minimum.at(least, g, new)
            new = least[g]
        if (new == label).all():
            return label
        label = new


def _forest(pairs: np.ndarray) -> np.ndarray:
    """As few pairs as connect what these connect."""
    ids, at = np.unique(pairs, return_inverse=True)
    u, v = at.reshape(-1, 2).T
    label = np.arange(len(ids))
    while True:
        new = label.copy()
        least = np.minimum(new[u], new[v])
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(len(ids)))
    return np.stack([ids[label[member]], ids[member]], 1)


def _joined(label: np.ndarray, root: np.ndarray, size: np.ndarray, signature: np.ndarray, least: int, threshold: float,
            side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Pairs of roots that join what is alike but apart (by ``label``, which is
    brought up to date); with ``side`` only rows of different sides."""
    pairs = []
    for i in range(len(root) - 1):
        apart = i + 1 + np.flatnonzero(label[i + 1:] != label[i])
        if side is not None:
            apart = apart[side[apart] != side[i]]
        if not len(apart):
            continue
        hit = apart[_like(signature[apart], signature[i], size[apart], size[i], least, threshold)]
        if len(hit):
            found, first = np.unique(label[hit], return_index=True)
            pairs += [(int(root[i]), int(root[hit[k]])) for k in first]
            label[np.isin(label, found)] = label[i]
    return pairs


def joined_in_trie(prefix: np.ndarray, root: np.ndarray, size: np.ndarray, signature: np.ndarray, least: int,
                   threshold: float, shorten: bool) -> np.ndarray:
    """Pairs of roots to be joined (n x 2) among rows sorted by prefix and the
    rest of their labels.  Neighbours first; with ``shorten`` also all rows of
    a prefix that this leaves apart."""
    if len(prefix) < 2:
        return np.zeros((0, 2), np.int64)
    same = prefix[1:] == prefix[:-1]
    chain = same & ((root[1:] == root[:-1]) | _like(signature[1:], signature[:-1], size[1:], size[:-1], least, threshold))
    pairs = [np.stack([root[:-1], root[1:]], 1)[chain]]
    if shorten:
        run = np.cumsum(np.r_[0, ~chain])
        first = np.flatnonzero(np.r_[True, ~same])
        ends = np.r_[first[1:], len(prefix)]
        for a, b in zip(first.tolist(), ends.tolist(), strict=True):
            if run[a] != run[b - 1]:
                label = _settled(np.arange(b - a), run[a:b], root[a:b])
                more = _joined(label, root[a:b], size[a:b], signature[a:b], least, threshold)
                pairs.append(np.array(more, np.int64).reshape(-1, 2))
    return _forest(np.concatenate(pairs))


def _edge_batch(found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["u", "v"])


def _columns(rows: pa.Table) -> tuple[np.ndarray, ...]:
    signature = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint8).reshape(rows.num_rows, -1)
    return *(rows[c].to_numpy() for c in ("prefix", "root", "size")), signature


def _walk(rows: DataFrame, least: int, threshold: float, shorten: bool) -> DataFrame:
    """Edges between the roots of rows that lie sorted in their partitions;
    prefixes that a batch cuts are put together again if ``shorten``."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, new]) if held is not None else new
            if held.num_rows < 4096:
                continue
            prefix = held["prefix"].to_numpy()
            # The last prefix may go on; of a long one only its last row is needed.
            cut = int(np.flatnonzero(prefix != prefix[-1])[-1]) + 1 if prefix[0] != prefix[-1] else 0
            if not shorten:
                yield _edge_batch(joined_in_trie(*_columns(held), least, threshold, False))
                held = held.slice(held.num_rows - 1)
            elif cut:
                yield _edge_batch(joined_in_trie(*_columns(held.slice(0, cut)), least, threshold, True))
                held = held.slice(cut)
        if held is not None:
            yield _edge_batch(joined_in_trie(*_columns(held), least, threshold, shorten))

    return rows.select("prefix", "root", "size", "signature").mapInArrow(walk, _EDGE)


def _shortened(rows: DataFrame, least: int, threshold: float) -> DataFrame:
    """Edges between rows of long prefixes that are still apart, compared in
    pairs of blocks.  ``rows``: prefix, n (its rows), node, root, size,
    signature."""
    apart = rows.groupBy("prefix").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    blocks = F.ceil(F.col("n") / GROUP_ROWS).cast("int")
    dealt = rows.join(apart.select("prefix"), "prefix").withColumn("block", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "prefix", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "root", "size", "signature")

    def compare(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        _, root, size, signature = _columns(group)
        side = None if key[1].as_py() == key[2].as_py() else group["block"].to_numpy()
        label = _settled(np.arange(len(root)), root)
        pairs = _joined(label, root, size, signature, least, threshold, side)
        found = _forest(np.array(pairs, np.int64).reshape(-1, 2))
        return pa.table({"u": found[:, 0], "v": found[:, 1]})

    return dealt.groupBy("prefix", "i", "j").applyInArrow(compare, _EDGE)


def _rooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``rows`` with the root of their node."""
    if roots is None:
        return rows.withColumn("root", F.col("node"))
    named = roots.select(F.col("node").alias("of"), F.col("root").alias("found"))
    return rows.join(named, rows["node"] == named["of"], "left").withColumn("root", F.coalesce("found", "node")).drop("of", "found")


def _contracted(roots: DataFrame | None, edges: DataFrame) -> DataFrame | None:
    """``roots`` (node, root) after joining the roots that ``edges`` connect."""
    edges = materialise(edges.distinct(), "joined")
    if edges.isEmpty():
        return roots
    new = components(edges)
    if roots is None:
        return new
    named = new.select(F.col("node").alias("old"), F.col("root").alias("new"))
    moved = roots.join(named, roots["root"] == named["old"], "left").select("node", F.coalesce("new", "root").alias("root"))
    # Roots that were nodes of no component so far.
    lone = named.join(roots, named["old"] == roots["node"], "left_anti").select(F.col("old").alias("node"), F.col("new").alias("root"))
    return materialise(moved.unionByName(lone), "roots")


def _candidates(nodes: DataFrame, threshold: float, trees: int, depth: int) -> DataFrame:
    """node, root: candidate components of more than one class."""
    least = least_agreement(threshold, trees * depth)
    tries = nodes.select("node", F.posexplode(F.arrays_zip("prefixes", "rests")).alias("tree", "label"))         .select("node", "tree", F.col("label.prefixes").alias("prefix"), F.col("label.rests").alias("rest"))
    shared = tries.groupBy("prefix").agg(F.count("*").alias("n")).where("n > 1")
    tries = materialise(tries.join(shared, "prefix"), "tries")
    roots = None
    for part in (F.col("tree") < FIRST_TREES, F.col("tree") >= FIRST_TREES):
        rows = _rooted(tries.where(part), roots).join(nodes.select("node", "size", "signature"), "node")
        short = rows.where(F.col("n") <= GROUP_ROWS).repartition("prefix").sortWithinPartitions("prefix", "rest", "node")
        long = rows.where(F.col("n") > GROUP_ROWS).repartitionByRange("prefix", "rest", "node")             .sortWithinPartitions("prefix", "rest", "node")
        roots = _contracted(roots, _walk(short, least, threshold, True).unionByName(_walk(long, least, threshold, False)))
    long = tries.where(F.col("n") > GROUP_ROWS)
    if not long.isEmpty():
        rows = _rooted(long, roots).join(nodes.select("node", "size", "signature"), "node")
        roots = _contracted(roots, _shortened(rows, least, threshold))
    if roots is None:
        return nodes.where("false").select("node", F.col("node").alias("root"))
    return roots


def link_counts(sets: list[np.ndarray], sides: np.ndarray, threshold: float,
                within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links of sets across their sides, or of all sets (``within``), and the
    least index each set is connected to by them."""
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, which, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = n[which] > 1
    which, owner = which[shared], owner[shared]
    common = np.zeros((len(sets), len(sets)), np.int64)
    if len(which):
        # Shingles of the same documents are one column that counts for all.
        order = np.lexsort((owner, which))
        which, owner = which[order], owner[order]
        starts = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
        marks = np.random.default_rng(1).integers(0, 1 << 63, (len(sets), 2), dtype=np.uint64)
        with np.errstate(over="ignore"):
            mark = np.add.reduceat(marks[owner], starts, axis=0)
        _, first, weight = np.unique(mark, axis=0, return_index=True, return_counts=True)
        ends = np.r_[starts[1:], len(which)]
        for at in range(0, len(first), 4096):
            part = first[at:at + 4096]
            m = np.zeros((len(sets), len(part)))
            for c, k in enumerate(part):
                m[owner[starts[k]:ends[k]], c] = 1
            common += np.rint((m * weight[at:at + 4096]) @ m.T).astype(np.int64)
    t = Fraction(str(threshold))
    union = size[:, None] + size[None, :] - common
    linked = (common * t.denominator >= union * t.numerator) & (common > 0)
    np.fill_diagonal(linked, False)
    if not within:
        linked &= sides[:, None] != sides[None, :]
    root = np.arange(len(sets))
    while True:
        near = np.minimum(root, np.where(linked, root[None, :], len(sets)).min(axis=1))
        near = np.minimum(near, near[near])
        if (near == root).all():
            return linked.sum(axis=1), root
        root = near


def _verified(docs: DataFrame, nodes: DataFrame, candidates: DataFrame, n: int, threshold: float) -> DataFrame:
    """node, n_links, root of every candidate class, summed over its blocks."""
    members = candidates.join(nodes.select("node", "key", "text_id", "size"), "node")
    blocks = candidates.join(nodes.select("node", "size"), "node").groupBy("root").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int").alias("blocks"))
    members = members.join(blocks, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # One row of each class, though rows may be repeated.
    rows = docs.join(members, (docs["key"] == members["key"]) & docs["doc_id"].eqNullSafe(members["text_id"])) \
        .groupBy("node").agg(*[F.first(c).alias(c) for c in ("root", "blocks", "block", "text")])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, n).view(np.int64) for t in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(found, pa.list_(pa.int64()))],
                names=["node", "root", "blocks", "block", "shingles"])

    rows = rows.mapInArrow(sets, "node bigint, root bigint, blocks int, block int, shingles array<bigint>")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    rows = rows.withColumn("other", other).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "node", "shingles")

    def count(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        group = group.sort_by("node")
        within = key[1].as_py() == key[2].as_py()  # a block may be empty, so the rows cannot tell
        ids = group["node"].to_numpy()
        found = group["shingles"].combine_chunks()
        sets_ = [np.asarray(found[k].values, np.int64) for k in range(len(ids))]
        links, root = link_counts(sets_, group["block"].to_numpy(), threshold, within)
        return pa.table({"node": ids, "n_links": pa.array(links, pa.int64()), "near": pa.array(ids[root], pa.int64())})

    return rows.groupBy("root", "i", "j").applyInArrow(count, "node bigint, n_links bigint, near bigint")


def _linked(docs: DataFrame, n: int, threshold: float, trees: int, depth: int, recall: float) -> DataFrame:
    """A row per distinct text: key, text_id, root, class_id, n_links."""
    nodes = _classes(docs, n, threshold, trees, depth, recall)
    found = materialise(_verified(docs, nodes, _candidates(nodes, threshold, trees, depth), n, threshold), "links")
    roots = components(found.where("node <> near").select(F.col("node").alias("u"), F.col("near").alias("v")).distinct())
    links = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    out = (nodes.select("node", "key", "text_id").join(links, "node", "left").join(roots, "node", "left")
           .select("key", "text_id", F.coalesce("root", "node").alias("root"),
                   F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links")))
    names = out.groupBy("root").agg(F.min("text_id").alias("class_id"))
    return materialise(out.join(names, "root"), "linked")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS, threshold: float = THRESHOLD,
         trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, text_id, n_links of every row of ``docs``."""
    df = only(docs, [doc_id, text]).toDF("doc_id", "text")
    df = df.select("doc_id", text_or_empty(F.col("text")).alias("text")).withColumn("key", text_key(F.col("text")))
    linked = _linked(df, n, threshold, trees, depth, recall)
    return df.select("doc_id", "key").join(linked, "key").select("doc_id", "class_id", "text_id", "n_links")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = WORDS,
                threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of every class: the one with the least doc_id
    (of repeated rows, and of a class of null ids, any one)."""
    key = fresh(docs, "key")
    df = docs.withColumn(key, text_key(text_or_empty(F.col(f"`{text}`"))))
    plain = only(docs, [doc_id, text]).toDF("doc_id", "text")
    plain = plain.select("doc_id", text_or_empty(F.col("text")).alias("text")).withColumn("key", text_key(F.col("text")))
    linked = _linked(plain, n, threshold, TREES, DEPTH, RECALL)
    first = F.struct(F.col("text_id").isNull().alias("null"), "text_id", "key")
    stays = linked.groupBy("root").agg(F.min(first).alias("k")).select(
        F.col("k.key").alias("stay_key"), F.col("k.text_id").alias("stay_id"))
    kept = df.join(stays, (df[key] == stays["stay_key"]) & df[doc_id].eqNullSafe(stays["stay_id"]), "left_semi")
    return kept.dropDuplicates([key, doc_id]).drop(key)
