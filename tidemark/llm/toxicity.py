"""Toxicity: a bidirectional gated recurrent network with attention pooling.

*Inputs.*  Each word is two learned vectors side by side: one of the word itself,
if ``LEAST_DOCUMENTS`` of the sample have it (else one that all other words
share), and the mean over its character grams, with marks at both ends and
hashed, so that unseen words with known parts are understood.  In training some
words are hidden, so that their characters have to tell.

*Network.*  Texts are read in windows of ``WINDOW`` words, one every ``STRIDE``;
the last one ends with the text, so all words are read, in overlapping windows.
Gated recurrent units run over a window forwards and backwards; attention
weighs their states, and the weighted sum gives the window's logit.  A text's
score is that of its highest window.

*Training* (numpy, on the driver) sees a bounded sample: of each label the
``SAMPLE`` documents whose ids hash lowest, and of each of those at most
``SAMPLE_WINDOWS`` windows, evenly spaced.  First all windows learn their
document's label; then, round after round, the highest window of each document
does, as scoring will use it, and some windows of those labelled 0.

*Scoring* reads every window of every text, in batches of windows.  The inputs
of a word are computed once for each worker and kept in a bounded memory.

Defined results: null texts, and texts without a word, score 0; rows with a null
id are scored, never learned from, and count as not held out; a document with
several labels has the highest; null labels teach nothing; with fewer than two
kinds of labels every text with a word scores the share of ones (0 without
labels); repeated rows give repeated results; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StringType, StructField, StructType

from tidemark.llm.common import only, ship, text_or_empty

WINDOW, STRIDE = 32, 24
SAMPLE = 1000
SAMPLE_WINDOWS = 32
#: Words with a vector of their own: in so many documents of the sample, and so many.
LEAST_DOCUMENTS, VOCABULARY = 8, 20_000
BUCKETS = 1 << 15
WIDTH = 12
HIDDEN = 16
GRAMS = (3, 4, 5)
EPOCHS, ROUNDS = 2, 4
BATCH = 256
#: Steps of the first part, and of a round, at least: small samples are read again.
LEAST_STEPS, LEAST_ROUND = 90, 24
RATE = 0.01
#: Share of words hidden in training.
HIDE = 0.3
SEED = 3
#: Words a worker remembers.
MEMORY = 200_000
#: Windows that run together; texts whose words are looked up together.
_SCORED, _TEXTS = 1024, 250
_PUNCTUATION = ".,;:!?\"'()[]{}<>#*$%&|-_"
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


# --- inputs --------------------------------------------------------------------------

def plain(word: str) -> str:
    return word.lower().strip(_PUNCTUATION)


def word_features(words: list[str], vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of each word, 0 outside the vocabulary; buckets of all character
    grams, and where each word's begin (a word has one at least)."""
    bare = list(map(plain, words))
    word = np.fromiter((vocabulary.get(w, 0) for w in bare), np.int64, len(bare))
    marked = [f"\x02{w}\x03" for w in bare]
    code = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32).astype(np.uint64)
    size = np.fromiter(map(len, marked), np.int64, len(marked))
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(marked)), size)
    ends = np.repeat(start + size, size)
    grams, owners = [start * 0 + (size % 61)], [np.arange(len(marked))]  # the length, for words of a letter
    with np.errstate(over="ignore"):
        for n in GRAMS:
            at = np.flatnonzero(np.arange(len(code)) + n <= ends)
            h = np.full(len(at), n, np.uint64)
            for i in range(n):
                h = (h ^ (h >> np.uint64(29))) * _P2 + (code[at + i] + np.uint64(1)) * _P1
            h = (h ^ (h >> np.uint64(32))) * _P1
            grams.append(((h >> np.uint64(20)) % np.uint64(BUCKETS)).astype(np.int64))
            owners.append(owner[at])
    grams_, owners_ = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners_, kind="stable")
    return word, grams_[order], np.searchsorted(owners_[order], np.arange(len(marked)))


def windows_of(n: int) -> np.ndarray:
    """First words of the windows of a text of ``n`` words."""
    if n <= WINDOW:
        return np.zeros(min(n, 1), np.int64)
    at = np.arange(0, n - WINDOW + 1, STRIDE)
    return at if at[-1] == n - WINDOW else np.r_[at, n - WINDOW]


# --- network -------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters, forward and backward passes.  Gates are ordered update,
    reset, candidate; index 0 of a direction axis is forwards."""

    def __init__(self, vocabulary: dict[str, int], seed: int = SEED) -> None:
        self.vocabulary = vocabulary
        rng = np.random.default_rng(seed)
        f = lambda *shape, by: (rng.standard_normal(shape) * by).astype(np.float32)
        h = HIDDEN
        self.p = {
            "word": f(len(vocabulary) + 1, WIDTH, by=0.1), "gram": f(BUCKETS, WIDTH, by=0.1),
            "input": f(2, 2 * WIDTH, 3 * h, by=(2 * WIDTH) ** -0.5), "bias": np.zeros((2, 3 * h), np.float32),
            "state": f(2, h, 3 * h, by=h ** -0.5),
            "attend": f(2 * h, h, by=(2 * h) ** -0.5), "attend_bias": np.zeros(h, np.float32), "query": f(h, by=h ** -0.5),
            "out": f(2 * h, by=0.1), "out_bias": np.zeros(1, np.float32)}

    def embed(self, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        """Inputs of words, a row each."""
        word, grams, start = features
        if not len(word):
            return np.zeros((0, 2 * WIDTH), np.float32)
        count = np.diff(np.r_[start, len(grams)])
        return np.hstack([self.p["word"][word], np.add.reduceat(self.p["gram"][grams], start, axis=0) / count[:, None]]) \
            .astype(np.float32)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """Input parts of the gates of words, direction by direction, after a
        row for no word, which leaves the state as it is."""
        out = np.zeros((2, len(x) + 1, 3 * HIDDEN), np.float32)
        out[:, 0, :HIDDEN] = -60
        out[:, 1:] = x @ self.p["input"] + self.p["bias"][:, None]
        return out

    def run(self, gates: np.ndarray, ids: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logits of windows: ``ids`` (windows x words) are rows of ``gates``."""
        n, t = ids.shape
        h = HIDDEN
        states = np.zeros((t, n, 2 * h), np.float32)
        held: dict = {"steps": ([], [])}
        columns = np.ascontiguousarray(ids.T)
        for d in range(2):
            state, u = np.zeros((n, h), np.float32), self.p["state"][d]
            for at in range(t) if d == 0 else range(t - 1, -1, -1):
                x, s = gates[d][columns[at]], state @ u
                zr = _sigmoid(x[:, :2 * h] + s[:, :2 * h])
                z, r = zr[:, :h], zr[:, h:]
                c = np.tanh(x[:, 2 * h:] + r * s[:, 2 * h:])
                new = state + z * (c - state)
                if keep:
                    held["steps"][d].append((at, state, s[:, 2 * h:], z, r, c))
                state = new
                states[at, :, d * h:(d + 1) * h] = state
        a = np.tanh(states @ self.p["attend"] + self.p["attend_bias"])
        e = a @ self.p["query"]
        e[columns == 0] = -1e9
        e = np.exp(e - e.max(axis=0))
        weight = e / e.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        held |= {"states": states, "a": a, "weight": weight, "pooled": pooled}
        return pooled @ self.p["out"] + self.p["out_bias"][0], held

    def gradients(self, features: tuple, x: np.ndarray, ids: np.ndarray, target: np.ndarray) -> dict:
        """Gradients of the mean logistic loss.  ``features`` and
        ``x`` belong to the words that ``ids`` number from 1."""
        h, p = HIDDEN, self.p
        gates = self.gates(x)
        logit, held = self.run(gates, ids, keep=True)
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "gram")}
        by = ((_sigmoid(logit) - target) / len(ids)).astype(np.float32)
        g["out"], g["out_bias"] = held["pooled"].T @ by, by.sum(keepdims=True)
        pooled = by[:, None] * p["out"]
        states, weight, a = held["states"], held["weight"], held["a"]
        to_states = weight[:, :, None] * pooled[None]
        to_weight = np.einsum("tnh,nh->tn", states, pooled)
        to_e = weight * (to_weight - (weight * to_weight).sum(axis=0))
        g["query"] = np.einsum("tn,tnk->k", to_e, a)
        to_a = (to_e[:, :, None] * p["query"]) * (1 - a * a)
        g["attend"] = np.einsum("tnh,tnk->hk", states, to_a)
        g["attend_bias"] = to_a.sum(axis=(0, 1))
        to_states += to_a @ p["attend"].T
        to_gates = np.zeros_like(gates)
        to_inputs = np.zeros((len(ids[0]), len(ids), 3 * h), np.float32)
        for d in range(2):
            carried, u = np.zeros((len(ids), h), np.float32), p["state"][d]
            for at, state, sc, z, r, c in reversed(held["steps"][d]):
                to = carried + to_states[at, :, d * h:(d + 1) * h]
                to_z = to * (c - state) * z * (1 - z)
                to_c = to * z * (1 - c * c)
                to_r = to_c * sc * r * (1 - r)
                to_s = np.hstack([to_z, to_r, to_c * r])
                g["state"][d] += state.T @ to_s
                carried = to * (1 - z) + to_s @ u.T
                to_inputs[at, :, :2 * h], to_inputs[at, :, 2 * h:] = to_s[:, :2 * h], to_c
            _add_rows(to_gates[d], ids.T.ravel(), to_inputs.reshape(-1, 3 * h))
        to_gates = to_gates[:, 1:]
        g["bias"] = to_gates.sum(axis=1)
        g["input"] = x.T @ to_gates
        to_x = to_gates[0] @ p["input"][0].T + to_gates[1] @ p["input"][1].T
        word, grams, start = features
        count = np.diff(np.r_[start, len(grams)])
        for name, bucket, part in (("word", word, to_x[:, :WIDTH]),
                                   ("gram", grams, np.repeat(to_x[:, WIDTH:] / count[:, None], count, axis=0))):
            g[name] = np.zeros_like(p[name])
            _add_rows(g[name], bucket, part)
        return g

    def learn(self, g: dict, memory: dict, step: int, rate: float) -> None:
        """One step of Adam."""
        for k, v in g.items():
            m, s = memory.setdefault(k, (np.zeros_like(v), np.zeros_like(v)))
            m *= 0.9
            m += 0.1 * v
            s *= 0.999
            s += 0.001 * v * v
            self.p[k] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)


def _add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``to[at] += rows`` with repeated places."""
    order = np.argsort(at, kind="stable")
    sorted_ = at[order]
    first = np.flatnonzero(np.r_[True, sorted_[1:] != sorted_[:-1]])
    to[sorted_[first]] += np.add.reduceat(rows[order], first, axis=0)


# --- training ------------------------------------------------------------------------

def vocabulary_of(sample: list[tuple[list[list[str]], int]], least: int = LEAST_DOCUMENTS, most: int = VOCABULARY) -> dict[str, int]:
    """Numbers from 1 of the words with a vector of their own."""
    count: Counter = Counter()
    for windows, _ in sample:
        count.update({plain(w) for words in windows for w in words})
    found = sorted((-n, w) for w, n in count.items() if n >= least and w)
    return {w: i + 1 for i, (_, w) in enumerate(found[:most])}


def train(sample: list[tuple[list[list[str]], int]], seed: int = SEED, epochs: int = EPOCHS, rounds: int = ROUNDS) -> Network:
    """``sample``: the windows (lists of words) of each document, and its
    label."""
    net = Network(vocabulary_of(sample), seed)
    number: dict[str, int] = {}
    ids, owner, label = [], [], []
    for d, (windows, y) in enumerate(sample):
        for words in windows:
            ids.append([number.setdefault(w, len(number) + 1) for w in words] + [0] * (WINDOW - len(words)))
            owner.append(d)
        label.append(y)
    ids_, owner_, label_ = np.array(ids, np.int64).reshape(-1, WINDOW), np.array(owner), np.array(label, np.float32)
    word, grams, start = features = word_features(list(number), net.vocabulary)
    ends = np.r_[start, len(grams)]
    rng, memory, step = np.random.default_rng(seed + 1), {}, 0

    def fit(rows: np.ndarray, rate: float) -> None:
        nonlocal step
        rows = rng.permutation(rows)
        for at in range(0, len(rows), BATCH):
            part = rows[at:at + BATCH]
            used, local = np.unique(ids_[part], return_inverse=True)
            local = local.reshape(ids_[part].shape)
            if used[0]:  # no window is short: 0 stays the row for no word
                used, local = np.r_[0, used], local + 1
            take = used[1:] - 1
            size = (ends[1:] - ends[:-1])[take]
            first = np.cumsum(size) - size
            of = (np.arange(size.sum()) - np.repeat(first, size)) + np.repeat(ends[take], size)
            mine = (np.where(rng.random(len(take)) < HIDE, 0, word[take]), grams[of], first)
            step += 1
            net.learn(net.gradients(mine, net.embed(mine), local, label_[owner_[part]]), memory, step, rate)

    def some(rows: np.ndarray, most: int) -> np.ndarray:
        """At most so many rows of each document, in random order."""
        order = rng.permutation(rows)
        order = order[np.argsort(owner_[order], kind="stable")]
        first = np.flatnonzero(np.r_[True, owner_[order][1:] != owner_[order][:-1]])
        return order[np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)])) < most]

    everything = np.arange(len(ids_))
    start_ = step
    for i in itertools.count():
        if i >= epochs and step - start_ >= LEAST_STEPS:
            break
        fit(some(everything, 6), RATE)
    for i in range(rounds):
        gates = net.gates(net.embed(features))
        logit = np.concatenate([net.run(gates, ids_[at:at + _SCORED])[0] for at in range(0, len(ids_), _SCORED)])
        by = np.lexsort((-logit, owner_))
        best = by[np.r_[True, owner_[by][1:] != owner_[by][:-1]]]
        clean = some(everything[label_[owner_] == 0], 2)
        start_ = step
        for k in itertools.count():
            if k >= 2 and step - start_ >= LEAST_ROUND:
                break
            fit(np.r_[best, clean], RATE / (1 + i))
    return net


def _sample(docs: DataFrame, labels: DataFrame, learned: Column, per_label: int, most_windows: int) -> DataFrame:
    """label and windows of the sampled documents: bounded by the parameters."""
    known = labels.where(F.col("label").isin(0, 1) & F.col("id").isNotNull()).groupBy("id").agg(F.max("label").alias("label"))
    # One row of each id, then the lowest hashes of each label.
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("id"), "id"))
    ids = known.where(learned).withColumn("place", place).where(F.col("place") <= per_label).select("id", "label")
    found = docs.join(F.broadcast(ids), "id")  # at most 2 x per_label rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, sizes = [], []
            for text in batch.column(1).to_pylist():
                words = text.split()
                at = windows_of(len(words))
                if len(at) > most_windows:
                    at = at[np.linspace(0, len(at) - 1, most_windows).astype(np.int64)]
                out.append([" ".join(words[a:a + WINDOW]) for a in at.tolist()])
                sizes.append(len(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(out, pa.list_(pa.string()))], names=["id", "label", "windows"])

    cut_ = found.select("id", "text", "label").mapInArrow(
        cut, StructType([docs.schema["id"], StructField("label", IntegerType()),
                         StructField("windows", ArrayType(StringType()))]))
    # Repeated rows of an id: one, whichever (they may differ in text).
    return cut_.groupBy("id").agg(F.max("label").alias("label"), F.max("windows").alias("windows")).where(F.size("windows") > 0)


# --- scoring -------------------------------------------------------------------------

class _Memory:
    """Gate inputs of words, computed once; forgets all when full."""

    def __init__(self, net: Network) -> None:
        self.net, self.row = net, {}
        none = net.gates(np.zeros((0, 2 * WIDTH), np.float32))
        self.gates = np.zeros((2, MEMORY + 1, 3 * HIDDEN), np.float32)
        self.gates[:, :1] = none

    def rows(self, words: list[str]) -> np.ndarray:
        """Rows of ``self.gates``, one for each word.  At most ``MEMORY``
        different words at once."""
        found = list(map(self.row.get, words))
        if None in found:
            new = list({w for w, r in zip(words, found, strict=True) if r is None})
            if len(self.row) + len(new) > MEMORY:
                self.row.clear()
                new = list(set(words))
            for at in range(0, len(new), 20_000):
                part = new[at:at + 20_000]
                first = len(self.row) + 1
                x = self.net.embed(word_features(part, self.net.vocabulary))
                self.gates[:, first:first + len(part)] = self.net.gates(x)[:, 1:]
                self.row.update(zip(part, range(first, first + len(part)), strict=True))
            found = list(map(self.row.__getitem__, words))
        return np.array(found, np.int64)


def _together(texts: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Words of some texts in a row, the windows' first words there, and the
    text of each window.  A text of very many words comes in parts, each a
    whole number of windows."""
    words: list[str] = []
    starts: list[np.ndarray] = []
    owner: list[np.ndarray] = []
    for i, text in enumerate(texts):
        own = text.lower().split()
        at = windows_of(len(own))
        for k in range(0, len(at), 2 * _SCORED):
            part = at[k:k + 2 * _SCORED]
            first, last = int(part[0]), min(int(part[-1]) + WINDOW, len(own))
            if words and len(words) + last - first > MEMORY // 2:
                yield words, np.concatenate(starts), np.concatenate(owner)
                words, starts, owner = [], [], []
            starts.append(part - first + len(words))
            owner.append(np.full(len(part), i))
            words.extend(own[first:last])
            # Short texts are filled up: an empty word has no row.
            words.extend([""] * (WINDOW - (last - first)))
    if words:
        yield words, np.concatenate(starts), np.concatenate(owner)


def score_texts(net: Network, memory: _Memory, texts: list[str]) -> np.ndarray:
    """The highest window's probability of each text; 0 for texts without a
    word."""
    out = np.full(len(texts), -np.inf)
    for words, starts, owner in _together(texts):
        rows = memory.rows(words)
        rows[np.fromiter(map(len, words), np.int64, len(words)) == 0] = 0
        for at in range(0, len(starts), _SCORED):
            part = starts[at:at + _SCORED]
            logit = net.run(memory.gates, rows[part[:, None] + np.arange(WINDOW)])[0]
            np.maximum.at(out, owner[at:at + _SCORED], logit)
    return np.where(np.isfinite(out), 1 / (1 + np.exp(-np.clip(out, -700, 700))), 0.0)


def score(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          folds: int = 5, sample: int = SAMPLE, sample_windows: int = SAMPLE_WINDOWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``.  Ids
    whose crc32 is divisible by ``folds`` are held out of training."""
    spark = docs.sparkSession
    ship(spark)
    df = only(docs, [doc_id, text]).toDF("id", "text").select("id", text_or_empty(F.col("text")).alias("text"))
    known = only(labels, [doc_id, label]).toDF("id", "label").withColumn("label", F.col("label").cast("int"))
    held_out = F.coalesce(F.crc32(F.col("id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    rows = [(r["windows"], r["label"]) for r in _sample(df, known, ~held_out, sample, sample_windows).orderBy("id").collect()]
    seen = {y for _, y in rows}
    schema = StructType([StructField("doc_id", df.schema["id"].dataType), StructField("held_out", BooleanType()),
                         StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    net = train([([w.split() for w in windows], y) for windows, y in rows]) if len(seen) > 1 else None
    share = sum(y for _, y in rows) / max(len(rows), 1)
    shared = spark.sparkContext.broadcast(net)  # VOCABULARY + BUCKETS rows of WIDTH, and less

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        memory = _Memory(net) if net else None
        for whole in batches:
            for at in range(0, whole.num_rows, _TEXTS):
                batch = whole.slice(at, _TEXTS)
                texts = batch.column(2).to_pylist()
                if net is None:
                    s = np.array([share if t.split() else 0.0 for t in texts], np.float64)
                else:
                    s = score_texts(net, memory, texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                    names=schema.names)

    return df.select("id", held_out.alias("held_out"), "text").mapInArrow(judge, schema)
