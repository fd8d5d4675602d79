"""The network's derivatives, windows, training and held-out accuracy."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.conftest import EDGES, prose
from tidemark.llm import toxicity


def small_network(words):
    net = toxicity.Network({w: i + 1 for i, w in enumerate(words)})
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    return net


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    words = ["one", "two", "three", "four", "fünf"]
    net = small_network(words[:3])
    features = toxicity.word_features(words, net.vocabulary)
    ids, y = rng.integers(0, len(words) + 1, (4, 6)), np.array([0, 1, 1, 0])
    ids[:, 0] = 1  # every window has a word

    def loss():
        logit = net.run(net.gates(net.embed(features)), ids)[0].astype(np.float64)
        return float(np.mean(np.logaddexp(0, logit) - y * logit))

    g = net.gradients(features, net.embed(features), ids, y)
    for name, p in net.p.items():
        at = np.unravel_index(np.abs(g[name]).argmax(), p.shape)
        p[at] += 1e-2
        above = loss()
        p[at] -= 2e-2
        below = loss()
        p[at] += 1e-2
        assert abs((above - below) / 2e-2 - g[name][at]) < 2e-3 * max(1, abs(g[name][at])) + 0.02 * abs(g[name][at]), name


def test_windows_cover_every_word():
    for n in [0, 1, 31, 32, 33, 56, 57, 1000]:
        starts = toxicity.windows_of(n)
        covered = {a + k for a in starts.tolist() for k in range(toxicity.WINDOW) if a + k < n}
        assert covered == set(range(n))
        assert (np.diff(starts) < toxicity.WINDOW).all()  # they overlap


def slow_score(net, text):
    """Each window by itself."""
    words = text.lower().split()
    best = 0.0
    for a in toxicity.windows_of(len(words)).tolist():
        part = words[a:a + toxicity.WINDOW]
        gates = net.gates(net.embed(toxicity.word_features(part, net.vocabulary)))
        best = max(best, float(1 / (1 + np.exp(-net.run(gates, np.arange(1, len(part) + 1)[None])[0][0]))))
    return best


def test_scores_equal_window_by_window(monkeypatch):
    net = toxicity.Network({"the": 1, "alpha": 2})
    texts = ["", "one", prose(1, 31), prose(2, 33), prose(3, 700), " \n", "É " * 40]
    want = [slow_score(net, t) for t in texts]
    for memory, scored in ((toxicity.MEMORY, toxicity._SCORED), (200, 2)):
        monkeypatch.setattr(toxicity, "MEMORY", memory)
        monkeypatch.setattr(toxicity, "_SCORED", scored)
        got = toxicity.score_texts(net, toxicity._Memory(net), texts)
        assert np.allclose(got, want, atol=1e-5)


def test_held_out_accuracy_and_folds(spark, results):
    rows = results("op11_toxicity")
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    assert len(rows) == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def made(n, seed, share=0.3):
    """Documents of which some have a word with a marked stem somewhere."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = prose(seed * 10_000 + i, rng.randrange(5, 150)).split()
        toxic = rng.random() < share
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words)), "grumb" + rng.choice("aeiou") + rng.choice(["nt", "rs", "ck", "ld"]) + rng.choice(["er", "ish", "ing", "ed", ""]))
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_unseen_words_with_a_known_stem_are_caught(spark):
    rows = made(1500, 1)
    # Endings that no training row has.
    rows += [(5000 + i, prose(77 + i, 90) + f" grumb{e} " + prose(99 + i, 60), None) for i, e in enumerate(["oso", "ette", "anter"])]
    rows += [(6000 + i, prose(5000 + i, 100), None) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    held = [(got[i]["predicted"], y) for i, _, y in rows if y is not None and got[i]["held_out"]]
    assert len(held) > 60 and sum(p == y for p, y in held) >= 0.95 * len(held)
    assert [got[5000 + i]["predicted"] for i in range(3)] == [1, 1, 1]
    assert sum(got[6000 + i]["predicted"] for i in range(40)) <= 2


def test_held_out_labels_teach_nothing(spark):
    rows = made(200, 3)
    out = [zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    score = lambda labels: sorted((r["doc_id"], round(r["score"], 4)) for r in toxicity.score(
        docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect())
    plain = [(i, y) for i, _, y in rows]
    turned = [(i, 1 - y if o else y) for (i, y), o in zip(plain, out, strict=True)]
    assert score(plain) == score(turned)


def test_toxicity_edges(spark, edges, no_docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    labels = spark.createDataFrame([(1, None), (5, 1), (5, 0), (8, 0), (None, 1), (7, 0), (10, 1), (9, 7)], "doc_id long, toxic int") \
        .withColumns({"text": F.lit("x"), "id": F.lit(0), "label": F.lit(1)})
    for known in (none, labels):
        got = toxicity.score(edges, known).collect()
        assert len(got) == len(EDGES)
        for r in got:
            assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
            assert 0 <= r["score"] <= 1
            if r["doc_id"] in (1, 2, 3):
                assert (r["score"], r["predicted"]) == (0.0, 0)
    assert {r["score"] for r in toxicity.score(edges, none).collect()} == {0.0}
    ones = labels.where("toxic = 1")
    assert {r["score"] for r in toxicity.score(edges, ones).collect()} <= {0.0, 1.0}
    assert toxicity.score(no_docs, labels).count() == 0
