"""The forest: tries, agreement of signatures, shortening, recall."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import prose
from tidemark.llm import jaccard


def test_depth_and_agreement_meet_the_recall():
    d, values = jaccard.depth_for(0.8), jaccard.TREES * jaccard.DEPTH
    assert d < jaccard.DEPTH
    missed = (1 - 0.8 ** d) ** jaccard.TREES
    from math import comb
    p = 0.8 + 0.2 / 256
    least = jaccard.least_agreement(0.8, values)
    missed += sum(comb(values, k) * p ** k * (1 - p) ** (values - k) for k in range(least))
    assert 1 - missed >= jaccard.RECALL
    assert (1 - 0.8 ** (d + 1)) ** jaccard.TREES > (1 - jaccard.RECALL) * 2 / 3  # no longer prefix would do


def sets_at(similarity, size, rng):
    """Two sets of hashes with about this similarity, never below it."""
    common = int(np.ceil(similarity * 2 * size / (1 + similarity)))
    own = rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
    a, b = own[:size], np.r_[own[:common], own[size:2 * size - common]]
    return np.unique(a), np.unique(b)


def test_measured_recall_at_the_threshold():
    rng = np.random.default_rng(5)
    d = jaccard.depth_for(0.8)
    least = jaccard.least_agreement(0.8, jaccard.TREES * jaccard.DEPTH)
    found = close = 0
    for k in range(3000):
        for similarity in (0.8, 0.56):
            a, b = (jaccard.minhashes(x) for x in sets_at(similarity, int(rng.integers(20, 400)), rng))
            (pa, _, sa), (pb, _, sb) = jaccard.labels(a, d), jaccard.labels(b, d)
            agree = (np.frombuffer(sa, np.uint8) == np.frombuffer(sb, np.uint8)).sum() >= least
            hit = bool((pa == pb).any() and agree)
            if similarity == 0.8:
                found += hit
            else:
                close += hit
    assert found >= 2998
    assert close <= 15  # 0.56 is no candidate


def test_tries_join_neighbours_first_and_shorten_what_is_apart():
    sig = lambda *groups: np.array([[g] * 8 for g in groups], np.uint8)
    one = np.ones(5, np.int64)
    joined = lambda prefix, root, signature, size=one, shorten=True: jaccard.joined_in_trie(
        np.array(prefix), np.array(root), size, signature, 6, 0.8, shorten).tolist()
    assert joined([1, 1, 1, 2, 2], [1, 2, 3, 4, 5], sig(7, 7, 7, 7, 7)) == [[1, 2], [1, 3], [4, 5]]  # no more than needed
    # 1 and 3 are alike, 2 stands between them in the trie.
    assert joined([1, 1, 1, 2, 2], [1, 2, 3, 4, 5], sig(7, 8, 7, 1, 2)) == [[1, 3]]
    assert joined([1, 1, 1, 2, 2], [1, 2, 3, 4, 5], sig(7, 8, 7, 1, 2), shorten=False) == []
    # Already joined: nothing to look at.
    assert joined([1, 1, 1, 2, 2], [1, 1, 1, 4, 4], sig(7, 8, 7, 1, 2)) == []
    # Sizes that rule the threshold out.
    assert joined([1, 1, 2, 3, 4], [1, 2, 3, 4, 5], sig(7, 7, 7, 7, 7), np.array([10, 13, 1, 1, 1])) == []


def test_a_group_joins_with_one_pair_a_member():
    n = 200
    found = jaccard.joined_in_trie(np.repeat([1, 2], n), np.r_[np.arange(n), np.arange(n)], np.ones(2 * n, np.int64),
                                   np.array([[i % 2] * 8 for i in range(n)] * 2, np.uint8), 6, 0.8, True)
    assert len(found) == n - 2  # two groups, whatever trees show them


def template_docs(n, common=56, own=22):
    """Documents that share a template of shingles, at a similarity of 0.56."""
    base = [f"t{i}" for i in range(common + 4)]
    return [(i, " ".join(base + [f"own{i}x{k}" for k in range(own)])) for i in range(n)]


def candidates(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("key", jaccard.text_key(F.col("text")))
    nodes = jaccard._classes(df, 5, 0.8, jaccard.TREES, jaccard.DEPTH, jaccard.RECALL)
    return [r["n"] for r in jaccard._candidates(nodes, 0.8, jaccard.TREES, jaccard.DEPTH).groupBy("root").agg(F.count("*").alias("n")).collect()]


@pytest.mark.parametrize("rows", [jaccard.GROUP_ROWS, 16])
def test_texts_of_one_template_are_no_component(spark, monkeypatch, rows):
    monkeypatch.setattr(jaccard, "GROUP_ROWS", rows)
    docs = template_docs(300)
    assert max(candidates(spark, docs), default=0) <= 30  # of 300
    assert {r["n_links"] for r in jaccard.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()} == {0}


@pytest.mark.parametrize("rows", [jaccard.GROUP_ROWS, 8])
def test_chains_and_groups_equal_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(jaccard, "GROUP_ROWS", rows)
    rng = random.Random(4)
    docs = template_docs(60, 70, 12)
    base = prose(71, 100).split()
    for i in range(80):  # a chain: neighbours are alike, its ends are not
        docs.append((1000 + i, " ".join(base[i:] + [f"end{k}" for k in range(i)])))
    for i in range(60):  # a group
        words = list(base)
        words[rng.randrange(len(words))] = f"new{i}"
        docs.append((2000 + i, " ".join(words)))
    docs += [(3000 + i, prose(900 + i, rng.randrange(1, 40))) for i in range(60)]
    docs += [docs[5], docs[5], (None, docs[70][1]), (None, None), (4000, docs[70][1])]
    got = jaccard.join(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    key = lambda r: str(tuple(r))
    assert sorted(map(tuple, got), key=key) == sorted(brute.jaccard(docs), key=key)


def test_ids_of_other_types(spark):
    docs = [("b", prose(1, 60)), ("a", prose(1, 60)), ("c", prose(1, 59) + " other"), ("d", prose(2, 50))]
    got = {r["doc_id"]: (r["class_id"], r["text_id"], r["n_links"]) for r in jaccard.join(
        spark.createDataFrame(docs, "doc_id string, text string")).collect()}
    assert got == {"a": ("a", "a", 1), "b": ("a", "a", 1), "c": ("a", "c", 1), "d": ("d", "d", 0)}
