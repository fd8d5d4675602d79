"""Partial copies and paraphrases are found; documents that share words are not."""

import random

import pytest

from tests.llm.conftest import WORDS
from tidemark.llm import decontaminate


def corpus(seed, vocabulary, n_items=40, n_docs=300):
    """Items of 60 words, filler documents over the same words, and a stream of
    filler words."""
    rng = random.Random(seed)
    words = [f"v{i}x" for i in range(vocabulary)] + WORDS * 40
    stream = lambda n: [rng.choice(words) for _ in range(n)]
    items = [stream(60) for _ in range(n_items)]
    docs = [(10_000 + i, stream(rng.randrange(20, 300))) for i in range(n_docs)]
    return rng, stream, items, docs


def found(spark, items, docs):
    docs = spark.createDataFrame([(i, " ".join(ws)) for i, ws in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(ws)) for k, ws in enumerate(items)], "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.find(docs, bench).collect()}


@pytest.mark.parametrize("vocabulary", [3_000, 30_000])
def test_partial_copies_are_found(spark, vocabulary):
    rng, stream, items, docs = corpus(vocabulary, vocabulary)
    want = set()
    for k, item in enumerate(items):
        for j, share in enumerate((0.65, 0.7, 0.8, 0.9, 1.0)):
            size = round(60 * share)
            # The beginning, the end or the middle of the item, word for word.
            at = (0, 60 - size, (60 - size) // 2)[(k + j) % 3]
            docs.append((k * 10 + j, stream(rng.randrange(0, 200)) + item[at:at + size] + stream(rng.randrange(0, 200))))
            want.add((k * 10 + j, k))
    got = found(spark, items, docs)
    assert len(got & want) >= 0.98 * len(want)
    assert got <= want  # nothing else


def test_paraphrases_are_found(spark):
    rng, stream, items, docs = corpus(7, 10_000)
    want = set()
    for k, item in enumerate(items):
        for j, kind in enumerate(("replaced", "dropped", "inserted", "both")):
            words = []
            for w in item:
                turn = rng.random()
                if kind in ("replaced", "both") and turn < 0.2:
                    words += stream(1)
                elif kind in ("dropped", "both") and turn < 0.25:
                    continue
                else:
                    words.append(w)
                if kind in ("inserted", "both") and rng.random() < 0.2:
                    words += stream(1)
            docs.append((k * 10 + j, stream(rng.randrange(0, 150)) + words + stream(rng.randrange(0, 150))))
            want.add((k * 10 + j, k))
    got = found(spark, items, docs)
    assert len(got & want) >= 0.95 * len(want)
    assert got <= want


def test_half_an_item_or_its_words_in_other_order_are_no_copy(spark):
    rng, stream, items, docs = corpus(11, 10_000)
    for k, item in enumerate(items):
        docs.append((k * 10, stream(60) + item[:30] + stream(60)))
        docs.append((k * 10 + 1, stream(60) + rng.sample(item, 60) + stream(60)))
    assert found(spark, items, docs) == set()
