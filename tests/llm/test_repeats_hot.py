"""Keys settled by sorted neighbours: as the interval tree, as brute force."""

import random

import pytest

from tests.llm import brute
from tests.llm.conftest import prose
from tidemark.llm import repeats


def found(spark, texts):
    rows = repeats.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    return [got[i] for i in range(len(texts))]


def mixture(seed, n=120):
    """Passages of many sizes in whole, cut at either side, touching, inside
    themselves, at the ends of texts, and copies of texts."""
    rng = random.Random(seed)
    passages = [prose(seed * 100 + k, 80)[:rng.choice([150, 199, 200, 201, 210, 230, 260, 300, 340, 368, 400, 600])] for k in range(9)]
    out = []
    for i in range(n):
        parts = [prose(seed * 1000 + i, rng.randrange(0, 20))]
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            a, b = sorted((rng.randrange(0, len(p)), rng.randrange(0, len(p)))) if rng.random() < 0.4 else (0, len(p))
            parts += [p[a:b], prose(seed * 2000 + i, rng.randrange(0, 6))]
        if rng.random() < 0.1:
            parts.append("ab" * rng.randrange(90, 200))
        out.append((" " if rng.random() < 0.5 else "").join(parts))
    return out + out[:5] + [out[3]] * 7 + ["", "short", prose(5, 3000), "é" * 150, None]


@pytest.mark.parametrize("hot", [1, 3])
@pytest.mark.parametrize("seed", [1, 2])
def test_hot_keys_equal_brute_force(spark, monkeypatch, hot, seed):
    monkeypatch.setattr(repeats, "HOT", hot)
    texts = mixture(seed)
    assert found(spark, texts) == brute.repeats(texts)


def test_the_interval_tree_equals_brute_force(spark):
    texts = mixture(3)
    assert found(spark, texts) == brute.repeats(texts)


def test_neighbours_over_partitions(spark):
    rng = random.Random(3)
    rows = [(i, rng.randrange(4), bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9)))) for i in range(200)]
    rows.append((999, 77, b"alone"))

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    want = {i: max((common(v, w) for j, q, w in rows if q == p and j != i), default=None) for i, p, v in rows}
    got = dict(repeats._neighbours(spark.createDataFrame(rows, "id long, part long, value binary").repartition(7)).collect())
    assert got == {i: v for i, v in want.items() if v is not None}


def test_remove_keeps_columns_of_any_name(spark):
    passage = prose(9, 60)
    df = spark.createDataFrame([(1, passage + " one", "a", "b", "c"), (2, passage + " two", "a", "b", "c")],
                               "id long, text string, unit string, unit_kept string, kept string")
    out = repeats.remove(df)
    assert out.columns == df.columns
    assert {(r["id"], r["unit"], r["unit_kept"], r["kept"]) for r in out.collect()} == {(1, "a", "b", "c"), (2, "a", "b", "c")}
    assert all(len(r["text"]) < 10 for r in out.collect())
