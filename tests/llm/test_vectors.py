"""Hard negatives and whitening against brute force."""

import itertools
import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.llm import negatives, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(vector):
    return vector is not None and all(c is not None and math.isfinite(c) for c in vector)


def mined(rows, anchor, label, positives=5, negatives_=3, least=50, most=95, scale=256):
    """(anchor, positive, rank, negative, positive score, negative score)."""
    rows = [(i, label(i, y), [math.floor(scale * c) for c in v]) for i, v, y in rows if y is not None and usable(v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for n, (i, y, x) in enumerate(rows):
        if i is None or not anchor(i):
            continue
        scores = [(dot(x, v), j, z == y) for m, (j, z, v) in enumerate(rows) if m != n]
        for p, j, _ in sorted((s for s in scores if s[2]), key=order)[:positives]:
            inside = [s for s in scores if not s[2] and least * p <= 100 * s[0] <= most * p]
            out += [(i, j, r + 1, s[1], p, s[0]) for r, s in enumerate(sorted(inside, key=order)[:negatives_])]
    return out


def key(row):
    return str(row)


def test_hard_negatives(spark, results):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want = mined(rows, lambda i: i % 50 == 0, lambda i, y: (y + 1) % 10 if i % 7 == 0 else y)
    got = [tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
           for r in results("op12_hard_negatives")]
    assert sorted(got, key=key) == sorted(want, key=key) and len(got) > 50


@pytest.mark.parametrize("tile", [3, 16, 2048])
def test_hard_negatives_edges(spark, tile):
    rng = np.random.default_rng(tile)
    base = [(i, [float(x) for x in rng.integers(-2, 6, 5) / 4], int(rng.integers(0, 3))) for i in range(60)]
    rows = base + base[:9] + [(None, base[0][1], 0), (None, base[3][1], 1), (70, None, 1), (71, [1.0, None, 0.0, 0.0, 0.0], 1),
                              (72, [1.0, math.nan, 0.0, 0.0, 0.0], 1), (73, [math.inf] * 5, 1), (75, base[2][1], None),
                              (80, [0.0] * 5, 0), (85, [-1.0] * 5, 2), (90, base[5][1], 7)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "row", "x", "score", "i", "g", "rank", "tile")})
    got = [tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in
           negatives.mine(df, F.col("id") % 5 == 0, F.col("label"), scale=8, tile=tile).collect()]
    want = mined(rows, lambda i: i % 5 == 0, lambda i, y: y, scale=8)
    assert sorted(got, key=key) == sorted(want, key=key) and len(got) > 50
    assert negatives.mine(df.where("false"), F.col("id") % 5 == 0, F.col("label")).count() == 0
    assert negatives.mine(df, F.lit(False), F.col("label")).count() == 0


def test_hard_negatives_refuse_vectors_of_different_lengths(spark):
    df = spark.createDataFrame([(0, [1.0], 1), (50, [1.0, 2.0], 1)], SCHEMA)
    with pytest.raises(Exception, match="differ in length"):
        negatives.mine(df, F.col("id") % 50 == 0, F.col("label")).collect()


def test_strassen():
    rng = np.random.default_rng(0)
    for m, k, n in [(1, 1, 1), (7, 5, 9), (33, 64, 35), (0, 4, 3), (70, 67, 71), (5, 100, 200)]:
        a, b = rng.integers(-300, 300, (m, k)), rng.integers(-300, 300, (k, n))
        for leaf in (1, 4, 32):
            assert (negatives.strassen(a, b, leaf) == a @ b).all()
    # Beyond doubles: results near 2**62 whose partial sums wrap.
    a, b = rng.integers(-(1 << 28), 1 << 28, (40, 40)), rng.integers(-(1 << 28), 1 << 28, (40, 40))
    assert (negatives.strassen(a, b, 2).astype(object) == a.astype(object) @ b.astype(object)).all()


def test_heaps_merge_in_any_order():
    rng = np.random.default_rng(1)
    n = 300
    entries = {"anchor": rng.integers(0, 4, n), "place": rng.integers(0, 2, n), "score": rng.integers(0, 9, n),
               "id": rng.integers(0, 40, n), "no_id": rng.integers(0, 2, n), "row": np.arange(n)}
    whole = negatives.first_of(entries, 3)
    for order in itertools.permutations(range(3)):
        held = None
        for i in order:
            part = negatives.first_of({c: v[i::3] for c, v in entries.items()}, 3)
            held = part if held is None else negatives.first_of(negatives._joined([held, part]), 3)
        assert all((held[c] == whole[c]).all() for c in whole)


# --- whitening -------------------------------------------------------------------------

def whitened(vectors, k, scale=64, shift=1_000_000):
    x = np.floor(np.array(vectors, np.float64) * scale).astype(np.int64) + shift
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    values, u = np.linalg.eigh(y.T @ y / n)
    values, u = values[::-1][:k], u[:, ::-1][:, :k]
    deviation = [sum(int(v) ** 2 for v in row) for row in n * x - s]
    return deviation, y @ u / np.sqrt(values), values / (y ** 2).sum() * n


def test_whitening(spark, results):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    held = {r[0]: r[1] for r in rows if usable(r[1])}
    ids = sorted(held)
    deviation, z, explained = whitened([held[i] for i in ids], 32)
    got = defaultdict(dict)
    for r in results("op13_embedding_whitening"):
        got[r["vec_id"]][r["component"]] = r
        assert r["n"] == len(ids) and r["identity_error"] <= 1e-9
        assert abs(r["explained"] / explained[r["component"] - 1] - 1) < 1e-10
    assert sorted(got) == ids
    found = np.array([[got[i][c]["whitened"] for c in range(1, 33)] for i in ids])
    assert [got[i][1]["deviation"] for i in ids] == deviation
    assert np.allclose(found * np.sign((found * z).sum(axis=0)), z, atol=1e-8)


def test_whitening_edges(spark):
    rng = np.random.default_rng(4)
    good = [[float(x) for x in v] for v in rng.standard_normal((30, 3)).astype(np.float32)]
    rows = [(i, v, 0) for i, v in enumerate(good)] + [(None, good[0], 0), (3, good[3], 0), (40, None, 0),
                                                       (41, [1.0, None, 2.0], 0), (42, [1.0, math.nan, 2.0], 0), (43, [math.inf] * 3, 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("x", "n", "component", "whitened", "j", "c0")})
    got = whitening.whiten(df).collect()
    held = [v for _, v, _ in rows if usable(v)]
    deviation, z, _ = whitened(held, 3)
    assert len(got) == 3 * len(held) and {r["n"] for r in got} == {len(held)}
    assert sorted(int(r["deviation"]) for r in got if r["component"] == 1) == sorted(deviation)
    assert sum(r["vec_id"] is None for r in got) == 3 and sum(r["vec_id"] == 3 for r in got) == 6
    assert whitening.whiten(df, components=2).count() == 2 * len(held)
    for none in (df.where("false"), df.where("vec_id = 5"), df.where("vec_id = 3"), df.where("embedding is null")):
        assert whitening.whiten(none).collect() == []
    flat = spark.createDataFrame([(i, [float(i), 1.0, float(2 * i)], 0) for i in range(9)], SCHEMA)
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}  # one direction has variance
    with pytest.raises(Exception, match="differ in length"):
        whitening.whiten(spark.createDataFrame([(0, [1.0], 1), (50, [1.0, 2.0], 1)], SCHEMA))


@pytest.mark.parametrize("size,wanted", [(64, 32), (200, 10), (300, 32), (3, 32), (1, 1)])
def test_jacobi_davidson(size, wanted):
    rng = np.random.default_rng(size)
    a = rng.standard_normal((2 * size + 5, size)) * rng.uniform(0.5, 2, size)
    v = a.T @ a / len(a)
    calls = []

    def product(w):
        calls.append(w.shape[1])
        return v @ w

    values, u = whitening.jacobi_davidson(product, size, wanted, np.trace(v))
    want = np.linalg.eigvalsh(v)[::-1][:wanted]
    assert np.allclose(values, want, rtol=1e-13, atol=0)
    assert np.linalg.norm(v @ u - u * values, axis=0).max() < 1e-13 * want[0]
    assert np.abs(u.T @ u - np.eye(len(values))).max() < 1e-13
    assert max(calls) <= max(wanted + 2, 1)  # blocks, never the whole operator


def test_jacobi_davidson_with_equal_eigenvalues():
    rng = np.random.default_rng(9)
    q = np.linalg.qr(rng.standard_normal((50, 50)))[0]
    v = (q * np.r_[[7.0] * 5, [3.0] * 20, np.zeros(25)]) @ q.T
    values, u = whitening.jacobi_davidson(lambda w: v @ w, 50, 12, np.trace(v))
    assert np.allclose(values, [7.0] * 5 + [3.0] * 7)
    assert np.allclose(v @ u, u * values)


def test_minres_solves():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((20, 20))
    a = a + a.T
    b = rng.standard_normal((20, 3))
    assert np.allclose(a @ whitening.minres(lambda v: a @ v, b, 200, 1e-13), b, atol=1e-6)
