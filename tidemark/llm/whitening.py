"""Embedding whitening by the Jacobi-Davidson method.

Components are entries of embeddings as integers (``floor(scale * c) + shift``),
so sums and deviations are exact.  The covariance itself is never formed: a
*product* is one distributed pass that adds up ``y (y^T W)`` over the centred
vectors ``y = (n x - S) / n`` of every task (centred before multiplying, in
integers), an aggregation by dimension adds the tasks' parts, and only a
dimensions x block matrix reaches the driver.

:func:`jacobi_davidson` finds the leading eigenpairs from products alone:

1. Rayleigh-Ritz in the subspace gives Ritz pairs and their residuals;
2. pairs whose residual has reached double precision are *locked*, leading ones
   first, and leave the subspace, which stays orthogonal to them;
3. for the others the correction equations, projected off the locked and the
   present Ritz vectors, are solved by some steps of MINRES; the equations of a
   block advance together, so a step is one pass;
4. corrections, orthogonalised, widen the subspace; a full one restarts with
   its best Ritz vectors.

Defined results: vectors that are null, or hold null or non-finite entries, are
left out; null ids ride along; repeated rows count as often as they stand
there; components without variance (an eigenvalue of at most dimensions x
machine epsilon of the largest) cannot be whitened and give no rows, so equal
vectors, a single one, or an empty table give an empty result; vectors of
different lengths are an error; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from tidemark.llm.common import only, ship
from tidemark.sources.scratch import materialise

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Subspace vectors for each wanted pair, at most.
WIDTH = 4
INNER_STEPS = 6
OUTER_STEPS = 60
#: Residuals of this many roundings of the largest eigenvalue are double precision.
ROUNDINGS = 16
SEED = 5
_EPS = np.finfo(np.float64).eps

Product = Callable[[np.ndarray], np.ndarray]


# --- the method, from products alone ------------------------------------------------

def _orthogonal(t: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns spanning ``t`` off the columns of ``against``; what
    is lost to rounding is dropped."""
    out = np.zeros((len(t), 0))
    for column in t.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        v = column / size
        base = np.hstack([against, out])
        for _ in range(3):
            v = v - base @ (base.T @ v)
        left = np.linalg.norm(v)
        if left > 1e-10:
            v = v / left
            v = v - base @ (base.T @ v)
            out = np.hstack([out, (v / np.linalg.norm(v))[:, None]])
    return out


def minres(apply: Product, b: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """Some steps of MINRES from zero for every column of ``b`` (a symmetric
    operator each), all columns in one application a step."""
    tiny = np.finfo(np.float64).tiny
    x = np.zeros_like(b)
    before, r, y = np.zeros_like(b), b.copy(), b.copy()
    beta = start = np.linalg.norm(b, axis=0)
    old = np.ones_like(beta)
    cs, sn = -np.ones_like(beta), np.zeros_like(beta)
    dbar, eps_, left = np.zeros_like(beta), np.zeros_like(beta), beta.copy()
    w, w_old = np.zeros_like(b), np.zeros_like(b)
    alive = beta > 0
    for step in range(steps):
        v = y / np.where(alive, beta, 1)
        y = apply(v)
        if step:
            y = y - (beta / old) * before
        alpha = (v * y).sum(axis=0)
        y = y - (alpha / np.where(alive, beta, 1)) * r
        before, r, old = r, y, np.where(alive, beta, 1)
        beta = np.linalg.norm(y, axis=0)
        eps_old, delta, gbar = eps_, cs * dbar + sn * alpha, sn * dbar - cs * alpha
        eps_, dbar = sn * beta, -cs * beta
        gamma = np.maximum(np.hypot(gbar, beta), tiny)
        cs, sn = gbar / gamma, beta / gamma
        phi, left = cs * left, sn * left
        w_old, w = w, (v - eps_old * w_old - delta * w) / gamma
        x = x + np.where(alive, phi, 0) * w
        alive = alive & (beta > 100 * _EPS * start)
        if not (alive & (left > tolerance * start)).any():
            break
    return x


def jacobi_davidson(product: Product, size: int, wanted: int, trace: float, width: int = WIDTH, inner: int = INNER_STEPS,
                    outer: int = OUTER_STEPS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit vectors, of
    the symmetric operator that ``product`` applies to a block of columns."""
    wanted = min(wanted, size)
    most = min(size, max(width * wanted, wanted + 2))
    locked, values = np.zeros((size, 0)), np.zeros(0)
    q = _orthogonal(np.random.default_rng(seed).standard_normal((size, min(size, wanted + 2))), locked)
    aq = product(q)
    fresh = True  # of the products, none is a sum of earlier ones
    for _ in range(outer):
        h = q.T @ aq
        theta, rotation = np.linalg.eigh((h + h.T) / 2)
        theta, rotation = theta[::-1], rotation[:, ::-1]
        u, au = q @ rotation, aq @ rotation
        residual = au - u * theta
        residual -= locked @ (locked.T @ residual)
        scale = max(np.max(np.abs(values), initial=0.0), np.max(np.abs(theta), initial=0.0), _EPS * trace)
        good = np.linalg.norm(residual, axis=0) <= ROUNDINGS * _EPS * np.sqrt(size) * scale
        missing = wanted - locked.shape[1]
        n = int(np.argmin(np.r_[good[:missing], False]))  # leading pairs first
        locked, values = np.hstack([locked, u[:, :n]]), np.r_[values, theta[:n]]
        q, aq, theta, residual = u[:, n:], au[:, n:], theta[n:], residual[:, n:]
        missing -= n
        if not missing:
            break
        now = q[:, :missing]
        off = np.hstack([locked, now])
        rest = size - locked.shape[1]
        if q.shape[1] >= rest:
            # The subspace is all there is: only rounding is left.
            if fresh:
                locked, values = np.hstack([locked, now]), np.r_[values, theta[:missing]]
                break
            aq, fresh = product(q), True
            continue
        shift = theta[:missing]

        def projected(v: np.ndarray, off=off, shift=shift) -> np.ndarray:
            v = v - off @ (off.T @ v)
            v = product(v) - shift * v
            return v - off @ (off.T @ v)

        right = residual[:, :missing]
        right = -(right - off @ (off.T @ right))
        if q.shape[1] + missing > most:
            keep = max(missing, min(q.shape[1], most - missing))
            q, aq = q[:, :keep], aq[:, :keep]
        wider = _orthogonal(minres(projected, right, inner, 0.05), np.hstack([locked, q]))
        if not wider.shape[1]:  # corrections lost to rounding: a new direction
            wider = _orthogonal(np.random.default_rng(seed + 1).standard_normal((size, 1)), np.hstack([locked, q]))
        q, aq, fresh = np.hstack([q, wider]), np.hstack([aq, product(wider)]), False
    else:
        raise ArithmeticError(f"{wanted - locked.shape[1]} of {wanted} eigenpairs did not reach double precision")
    # Once more in the locked subspace, with fresh products: one order for all.
    locked = np.linalg.qr(locked)[0]
    h = locked.T @ product(locked)
    values, rotation = np.linalg.eigh((h + h.T) / 2)
    return values[::-1], locked @ rotation[:, ::-1]


# --- Spark ---------------------------------------------------------------------------

@dataclass
class Model:
    """What :func:`fit` learns; bounded by dimensions x components."""

    n: int
    sums: np.ndarray  # of integers, exact
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x * self.n - self.sums) / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE,
             shift: int = SHIFT) -> DataFrame:
    """vec_id and x (array of long) of the vectors that take part; written."""
    df = only(vectors, [vec_id, embedding]).toDF("vec_id", "e").withColumn("e", F.col("e").cast("array<double>"))
    finite = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform("e", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(shift).cast("bigint"))
    return materialise(df.where(F.col("e").isNotNull() & finite).select("vec_id", x.alias("x")), "integers")


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one batch as rows."""
    ends = column.offsets.to_numpy()
    size = np.diff(ends)
    if len(size) and (size != size[0]).any():
        raise ValueError("vectors differ in length")
    values = column.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
    return values.reshape(len(size), -1) if len(size) else values.reshape(0, 0)


def _added(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray], columns: int) -> np.ndarray:
    """The sum over all vectors of ``of`` a batch (a matrix of ``columns``): a
    row per matrix row and task, added by Spark."""
    names = [f"c{i}" for i in range(columns)]

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                m = of(_matrix(batch.column(0)))
                total = m if total is None else total + m
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), *[pa.array(np.ascontiguousarray(c)) for c in total.T]], names=["j", *names])

    schema = StructType().add("j", "long")
    for c in names:
        schema = schema.add(c, "double")
    found = rows.select("x").mapInArrow(part, schema).groupBy("j").agg(*[F.sum(c).alias(c) for c in names])
    held = sorted(found.collect())  # a row per dimension
    return np.array([r[1:] for r in held], np.float64).reshape(len(held), columns)


def _sums(rows: DataFrame) -> tuple[int, np.ndarray]:
    """How many vectors there are, and exact sums by dimension."""
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            if x.size:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(x.shape[1])), pa.array(x.sum(axis=0)), pa.array(np.full(x.shape[1], len(x)))],
                    names=["j", "s", "n"])

    held = sorted(rows.select("x").mapInArrow(part, "j long, s long, n long").groupBy("j")
                  .agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect())
    if len({r["n"] for r in held}) > 1:
        raise ValueError("vectors differ in length")
    return (held[0]["n"] if held else 0), np.array([r["s"] for r in held], np.int64)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Model:
    """The leading components of all of ``rows`` (see :func:`integers`)."""
    ship(rows.sparkSession)
    n, sums = _sums(rows)
    d = len(sums)
    if not d:
        return Model(n, sums, 0.0, np.zeros(0), np.zeros((0, 0)))

    def centred(x: np.ndarray) -> np.ndarray:
        return (x * n - sums) / n

    trace = float(_added(rows, lambda x: (centred(x) ** 2).sum(axis=0)[:, None], 1).sum() / n)

    def product(w: np.ndarray) -> np.ndarray:
        def of(x: np.ndarray) -> np.ndarray:
            y = centred(x)
            return y.T @ (y @ w)

        return _added(rows, of, w.shape[1]) / n

    if not trace > 0:
        return Model(n, sums, trace, np.zeros(0), np.zeros((d, 0)))
    values, vectors = jacobi_davidson(product, d, components, trace)
    use = values > d * _EPS * values[0]
    return Model(n, sums, trace, values[use], vectors[:, use])


def identity_error(rows: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the
    identity, from one pass over all rows."""
    k = len(model.values)

    def of(x: np.ndarray) -> np.ndarray:
        z = model.project(x)
        return np.vstack([z.T @ z, z.sum(axis=0)])

    held = _added(rows, of, k)
    mean = held[k] / model.n
    return float(np.abs(held[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """A row per vector and component: vec_id, component (from 1), n, deviation
    (decimal(38,0), exact), whitened, explained and identity_error."""
    rows = integers(vectors, vec_id, embedding, scale, shift)
    model = fit(rows, components)
    schema = StructType([rows.schema["vec_id"]]).add("component", "integer").add("n", "long") \
        .add("deviation", DecimalType(38, 0)).add("whitened", "double").add("explained", "double").add("identity_error", "double")
    if not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    error = identity_error(rows, model)
    k = len(model.values)
    explained = model.values / model.trace

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                x = _matrix(batch.column(1))
                apart = x * model.n - model.sums
                size = float(np.abs(apart).max(initial=0))
                if size * size * x.shape[1] < 2.0 ** 62:
                    deviation = (apart * apart).sum(axis=1).tolist()
                else:
                    deviation = [sum(v * v for v in row) for row in apart.tolist()]
                m = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n)),
                     pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), k))),
                     pa.array(model.project(x).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))], names=schema.names)

    return rows.mapInArrow(emit, schema)
