"""Whitening of embeddings by QDWH spectral divide and conquer.

Vectors are taken as whole numbers ``x = floor(64 * c) + 1000000``.  The model is fitted on each
distinct x once: its sums exactly, then its covariance (divisor n) from centred vectors, both as
partial sums of tasks that Spark adds up in groups.  What reaches the driver is one vector and one matrix
of the embedding's dimension, whatever the number of rows.

*Divide and conquer.*  For a shift inside the spectrum, the polar factor of ``V - shift * I`` (QR-based
dynamically weighted Halley iterations) has eigenvalues 1 and -1, so ``(I + U) / 2`` projects onto the
invariant subspace above the shift.  Orthonormal bases of both subspaces split the matrix into two smaller
ones, until each is a number (or a multiple of the identity); the joined bases are the
eigenvectors.  The components with the largest eigenvalues, over the root of these, are broadcast and
applied to all rows.

Cases: a row whose vector is null, empty, or holds a null, a non-finite entry or one beyond the whole
numbers of 64 bits, is dropped.  If lengths differ, the most frequent one (of equal ones the
smallest) is the dimension, and rows of other lengths are dropped.  Rows alike, null and repeated ids are
kept as they are.  Where an eigenvalue is no more than rounding error, ``whitened`` is 0 and the component
has no part in ``identity_error``.  ``deviation`` beyond 64 bits is null.  An empty table gives no rows.  Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import importable, materialize

COMPONENTS = 16
SCALE, OFFSET = 64, 1_000_000
ROWS = 4096  # vectors handled at a time in a task
GROUPS = 32  # partial sums added up in one task
EPS = np.finfo(float).eps


class Model(NamedTuple):
    n: int
    sums: list[int]
    #: unit eigenvectors as columns, by falling eigenvalue
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float


# ---- spectral decomposition
def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by QDWH iterations."""
    d = len(a)
    alpha = np.linalg.norm(a)
    x, eye = a / alpha, np.eye(d)
    try:
        low = 1 / (np.linalg.norm(np.linalg.inv(x), 1) * np.sqrt(d))  # the least singular value is not below it
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS), 1.0)
    for _ in range(60):  # six suffice for any condition number in doubles
        d2 = np.cbrt(4 * (1 - low**2) / low**4)
        root = np.sqrt(1 + d2)
        wa = root + 0.5 * np.sqrt(8 - 4 * d2 + 8 * (2 - low**2) / (low**2 * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:d] @ q[d:].T)
        new = (new + new.T) / 2
        low = min(low * (wa + wb * low**2) / (1 + wc * low**2), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if moved <= (5 * EPS) ** (1 / 3) and 1 - low <= 10 * EPS:
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Bases of the invariant subspaces above and below ``shift``, and what couples them."""
    d = len(a)
    u = polar_factor(a - shift * np.eye(d))
    above = (u + np.eye(d)) / 2
    k = int(round(np.trace(above)))
    if not 0 < k < d:
        return None
    # one step of subspace iteration from the columns of the largest norms, which span the range
    order = np.argsort(-np.linalg.norm(above, axis=0), kind="stable")
    q, _ = np.linalg.qr(above[:, order], mode="complete")
    for _ in range(2):
        q, _ = np.linalg.qr(np.hstack([above @ q[:, :k], q[:, k:] - above @ q[:, k:]]))
    hi, lo = q[:, :k], q[:, k:]
    return hi, lo, float(np.linalg.norm(lo.T @ a @ hi))


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    scale = np.linalg.norm(a)
    values, vectors = [], []
    todo = [(a, np.eye(len(a)))]
    while todo:
        block, basis = todo.pop()
        d = len(block)
        diagonal = np.diag(block).copy()
        centre = float(diagonal.mean())
        if d <= 1 or np.linalg.norm(block - centre * np.eye(d)) <= EPS * scale:
            values += list(diagonal)
            vectors += list(basis.T)
            continue
        # the diagonal lies within the spectrum, so shifts between its ends split it
        ends = np.sort(diagonal)
        spread = np.linalg.norm(block - centre * np.eye(d)) / d
        shifts = [float(np.median(diagonal)), centre, *[centre + f * spread for f in (0.1, -0.1, 0.3, -0.3, 0.02, -0.02)],
                  float(ends[0] + ends[1]) / 2, float(ends[-1] + ends[-2]) / 2]
        best = None
        for shift in shifts:
            got = _split(block, shift)
            if got and (best is None or got[2] < best[2]):
                best = got
            if best and best[2] <= 10 * EPS * scale * np.sqrt(len(a)):
                break
        if best is None:  # alike but for rounding
            values += list(diagonal)
            vectors += list(basis.T)
            continue
        for part in best[:2]:
            sub = part.T @ block @ part
            todo.append(((sub + sub.T) / 2, basis @ part))
    order = np.argsort(-np.array(values), kind="stable")
    q, r = np.linalg.qr(np.array(vectors).T[:, order])  # orthonormal to the last bit
    return np.array(values)[order], q * np.sign(np.diag(r))


# ---- vectors in tasks
def _arrays(batch: pa.RecordBatch, name: str, d: int) -> Iterator[tuple[int, np.ndarray]]:
    column = batch.column(name)
    for at in range(0, len(column), ROWS):
        part = column.slice(at, ROWS)
        yield at, part.flatten().to_numpy(zero_copy_only=False).reshape(len(part), d)


def whole_vectors(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """``vec_id, x``: the rows that remain, as whole numbers, in SQL functions."""
    limit = float(1 << 62)
    beyond = F.exists("v", lambda v: v.isNull() | F.isnan(v) | (v >= limit) | (v <= -limit))
    picked = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), F.transform(
        F.col(f"`{column}`"), lambda v: F.when(~F.isnan(v), v.cast("double") * SCALE)).alias("v"))
    picked = picked.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(~beyond)
    return picked.select("vec_id", F.transform("v", lambda v: F.floor(v) + F.lit(OFFSET).cast("long")).alias("x"))


def _sum_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for value in batch.column("part"):
            part = np.frombuffer(value.as_buffer(), dtype=np.float64)
            total = part.copy() if total is None else total + part
    yield from _part(total)


def _part(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])


def _partial(fit: DataFrame, d: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all fitted vectors of ``of(vectors)``, a block of vectors at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _arrays(batch, "x", d):
                part = of(x)
                total = part if total is None else total + part
        yield from _part(total)

    parts = fit.mapInArrow(run, "part binary")
    for groups in (GROUPS, 1):
        parts = parts.repartition(groups).mapInArrow(_sum_of_parts, "part binary")
    return np.frombuffer(parts.first()["part"], dtype=np.float64)


def _sums(d: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            for _, x in _arrays(batch, "x", d):
                n += len(x)
                halves = zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))  # neither can overflow
                total = [t + (int(hi) << 32) + int(lo) for t, (hi, lo) in zip(total, halves)]
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)),
                pa.array([n] * d, pa.int64())], ["i", "s", "n"])

    return run


def centred(x: np.ndarray, mean: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """``x - S / n`` in full precision: ``mean`` is the whole number next to S / n, ``rest`` what it lacks."""
    return (x - mean).astype(np.float64) - rest


def _mean(sums: list[int], n: int) -> tuple[np.ndarray, np.ndarray]:
    whole = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(whole, dtype=np.int64), np.array([(s - w * n) / n for s, w in zip(sums, whole)])


def fit_model(fit: DataFrame, d: int, components: int = COMPONENTS) -> Model:
    """The model of a written table of distinct vectors ``x``."""
    n, sums = 0, [0] * d
    exact = fit.mapInArrow(_sums(d), "i int, s decimal(38,0), n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    for row in exact.collect():  # one row for each dimension
        sums[row["i"]], n = int(row["s"]), row["n"]
    mean, rest = _mean(sums, n)

    def scatter(x):
        c = centred(x, mean, rest)
        return (c.T @ c).ravel()

    v = _partial(fit, d, scatter).reshape(d, d) / n
    v = (v + v.T) / 2
    values, vectors = eigen(v)
    k = min(components, d)
    good = values[:k] > d * EPS * max(values[0], 0)
    scales = np.where(good, 1 / np.sqrt(np.where(good, values[:k], 1)), 0)
    weights = vectors[:, :k] * scales

    def moments(x):
        w = centred(x, mean, rest) @ weights
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    got = _partial(fit, d, moments)
    means, second = got[:k] / n, got[k:].reshape(k, k) / n
    error = np.abs(second - np.outer(means, means) - np.eye(k))[np.ix_(good, good)]
    return Model(n, sums, vectors[:, :k], values[:k], float(np.trace(v)), float(error.max()) if error.size else 0.0)


_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def _whitener(model: Model):
    d, k = model.vectors.shape
    mean, rest = _mean(model.sums, model.n)
    good = model.values > d * EPS * max(model.values[0], 0)
    weights = model.vectors * np.where(good, 1 / np.sqrt(np.where(good, model.values, 1)), 0)
    explained = model.values / model.trace if model.trace > 0 else np.zeros(k)
    n, sums, error = model.n, np.array(model.sums, dtype=object), model.identity_error

    def deviations(x: np.ndarray) -> list[int | None]:
        whole = (x.astype(object) * n - sums) if max(abs(int(x.max())), abs(int(x.min()))) * n >= 1 << 62 else x * n - sums.astype(np.int64)
        most = max(abs(int(whole.max())), abs(int(whole.min())))
        if most * most * d >= 1 << 62:
            whole = whole.astype(object)
        return [s if s < 1 << 63 else None for s in map(int, (whole * whole).sum(axis=1))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _arrays(batch, "x", d):
                m = len(x)
                ids = batch.column("vec_id").slice(at, m).cast(pa.int64())
                w = centred(x, mean, rest) @ weights
                rows = np.repeat(np.arange(m), k)
                columns = [ids.take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                           pa.array(np.full(m * k, n, dtype=np.int64)), pa.array(deviations(x), pa.int64()).take(pa.array(rows)),
                           pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _OUT.split(", ")])

    return run


def whiten(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each remaining row of ``vectors`` and component."""
    spark = vectors.sparkSession
    importable(spark)
    remaining = whole_vectors(vectors, id_column, column)
    lengths = remaining.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], _OUT)
    d = lengths["d"]
    remaining = remaining.where(F.size("x") == d)
    fit = materialize(remaining.groupBy("x").agg(F.count("*").alias("rows")).select("x"), "fit")
    model = fit_model(fit, d, components)
    return remaining.mapInArrow(_whitener(model), _OUT)
