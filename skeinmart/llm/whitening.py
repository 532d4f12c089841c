"""Embedding whitening by Chebyshev-filtered subspace iteration over distributed covariance passes.

The covariance V of the vectors is never formed: a pass over the rows gives V Q for a
narrow block Q, as the sum of Xc' (Xc Q) over the centred rows Xc of every task. A
Chebyshev polynomial of V, evaluated by its three-term recurrence (one pass a degree),
damps the spectrum below the block's smallest Ritz value; QR and Rayleigh-Ritz follow, until
the residual of every wanted component certifies it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import map_arrow

# Entries become floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
# Largest magnitude of an entry: its x, and sums of many x, are exact in a long.
MOST = float(1 << 39)
COMPONENTS, BLOCK = 8, 32
# Residual of a certified component, as a share of the largest eigenvalue.
TOLERANCE = 1e-13
# Degree of one polynomial, growth (natural log) that one may give the largest component, and passes in all.
DEGREE, GROWTH, PASSES = 16, 28.0, 4000
# Components under this share of the trace have no direction and are left out.
LEAST_SHARE = 1e-12


def fixed_point(vector: Column) -> Column:
    """array<long> of floor(SCALE * c) + OFFSET; an entry beyond MOST is an error."""
    limit = F.raise_error(F.lit(f"an entry of a vector is beyond {MOST:.0f}")).cast("bigint")
    x = lambda c: F.floor(c.cast("double") * SCALE) + OFFSET
    return F.transform(vector, lambda c: F.when(F.abs(c) <= MOST, x(c)).otherwise(limit))


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    inf = float("inf")
    each = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < inf))
    return vector.isNotNull() & each


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy().reshape(batch.num_rows, -1)


def summed(rows: DataFrame, f: Callable[[np.ndarray], np.ndarray], height: int, width: int) -> np.ndarray:
    """Sum of f(x), a matrix of height x width, over all rows; one row a matrix row and task is shuffled."""
    names = [f"c{j}" for j in range(width)]

    def run(batches):
        total = np.zeros((height, width))
        for batch in batches:
            if batch.num_rows:
                total += f(matrix(batch))
        columns = [pa.array(np.arange(height, dtype=np.int32)), *(pa.array(np.ascontiguousarray(c)) for c in total.T)]
        yield pa.RecordBatch.from_arrays(columns, ["i", *names])

    parts = rows.select("x").mapInArrow(run, "i int, " + ", ".join(f"{c} double" for c in names))
    out = np.zeros((height, width))
    for r in parts.groupBy("i").agg(*(F.sum(c).alias(c) for c in names)).collect():  # height rows
        out[r.i] = r[1:]
    return out


def exact_sums(rows: DataFrame, dims: int) -> tuple[int, np.ndarray]:
    """Number of rows and the sums of each dimension, in long arithmetic that fails rather than wraps."""

    def run(batches):
        def block(total, n):
            index = np.arange(dims, dtype=np.int32)
            return pa.RecordBatch.from_arrays([pa.array(index), pa.array(total), pa.array(np.full(dims, n))], ["i", "s", "n"])

        total, n = np.zeros(dims, np.int64), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):  # 4096 rows of at most 2**50 stay below 2**62
                x = matrix(batch.slice(start, 4096))
                if np.abs(total).max(initial=0) >= 1 << 61:
                    yield block(total, n)
                    total, n = np.zeros(dims, np.int64), 0
                total, n = total + x.sum(axis=0), n + len(x)
        yield block(total, n)

    parts = rows.select("x").mapInArrow(run, "i int, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    found = {r.i: (r.s, r.n) for r in parts.collect()}  # one row a dimension
    return found[0][1], np.array([found[i][0] for i in range(dims)], np.int64)


def chebyshev(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, degree: int, high: float, top: float) -> np.ndarray:
    """T_degree of the map that takes [0, high] to [-1, 1], applied to q and scaled to about 1 at ``top``."""
    half = high / 2
    sigma = first = half / (top - half)
    before, now = q, (product(q) - half * q) * (sigma / half)
    for _ in range(1, degree):
        after = 1 / (2 / first - sigma)
        before, now = now, (product(now) - half * now) * (2 * after / half) - sigma * after * before
        sigma = after
    return now


def leading(product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, block: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Leading eigenvalues and unit eigenvectors (columns) of the symmetric, non-negative operator ``product``.

    Stops when ||V q - e q|| <= tolerance * e1 for every wanted pair, so an eigenvalue is
    certain to tolerance * e1, and an eigenvector to that over its gap.
    """
    wanted, block = min(wanted, dims), min(max(block, 2 * wanted), dims)
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((dims, block)))[0]
    passes = 0
    while True:
        vq = product(q)
        passes += 1
        small = q.T @ vq
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = values[0]
        if top <= 0:
            return values[:0], q[:, :0]
        residuals = np.linalg.norm(vq - q * values, axis=0)[:wanted]
        if residuals.max() <= tolerance * top or block == dims:
            return values[:wanted], q[:, :wanted]
        if passes > PASSES:
            raise ArithmeticError(f"residual {residuals.max() / top:.1e} of the largest eigenvalue after {passes} passes")
        low = max(values[wanted - 1], top * 1e-9)
        high = max(min(values[-1], low * 0.999), top * 1e-12)
        rate, most = (np.arccosh(2 * v / high - 1) for v in (low, top))
        short = np.log(residuals.max() / (tolerance * top)) + 1
        degree = int(max(1, min(DEGREE, GROWTH // most, np.ceil(short / rate))))
        q = np.linalg.qr(chebyshev(product, q, degree, high, top))[0]
        passes += degree


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
    block: int = BLOCK, tolerance: float = TOLERANCE,
) -> DataFrame:
    """A row for each vector and leading component: id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null, empty, or hold null or non-finite entries are dropped; so are
    those of another length than most vectors have (ties: the shorter length). The others
    all count in the n vectors of the fit; equal rows and equal or null ids stay rows of
    their own. Every entry becomes x = floor(1024 c) + 100000. ``deviation`` is the sum over
    dimensions of (n x - S)^2, S being the sums of x: exact, and an error beyond a long.
    ``whitened`` is the centred vector's projection on the component over the root of its
    eigenvalue, ``explained`` the eigenvalue's share of the trace, ``identity_error`` the
    largest entry by which the covariance of ``whitened`` differs from the identity. There are
    fewer components where the vectors have fewer dimensions, or vary in fewer: a
    component under 1e-12 of the trace is left out, and vectors that are all equal give no
    rows, as an empty table does. Other columns are ignored.

    What meets in the driver is bounded by the dimension, not by the rows: a matrix of
    dimension x block a pass.
    """
    vector = F.col(vec_col)
    kept = vectors.where(finite(vector) & (F.size(vector) > 0)).select(F.col(id_col).alias("id"), fixed_point(vector).alias("x"))
    rows = materialize(kept, "whitening-x")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(2).collect()
    dims = lengths[0].d if lengths else 0
    if len(lengths) > 1:
        rows = rows.where(F.size("x") == dims)
    kind = dict(vectors.dtypes)[id_col]
    name = f"`{id_col}`"
    schema = f"{name} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not dims:
        return vectors.sparkSession.createDataFrame([], schema)
    n, sums = exact_sums(rows, dims)
    base = sums // n  # whole numbers near the mean, so that what is squared stays small
    rest = sums - n * base
    mean = rest / n

    def centred(x: np.ndarray) -> np.ndarray:
        return (x - base) - mean

    def product(q: np.ndarray) -> np.ndarray:
        return summed(rows, lambda x: (c := centred(x)).T @ (c @ q), dims, q.shape[1]) / n

    trace = float(summed(rows, lambda x: np.square(centred(x)).sum(axis=0)[None, :].sum(axis=1, keepdims=True), 1, 1)[0, 0]) / n
    values, q = leading(product, dims, components, block, tolerance)
    known = values > LEAST_SHARE * trace
    values, q = values[known], q[:, known]
    if not len(values):
        return vectors.sparkSession.createDataFrame([], schema)
    project = q / np.sqrt(values)
    p = len(values)
    middle = summed(rows, lambda x: (centred(x) @ project).sum(axis=0)[None, :], 1, p)[0] / n
    spread = summed(rows, lambda x: (w := centred(x) @ project - middle).T @ w, p, p) / n
    error = float(np.abs(spread - np.eye(p)).max())
    explained = values / trace

    def score(batch: pa.RecordBatch):
        ids = batch.column(0)
        for start in range(0, batch.num_rows, 4096):
            x = matrix(part := batch.slice(start, 4096))
            away = n * (x - base) - rest
            if np.square(away.astype(float)).sum(axis=1).max() >= 2.0**63 * (1 - 1e-9):
                raise OverflowError("a deviation is beyond 64 bits")
            m = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(start, m).take(pa.array(np.repeat(np.arange(m), p))),
                    pa.array(np.tile(np.arange(1, p + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * p, n)),
                    pa.array(np.repeat(np.square(away).sum(axis=1), p)),
                    pa.array((centred(x) @ project).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * p, error)),
                ],
                [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return map_arrow(rows, score, schema)
