"""Whitening against a plain eigendecomposition."""

import numpy as np
import pytest

from skeinmart.llm import whitening

KINDS = "vec_id long, embedding array<float>, label int, n string, component string, id string, x string"
INF, NAN = float("inf"), float("nan")


def plain(vectors, k=8):
    x = np.floor(1024 * np.asarray(vectors, np.float32).astype(float)).astype(np.int64) + 100000
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    v = c.T @ c / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), c @ u / np.sqrt(e), e / np.trace(v)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "a", "b", "c", "d") for i, v in rows], KINDS).repartition(3)


@pytest.mark.parametrize("dims, rows, block", [(40, 500, 16), (64, 300, 32), (5, 60, 32), (3, 3, 32)])
def test_components(spark, dims, rows, block):
    rng = np.random.default_rng(dims)
    vectors = rng.standard_normal((rows, dims)) * np.linspace(2, 1, dims) + rng.standard_normal(dims)
    vectors = [[float(x) for x in v] for v in vectors.astype(np.float32)]
    extra = [(-1, None), (-2, []), (-3, [NAN] * dims), (-4, [INF] + [0.0] * (dims - 1)), (-5, [None] + [0.0] * (dims - 1)), (-6, [1.0, 2.0])]
    got = whitening.whiten(frame(spark, [*enumerate(vectors), *extra]), block=block).toPandas().sort_values(["vec_id", "component"])
    k = min(8, dims, rows - 1)
    n, deviation, white, share = plain(vectors, k)
    assert list(got.columns) == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.vec_id.tolist() == list(np.repeat(np.arange(rows), k)) and set(got.n) == {n}
    assert got.deviation.to_numpy().reshape(rows, k).tolist() == np.repeat(deviation[:, None], k, axis=1).tolist()
    mine = got.whitened.to_numpy().reshape(rows, k)
    sign = np.sign((mine * white).sum(axis=0))
    assert np.abs(mine - white * sign).max() < 1e-8
    assert np.allclose(got.explained[:k], share, rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_ids_repeats_and_ties(spark):
    rng = np.random.default_rng(1)
    base = [[float(x) for x in v] for v in rng.standard_normal((30, 6)).astype(np.float32)]
    rows = [(None, base[0]), (7, base[0]), (7, base[0]), *((7, v) for v in base)]
    got = whitening.whiten(frame(spark, rows))
    assert got.count() == len(rows) * 6 and got.where("vec_id IS NULL").count() == 6
    signs = [(i, [a, b, 0.0]) for i, (a, b) in enumerate([(1.0, 1.0), (1.0, -1.0), (-1.0, 1.0), (-1.0, -1.0)] * 5)]
    got = whitening.whiten(frame(spark, signs)).toPandas()  # one eigenvalue twice, and a dimension that never varies
    assert sorted(set(got.component)) == [1, 2] and got.identity_error.iloc[0] < 1e-9


def test_no_rows(spark):
    empty = whitening.whiten(frame(spark, [(1, None)]))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []


def test_what_a_long_cannot_hold_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        whitening.whiten(frame(spark, [(1, [1e30, 1.0]), (2, [1.0, 2.0])]))
    with pytest.raises(Exception, match="beyond 64 bits"):
        whitening.whiten(frame(spark, [(i, [5e8 * (i % 2), 1.0 * i]) for i in range(9)])).collect()


def test_chebyshev_damps_the_unwanted_spectrum():
    e = np.linspace(0, 1, 50)
    e[-3:] = 2, 3, 4
    calls = []
    out = whitening.chebyshev(lambda q: calls.append(1) or e[:, None] * q, np.ones((50, 1)), 12, 1.0, 4.0)
    assert len(calls) == 12 and abs(out[-1, 0] - 1) < 1e-9 and np.abs(out[:-3]).max() < 1e-5 * np.abs(out[-3:]).max()


def test_flat_spectrum_is_certified():
    rng = np.random.default_rng(2)
    u = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    e = np.concatenate([[9.0, 9.0], np.linspace(1.02, 1, 30), np.linspace(0.99, 0, 168)])
    v = (u * e) @ u.T
    values, q = whitening.leading(lambda x: v @ x, 200, 8, 32, 1e-12)
    assert np.allclose(values, e[:8], atol=1e-10) and np.abs(v @ q - q * values).max() < 1e-10
