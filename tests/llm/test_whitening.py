"""Whitening and its eigenvectors, against numpy's dense solver and edge cases."""

import math

import numpy as np
import pytest
from tillhouse.llm import jacobi_davidson, queries, whitening

SF = "/root/testdata/sf0.01"


def usable(v):
    return v is not None and len(v) > 0 and all(e is not None and math.isfinite(e) for e in v)


def dense(vectors):
    """x, its eigenvalues and eigenvectors by falling value, the trace, and the whole-number deviations."""
    x = np.array([[math.floor(1024 * float(e)) + 100_000 for e in v] for v in vectors], np.int64)
    n, sums = len(x), x.sum(axis=0)
    centred = n * x - sums
    c = centred / n
    values, turn = np.linalg.eigh(c.T @ c / n)
    deviation = [sum(int(e) ** 2 for e in row) for row in centred]
    return c, values[::-1], turn[:, ::-1], np.trace(c.T @ c / n), deviation


def by_id(rows, k):
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert all(set(v) == set(range(1, k + 1)) for v in got.values())
    return got


def test_query(spark):
    """The registered query, all of its columns, over a whole table."""
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect() if usable(r.embedding)}
    ids = sorted(given)
    c, values, turn, trace, deviation = dense([given[i] for i in ids])
    got = by_id(queries.QUERIES["op11_jacobi_davidson"](spark, SF).collect(), 8)
    assert sorted(got) == ids
    z = np.array([[got[i][k].whitened for k in range(1, 9)] for i in ids])
    expected = c @ turn[:, :8] / np.sqrt(values[:8])
    signs = np.sign((z * expected).sum(axis=0))
    assert np.abs(z * signs - expected).max() < 1e-9
    assert [got[i][1].deviation for i in ids] == deviation and {r.n for v in got.values() for r in v.values()} == {len(ids)}
    for k in range(8):
        assert got[ids[0]][k + 1].explained == pytest.approx(values[k] / trace, rel=1e-12)
    error = {r.identity_error for v in got.values() for r in v.values()}
    assert len(error) == 1 and max(error) < 1e-10
    centred = z - z.mean(axis=0)
    assert np.abs(centred.T @ centred / len(z) - np.eye(8)).max() < 1e-10


@pytest.mark.parametrize("size,rows", [(1, 20), (2, 9), (7, 50), (40, 300), (150, 400), (30, 4)])
def test_eigenpairs(size, rows):
    rng = np.random.default_rng(size)
    c = rng.standard_normal((rows, size)) * np.geomspace(1, 0.05, size)
    c -= c.mean(axis=0)
    matrix = c.T @ c / rows
    found = jacobi_davidson.leading(lambda w: matrix @ w, size, 8)
    values, turn = np.linalg.eigh(matrix)
    values, turn = values[::-1], turn[:, ::-1]
    k = min(8, size)
    assert np.abs(found.values - values[:k]).max() < 1e-13 * values[0]
    assert np.linalg.norm(matrix @ found.vectors - found.vectors * found.values, axis=0).max() < 1e-11 * values[0]
    assert np.abs(found.vectors.T @ found.vectors - np.eye(k)).max() < 1e-13


def test_equal_eigenvalues():
    """A block of starts finds eigenvalues that come several times."""
    rng = np.random.default_rng(5)
    turn, _ = np.linalg.qr(rng.standard_normal((60, 60)))
    values = np.array([9.0] * 5 + [4.0] * 5 + [1.0] * 50)
    matrix = turn * values @ turn.T
    found = jacobi_davidson.leading(lambda w: matrix @ w, 60, 8)
    assert np.abs(found.values - values[:8]).max() < 1e-12


def test_minres_solves():
    rng = np.random.default_rng(6)
    a = rng.standard_normal((12, 12))
    a = a + a.T
    out = np.linalg.qr(rng.standard_normal((12, 2)))[0]
    right = rng.standard_normal((12, 3))
    shifts = np.array([0.1, -2.0, 40.0])
    steps, accuracy = jacobi_davidson.INNER_STEPS, jacobi_davidson.INNER_ACCURACY
    try:
        jacobi_davidson.INNER_STEPS, jacobi_davidson.INNER_ACCURACY = 30, 1e-12
        t = jacobi_davidson.minres(lambda w: a @ w, shifts, out, right)
    finally:
        jacobi_davidson.INNER_STEPS, jacobi_davidson.INNER_ACCURACY = steps, accuracy
    p = np.eye(12) - out @ out.T
    for j in range(3):
        assert np.linalg.norm(p @ (a - shifts[j] * np.eye(12)) @ t[:, j] - p @ right[:, j]) < 1e-9
    assert np.abs(out.T @ t).max() < 1e-12


def test_edges(spark):
    inf, nan = math.inf, math.nan
    good = [(1, [0.5, -0.25, 1.0]), (2, [0.1, 0.2, 0.3]), (2, [0.1, 0.2, 0.3]), (None, [-1.0, 0.0, 0.75]), (5, [0.0, 0.0, 0.0])]
    bad = [(6, None), (7, []), (8, [1.0, None, 0.0]), (9, [nan, 0.0, 0.0]), (10, [inf, 0.0, 0.0]), (11, [1.0, 2.0]), (12, [1.0] * 4)]
    rows = [(i, v, 1, "x", 2.0) for i, v in good + bad]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n int, x string, whitened double")
    got = whitening.whiten_rows(frame).collect()
    vectors = [[float(np.float32(e)) for e in v] for _, v in good]
    c, values, turn, trace, deviation = dense(vectors)
    assert len(got) == 5 * 3 and sorted({r.vec_id for r in got}, key=repr) == sorted({1, 2, None, 5}, key=repr)
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviation)
    first = np.sort(np.abs([r.whitened for r in got if r.component == 1]))
    assert np.allclose(first, np.sort(np.abs(c @ turn[:, 0] / np.sqrt(values[0]))))
    assert whitening.whiten_rows(frame.where("vec_id in (6, 8)")).count() == 0
    assert whitening.whiten_rows(frame.where("false")).count() == 0


def test_without_variance(spark):
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "vec_id long, embedding array<double>")
    rows = whitening.whiten_rows(same).collect()
    assert len(rows) == 6 and {(r.whitened, r.explained, r.identity_error, r.deviation) for r in rows} == {(None, None, None, 0)}
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(4)], "vec_id long, embedding array<double>")
    rows = whitening.whiten_rows(line).collect()
    assert {r.whitened is None for r in rows if r.component == 2} == {True} and max(r.identity_error for r in rows) < 1e-9


def test_large_deviations():
    block = np.array([[2**33, 0], [-(2**33), 5]], np.int64)
    assert whitening._deviation(block, 1, np.zeros(2, np.int64)) == [None, None]
    block = np.array([[2**31, 2**30]], np.int64)
    assert whitening._deviation(block, 1, np.zeros(2, np.int64)) == [2**62 + 2**60]
