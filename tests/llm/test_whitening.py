"""Embedding whitening against a dense eigendecomposition and exact integer arithmetic."""

import math

import numpy as np
import pytest

from carelake.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, components=32):
    """x, S and the eigenpairs of V from whole lists, centred before multiplying."""
    ok = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    sizes = [len(v) for _, v in ok]
    dims = max(set(sizes), key=lambda s: (sizes.count(s), s))
    ok = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in ok if len(v) == dims]
    n, x = len(ok), [v for _, v in ok]
    s = [sum(v[j] for v in x) for j in range(dims)]
    dev = {i: sum((n * v[j] - s[j]) ** 2 for j in range(dims)) for i, v in ok}
    c = np.array([[(n * v[j] - s[j]) / n for j in range(dims)] for v in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    return n, dev, e[::-1][:components], u[:, ::-1][:, :components], {i: c[k] for k, (i, _) in enumerate(ok)}, e.sum()


def check(got, rows, tol=1e-6):
    n, dev, e, u, c, trace = brute(rows)
    k = len(e)
    assert len(got) == n * k
    for r in got:
        assert r.n == n and r.deviation == dev[r.vec_id]
        if e[r.component - 1] > 1e-9 * e[0]:
            assert abs(r.explained - e[r.component - 1] / trace) <= 1e-9
    live = np.flatnonzero(e > 1e-9 * e[0])
    by = {(r.vec_id, r.component): r.whitened for r in got}
    ids = sorted(c)
    y = np.array([[by[i, j + 1] for j in live] for i in ids])
    want = np.array([c[i] for i in ids]) @ u[:, live] / np.sqrt(e[live])
    for j in range(len(live)):
        if min(abs(e[live[j]] - e[m]) for m in range(len(e)) if m != live[j]) > 1e-6 * e[0]:
            assert min(np.abs(y[:, j] - want[:, j]).max(), np.abs(y[:, j] + want[:, j]).max()) < tol
    assert np.abs(y.T @ y / n - np.eye(len(live))).max() < 1e-8
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-8


def make(rng, n, dims):
    return rng.normal(size=(n, dims)) @ np.diag(np.linspace(0.05, 0.4, dims))


@pytest.mark.parametrize("block_rows", [1, 1024])
def test_equals_dense(spark, block_rows):
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(make(np.random.default_rng(1), 300, 40))]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(5)
    check(whitening.whiten(df, block_rows=block_rows).collect(), rows)


def test_many_spectra_combine(spark):
    """More tasks than one task combines: several rounds."""
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(make(np.random.default_rng(2), 200, 6))]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(40)
    check(whitening.whiten(df).collect(), rows)


def test_odd_vectors(spark):
    """Null, empty, non-finite and odd-length vectors go; repeated rows, null ids, constant and equal dimensions stay."""
    good = [[float(a), 0.5, float(b)] for a, b in make(np.random.default_rng(3), 30, 2)]
    good = [[a, b, c, a] for a, b, c in good]
    rows = list(enumerate(good)) + [(100, good[0]), (101, good[0])]
    bad = [(200, None), (201, []), (202, [1.0, None, 2.0, 3.0]), (203, [1.0, float("nan"), 0.0, 0.0]),
           (204, [float("inf"), 0.0, 0.0, 0.0]), (205, [1.0, 2.0]), (206, [3e38, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + bad], SCHEMA).repartition(3)
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == {i for i, _ in rows}
    check(got, rows)
    dead = [r for r in got if r.component > 2]
    assert {(r.whitened, r.explained) for r in dead} == {(0.0, 0.0)}


def test_extra_columns_ids_and_empty(spark):
    df = spark.createDataFrame([(None, [0.1, 0.9], "x", 1), ("a", [0.4, 0.2], "y", 2), ("a", [0.4, 0.2], "y", 2), ("b", [0.0, -3.0], None, 3)],
                               "vec_id string, embedding array<double>, whitened string, n int")
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id or "", r.component) for r in got) == sorted([(i, c) for i in ("", "a", "a", "b") for c in (1, 2)])
    assert whitening.whiten(df.limit(0)).count() == 0
    one = whitening.whiten(df.where("vec_id = 'b'")).collect()  # one vector: no variance at all
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, 0.0, 0.0, 0.0)] * 2


def test_secular_roots_and_deflation():
    """Rank-one updates with equal eigenvalues, vanishing entries and huge ranges keep values and orthogonality."""
    rng = np.random.default_rng(4)
    for d in (np.zeros(6), np.array([0, 0, 1, 1, 1, 2.0]), np.array([1e-9, 1e-3, 1, 1 + 1e-13, 5, 1e6])):
        for v in (rng.normal(size=6), np.array([0, 1e-20, 1, 0, 2, 0.0]), np.eye(6)[2]):
            u = np.linalg.qr(rng.normal(size=(6, 6)))[0]
            e, w = whitening.rank_one(d, u, 0.7, v)
            full = u * d @ u.T + 0.7 * np.outer(v, v)
            assert np.abs(w.T @ w - np.eye(6)).max() < 1e-13
            assert np.abs(w * e @ w.T - full).max() < 1e-13 * max(1, np.abs(full).max())


def test_exact_deviation_beyond_a_long():
    x = np.array([[0, 2 ** 50], [0, 0]], np.int64)
    assert whitening.deviations(x, 2, x.sum(0)) == [None, None]
    y = np.array([[1, 10 ** 6], [3, -10 ** 6], [5, 7]], np.int64)
    s = y.sum(0)
    assert whitening.deviations(y, 3, s) == [sum((3 * int(a) - int(b)) ** 2 for a, b in zip(r, s)) for r in y]
