"""Whitening against numpy's eigenvalues and exact whole numbers."""

import math

import numpy as np
import pytest

from voxspark.llm import whitening as W


def plain(rows, components=32):
    """{id: (deviation, whitened)}, shares; straight from the definition, by numpy."""
    used = [(i, v) for i, v in rows if v and all(e is not None and math.isfinite(e) for e in v)]
    x = [[math.floor(64 * float(np.float32(e))) + 1_000_000 for e in v] for _, v in used]
    n, s = len(x), [sum(c) for c in zip(*x)]
    dev = [sum((n * e - t) ** 2 for e, t in zip(r, s)) for r in x]
    c = np.array([[(n * e - t) / n for e, t in zip(r, s)] for r in x])
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    return [i for i, _ in used], dev, c @ u / np.sqrt(e), e / np.trace(c.T @ c / n)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("dim,n", [(3, 40), (8, 200), (40, 90)])
def test_rows_equal_the_definition(spark, dim, n):
    rng = np.random.default_rng(dim)
    rows = [(i, [float(e) for e in rng.standard_normal(dim) * (1 + np.arange(dim))]) for i in range(n)]
    odd = [(1000, None), (1001, []), (1002, [None] + [1.0] * (dim - 1)), (1003, [math.nan] * dim), (1004, [math.inf] * dim)]
    got = W.whiten(frame(spark, rows + odd)).toPandas()
    ids, dev, white, share = plain(rows)
    k = min(dim, 32)
    assert len(got) == n * k and set(got.n) == {n}
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-10
    assert dict(zip(got.vec_id, map(int, got.deviation))) == dict(zip(ids, dev))
    w = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    assert list(got.component.drop_duplicates().sort_values()) == list(range(1, k + 1))
    sign = np.sign((w * white).sum(axis=0))
    assert np.abs(w * sign - white).max() < 1e-8
    assert np.allclose(got.groupby("component").explained.first(), share, rtol=1e-10)


def test_few_rows_and_names(spark):
    out = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        got = W.whiten(frame(spark, rows))
        assert got.columns == out and got.collect() == []
    two = W.whiten(frame(spark, [(1, [1.0, 2.0]), (None, [3.0, 2.0]), (1, [1.0, 2.0])])).collect()
    assert sorted((r.vec_id or 0, r.component, r.n) for r in two) == [(0, 1, 3), (1, 1, 3), (1, 1, 3)]
    rows = [(i, [float(i), float(i * i)]) for i in range(5)]
    ragged = W.whiten(frame(spark, rows + [(9, [1.0]), (10, [1.0, 2.0, 3.0])])).collect()
    assert {r.vec_id for r in ragged} == set(range(5)) and {r.n for r in ragged} == {5}
    clash = frame(spark, rows).selectExpr("*", "1 as x", "2 as n", "3 as id", "4 as w", "5 as component")
    assert len(W.whiten(clash).collect()) == 10


def test_exact_beyond_doubles(spark):
    """Large entries: sums and products stay whole numbers, deviations pass the range of longs."""
    rows = [(i, [2.0 ** 40 * (i % 7), 2.0 ** 41 * (i % 3) + i]) for i in range(30)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = [[math.floor(64 * e) + 1_000_000 for e in v] for _, v in rows]
    s = [sum(c) for c in zip(*x)]
    want = {i: sum((30 * e - t) ** 2 for e, t in zip(v, s)) for (i, _), v in zip(rows, x)}
    assert max(want.values()) > 2 ** 63
    assert {r.vec_id: int(r.deviation) for r in got} == want


def test_inertia_counts():
    rng = np.random.default_rng(4)
    for _ in range(200):
        d = int(rng.integers(1, 9))
        a = rng.integers(-2, 3, (d, d)).astype(float)
        a = a + a.T
        e = np.linalg.eigvalsh(a)
        if np.abs(e).min() > 1e-9:
            assert W.inertia(a) == (e < 0).sum()


@pytest.mark.parametrize("spectrum", [[5, 5, 5, 4, 4] + [1] * 10 + [0] * 5, [1] * 20, [0] * 20,
                                      [7, 7 + 1e-13, 7 - 1e-12] + [1] * 17, list(range(20)), [2.0 ** -k for k in range(20)]])
def test_spectrum_slicing(spectrum):
    q, _ = np.linalg.qr(np.random.default_rng(1).standard_normal((20, 20)))
    v = q @ np.diag(np.array(spectrum, dtype=float)) @ q.T
    v = (v + v.T) / 2
    e, x = W.leading(v, 12)
    top = max(max(spectrum), 1e-300)
    assert np.abs(e - np.sort(spectrum)[::-1][:12]).max() <= 1e-13 * top
    assert np.abs(x.T @ x - np.eye(12)).max() < 1e-13
    assert np.abs(v @ x - x * e).max() <= 1e-13 * top
