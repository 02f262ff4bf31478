"""Whitening against a dense eigensolver and integer sums in Python."""

import math

import numpy as np
import pytest

from pitchforge.llm import feast_whitening as fw
from pitchforge.llm import registry

from .conftest import SF


def plain(vectors, k=4):
    """n, deviations, eigenvalues, vectors and trace of a list of vectors that take part."""
    x = [[math.floor(256 * float(c)) for c in v] for v in vectors]
    width = max(map(len, x))
    x = [v + [0] * (width - len(v)) for v in x]
    fit = sorted(set(map(tuple, x)))
    n, total = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    dev = [sum((n * a - s) ** 2 for a, s in zip(v, total, strict=True)) for v in x]
    c = np.array([[float(a) - s / n for a, s in zip(v, total, strict=True)] for v in fit])
    e, y = np.linalg.eigh(c.T @ c / n)
    rows = np.array([[a - s / n for a, s in zip(v, total, strict=True)] for v in x])
    return n, dev, e[::-1][:k], y[:, ::-1][:, :k], e.sum(), rows


def check(got, vectors, k=4):
    """``got``: rows of one (vec_id, vector) list in its order of ids 0, 1, ..."""
    n, dev, e, y, trace, rows = plain(vectors, k)
    w = {(r["vec_id"], r["component"]): r for r in got}
    shown = min(k, rows.shape[1])
    assert len(got) == len(w) == len(vectors) * shown
    for j in range(shown):
        col = [w[i, j + 1] for i in range(len(vectors))]
        assert [r["n"] for r in col] == [n] * len(vectors) and [r["deviation"] for r in col] == dev
        if e[j] <= 1e-9 * e[0] or not e[0]:
            assert all(r["whitened"] is None and r["explained"] == 0 for r in col)
            continue
        want = rows @ y[:, j] / e[j] ** 0.5
        have = np.array([r["whitened"] for r in col])
        at = np.abs(want).argmax()
        assert np.allclose(have * np.sign(have[at]), want * np.sign(want[at]), atol=1e-9, rtol=1e-9)
        assert all(abs(r["explained"] - e[j] / trace) <= 1e-9 for r in col) and all(r["identity_error"] < 1e-9 for r in col)


def test_query_on_the_table(spark):
    got = registry.op12_feast_whitening(spark, SF).collect()
    src = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in src] == list(range(len(src)))
    check(got, [r["embedding"] for r in src])


def table(spark, path, vectors):
    rows = [(i, v, 7, 8) for i, v in enumerate(vectors)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, n int, deviation int").repartition(3).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_odd_vectors(spark, tmp_path):
    rng = np.random.default_rng(1)
    good = [*rng.standard_normal((40, 5)).tolist(), [0.5, 1.0], [], [-0.0] * 5, [1e3, -1e3, 3.0, 0.1, 0.2]]
    good += [good[0], good[0], good[3]]
    bad = [None, [None, 1.0], [float("nan")], [float("inf"), 0.0], [-float("inf")], [1e300, 0.0]]
    got = fw.whiten(table(spark, tmp_path / "a", [*good, *bad])).collect()
    check(got, good)


def test_dependent_and_few_dimensions(spark, tmp_path):
    rng = np.random.default_rng(2)
    two = rng.integers(-50, 50, (30, 2))
    vectors = (two @ rng.integers(-3, 4, (2, 6))).astype(float).tolist()
    check(fw.whiten(table(spark, tmp_path / "a", vectors)).collect(), vectors)
    check(fw.whiten(table(spark, tmp_path / "b", [[1.0], [2.0], [4.5]])).collect(), [[1.0], [2.0], [4.5]])
    same = fw.whiten(table(spark, tmp_path / "c", [[1.0, 2.0]] * 3)).collect()
    assert len(same) == 6 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] == 0
                                  and r["identity_error"] is None for r in same)


def test_deviation_beyond_a_long_is_null(spark, tmp_path):
    got = fw.whiten(table(spark, tmp_path / "a", [[2.0 ** 40], [0.0], [1.0]])).collect()
    assert [r["deviation"] for r in sorted(got, key=lambda r: r["vec_id"])] == [None] * 3
    w = np.array([r["whitened"] for r in sorted(got, key=lambda r: r["vec_id"])])
    assert np.allclose(np.abs(w), [2 ** 0.5, 0.5 ** 0.5, 0.5 ** 0.5]) and abs(w.sum()) < 1e-9


@pytest.mark.parametrize("vectors", [[], [None], [[]]])
def test_no_vectors(spark, tmp_path, vectors):
    got = fw.whiten(table(spark, tmp_path / "a", vectors))
    assert got.collect() == [] and got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def spectra():
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    yield np.cov(rng.standard_normal((300, 40)).T), 4
    yield np.cov(rng.standard_normal((300, 40)).T), 40
    yield turn @ np.diag(0.1 ** np.arange(40.0)) @ turn.T, 6
    yield turn @ np.diag(1 + 1e-9 * np.arange(40)) @ turn.T, 4
    yield turn @ np.diag(1 / (1 + np.arange(40.0))) @ turn.T, 25
    yield np.diag([5.0, 5, 5, 1, 1, 1, 1, 0]), 4
    yield np.eye(20), 20


@pytest.mark.parametrize("v,k", list(spectra()))
def test_eigenpairs(v, k):
    v = (v + v.T) / 2
    e, y = fw.leading(v, k)
    want = np.linalg.eigvalsh(v)[::-1][:k]
    assert len(e) == min(k, (want > 1e-12 * want[0]).sum()) and np.allclose(e, want[:len(e)], atol=1e-13 * want[0], rtol=0)
    assert np.abs(v @ y - y * e).max() < 1e-12 * want[0] and np.abs(y.T @ y - np.eye(len(e))).max() < 1e-13


def test_inertia_and_slices():
    values = np.array([1, 1, 1, 0.6, 0.5, 0.499, 0.3, 0.0])
    turn = np.linalg.qr(np.random.default_rng(3).standard_normal((8, 8)))[0]
    t = fw.tridiagonal(turn @ np.diag(values) @ turn.T)
    for shift in (-1, 0.2, 0.4, 0.4995, 0.55, 0.9, 1.1):
        assert fw.count_above(t, shift) == (values > shift).sum()
    for k in range(1, 8):
        parts = fw.slices(t, k, 1 + 1e-9)
        assert sum(c for *_, c in parts) >= k and all(c == ((values > a) & (values <= b)).sum() for a, b, c in parts)


def test_exact_products():
    a = np.random.default_rng(4).integers(-2 ** 61, 2 ** 61, (5000, 3))
    assert (fw.products(a) == a.astype(object).T @ a.astype(object)).all()
    small = a >> 50
    assert (fw.products(small) == small.T @ small).all()
