"""Whitening against a full eigendecomposition, and contour integration on hard spectra."""

import numpy as np
import pytest

from tidemark.llm import feast
from tidemark.llm.whitening import Whitening, whitened


def turned(values, seed=3):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


SPECTRA = {
    "falling": np.geomspace(1e6, 1e-2, 64), "cluster": np.concatenate([np.full(12, 5.0), np.linspace(0, 1, 30)]), "close": 7 + np.arange(20) * 1e-9,
    "low rank": np.concatenate([[9.0, 4.0, 1.0], np.zeros(40)]), "one": np.array([3.0]), "two": np.array([3.0, 1.0]), "identity": np.ones(16),
    "even": np.arange(1.0, 33.0)}


@pytest.mark.parametrize("name", SPECTRA)
def test_contours_find_the_greatest_eigenpairs(name):
    values = np.sort(SPECTRA[name])[::-1]
    a = turned(values) if len(values) > 2 else np.diag(values)
    pieces = feast.intervals(a, 8)
    real = int((values > 1e-9).sum())
    assert sum(c for *_, c in pieces) >= min(8, real)
    assert all(x[0] >= y[1] for x, y in zip(pieces, pieces[1:]))
    got = [feast.eigenpairs(a, *p) for p in pieces]
    found = np.concatenate([v for v, _ in got])
    assert np.abs(found - values[:len(found)]).max() <= 1e-12 * values[0]
    for v, x in got:
        assert np.abs(a @ x - x * v).max() <= 1e-11 * values[0] and np.abs(x.T @ x - np.eye(len(v))).max() <= 1e-9


def test_inertia_counts_eigenvalues():
    values = np.sort(np.random.default_rng(1).normal(size=40))
    inertia = feast.Inertia(turned(values))
    for s in (-3.0, -0.5, 0.0, 0.7, 3.0):
        assert inertia.below(s) == (values < s).sum()


def test_no_matrix_without_variance_has_intervals():
    assert feast.intervals(np.zeros((5, 5)), 8) == []


def test_a_missed_eigenvalue_is_an_error():
    with pytest.raises(ArithmeticError):
        feast.eigenpairs(np.diag([1.0, 2.0, 3.0]), 1.5, 2.5, 2)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, n int, component int")


def expected(rows, k=8):
    import math

    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in good], dtype=object)
    n, s = len(x), x.sum(axis=0)
    deviation = [int(sum((n * a - b) ** 2 for a, b in zip(r, s))) for r in x]
    y = x.astype(float) - s.astype(float) / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    keep = values > 1e-9 * values[0]
    return [i for i, _ in good], n, deviation, y @ vectors[:, keep] / np.sqrt(values[keep]), values[keep] / np.trace(cov)


def vectors(n=300, d=12, seed=2):
    rng = np.random.default_rng(seed)
    return [(int(k), [float(v) for v in rng.normal(size=d) * np.geomspace(1, 0.1, d) + 0.3]) for k in range(n)]


ODD_VECTORS = [(None, [0.5] * 12), (1000, None), (1001, []), (1002, [0.1] * 11 + [None]), (1003, [float("nan")] * 12), (1004, [float("inf")] + [0.0] * 11),
               (1005, [0.25] * 12), (1005, [0.25] * 12), (1006, [1000.0] + [-1000.0] * 11)]


def test_whitening_agrees_with_a_full_decomposition(spark):
    rows = vectors() + ODD_VECTORS
    got = whitened(table(spark, rows).repartition(5)).collect()
    ids, n, deviation, want, explained = expected(rows)
    assert len(got) == len(ids) * 8 and {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1
    assert got[0]["identity_error"] <= 1e-9
    for c in range(8):
        mine = sorted((str(r["vec_id"]), r["deviation"], r["whitened"]) for r in got if r["component"] == c + 1)
        theirs = sorted(zip(map(str, ids), deviation, want[:, c].tolist()))
        flip = sorted(zip(map(str, ids), deviation, (-want[:, c]).tolist()))
        assert [m[:2] for m in mine] == [t[:2] for t in theirs]
        assert any(np.allclose([m[2] for m in mine], [t[2] for t in other], rtol=1e-8, atol=1e-8) for other in (theirs, flip))
        assert all(abs(r["explained"] / explained[c] - 1) < 1e-9 for r in got if r["component"] == c + 1)


def test_fewer_dimensions_than_components_and_no_variance(spark):
    rows = [(k, [float(k), 2.0 * k, 5.0]) for k in range(20)]
    assert {r["component"] for r in whitened(table(spark, rows)).collect()} == {1}
    assert whitened(table(spark, [(k, [1.0, 2.0]) for k in range(5)])).count() == 0
    assert whitened(table(spark, [(1, None)])).count() == 0
    assert whitened(table(spark, rows).limit(0)).count() == 0


def test_vectors_of_the_common_length_count(spark):
    rows = vectors(50, 6) + [(900, [1.0] * 5), (901, [1.0] * 7)]
    got = whitened(table(spark, rows), plan=Whitening(components=2)).collect()
    assert len(got) == 100 and {r["n"] for r in got} == {50}


def test_large_deviations_are_exact(spark):
    rows = [(k, [float((-1) ** k * 30_000 + k), float(k)]) for k in range(60)]
    got = {r["vec_id"]: r["deviation"] for r in whitened(table(spark, rows)).collect()}
    ids, _, deviation, _, _ = expected(rows)
    assert max(deviation) * 2 > 1 << 62 and got == dict(zip(ids, deviation))
