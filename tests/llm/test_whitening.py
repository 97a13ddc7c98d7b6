"""Whitening against exact fractions, and the eigenvector refinement on hard spectra."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from saleweft.llm.queries import QUERIES
from saleweft.llm.whitening import eigenvectors, exact_products, extended, whiten

COLUMNS = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def usable(v):
    return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v)


def plain(rows):
    """Per row: x, deviation; and n, sums and the exact covariance of the distinct x."""
    xs = [(i, tuple(math.floor(64 * float(c)) + 1_000_000 for c in v)) for i, v in rows if usable(v)]
    distinct = sorted({x for _, x in xs})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[k] for x in distinct) for k in range(d)]
    cov = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in distinct), n ** 3)
            for j in range(d)] for i in range(d)]
    return xs, n, sums, cov


def check(rows, got, components=16):
    xs, n, sums, cov = plain(rows)
    v = np.array(cov, float)
    values = np.linalg.eigvalsh(v)[::-1]
    d = len(sums)
    width = min(components, d)
    assert len(got) == len(xs) * width and {r.n for r in got} == {n}
    table = {}
    for r in got:
        table.setdefault((r.vec_id, r.deviation), []).append(r)
    expected = {}
    for i, x in xs:
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        expected.setdefault((i, dev), []).append(x)
    assert {k: len(x) * width for k, x in expected.items()} == {k: len(r) for k, r in table.items()}
    for k in range(width):
        share = {r.explained for r in got if r.component == k + 1}
        assert len(share) == 1 and abs(share.pop() - values[k] / v.trace()) <= 1e-9
    # one row of each distinct x: the whitened list has unit covariance
    seen = {}
    for i, x in xs:
        r = sorted(table[i, sum((n * c - s) ** 2 for c, s in zip(x, sums))], key=lambda r: r.component)
        seen.setdefault(x, [q.whitened for q in r[:: len(r) // width]])
    w = np.array([seen[x] for x in sorted(seen)])
    centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in sorted(seen)])
    assert np.abs(w.T @ w / n - np.eye(width)).max() < 1e-9
    # whitened = centred . axis / sqrt(e): the axes that explain it are unit eigenvectors
    axes = np.linalg.lstsq(centred, w, rcond=None)[0] * np.sqrt(values[:width])
    assert np.abs(v @ axes - axes * values[:width]).max() < 1e-9 * values[0]
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_all_embeddings(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got = QUERIES["op13_embedding_whitening"](spark, folder)
    assert tuple(got.columns) == COLUMNS
    check(rows, got.collect())


def test_awkward_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(0, 0.3, 20).tolist()) for k in range(200)]
    rows += [(k, rows[3][1]) for k in range(500, 800)]  # one very common vector
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (900, None), (901, []), (902, [None] * 20),
             (903, [float("nan")] * 20), (904, [float("inf")] + [0.0] * 19), (905, [0.1] * 19)]
    schema = "vec_id long, embedding array<float>, x string, v int, n int, component string"
    frame = spark.createDataFrame([(*r, "x", 1, 2, "c") for r in rows], schema).repartition(7)
    got = whiten(frame).collect()
    kept = [r for r in rows if r[0] != 905]  # the one of another length
    floats = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in kept]
    check(floats, got)


def test_no_variance_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    got = whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(got)] == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    assert whiten(spark.createDataFrame([], schema)).collect() == []
    line = whiten(spark.createDataFrame([(k, [float(k), 0.0, -float(k)]) for k in range(9)], schema)).collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True), (3, True)}
    assert {round(r.explained, 12) for r in line} == {0.0, 1.0}


def test_very_large_entries(spark):
    rows = [(k, [float(10 ** (k % 30)), float(k)]) for k in range(60)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 120 and any(r.deviation is None for r in got) and got[0].identity_error < 1e-6


def test_products_are_exact():
    rng = np.random.default_rng(3)
    for top in (3, 10 ** 6, 10 ** 12, 1 << 61):
        y = rng.integers(-top, top, (300, 5))
        plain_sums = y.astype(object).T @ y.astype(object)
        assert (exact_products(y) == plain_sums).all() and (exact_products(y.astype(object)) == plain_sums).all()


def test_extended_fractions():
    for f in (Fraction(1, 3), Fraction(-10 ** 30, 7), Fraction(5, 10 ** 25), Fraction(0), Fraction(1 << 70, 3)):
        high = float(f)
        rest = float(f - Fraction(high))
        assert abs(extended(f) - np.longdouble(high) - np.longdouble(rest)) <= abs(np.longdouble(high)) * np.longdouble(2) ** -62


@pytest.mark.parametrize("spectrum", [
    np.linspace(1, 5, 30),
    [1.0] * 6 + [2.0] * 6 + [3.0],
    [1, 1 + 1e-7, 1 + 2e-7, 1 + 1e-12, 4, 4 + 1e-9, 9, 100],
    [1e-9, 1e-6, 1e-3, 1, 1e3, 1e6],
    [0.0] * 5 + [1.0],
    [2.0] * 7,
])
def test_refinement_on_clusters(spectrum):
    """Residual and orthogonality at the precision of the extended format, clusters or not."""
    n = len(spectrum)
    rng = np.random.default_rng(n)
    q = rng.normal(size=(n, n)).astype(np.longdouble)
    for _ in range(3):  # Gram-Schmidt, repeated
        for k in range(n):
            for j in range(k):
                q[:, k] -= (q[:, j] @ q[:, k]) * q[:, j]
            q[:, k] /= np.sqrt(q[:, k] @ q[:, k])
    a = (q * np.array(spectrum, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    values, x = eigenvectors(a)
    top = max(spectrum)
    assert np.abs(x.T @ x - np.eye(n)).max() < 1e-17
    assert np.abs(a @ x - x * values).max() < 2e-17 * top
    assert np.abs(np.sort(np.array(spectrum, np.longdouble))[::-1] - values).max() < 1e-17 * top


def test_close_pair_is_told_apart():
    """Two eigenvalues 1e-9 apart: float32 and even float64 mix their vectors, the sub-solve does not."""
    angle = np.longdouble(0.3)
    c, s = np.cos(angle), np.sin(angle)
    q = np.eye(3, dtype=np.longdouble)
    q[:2, :2] = [[c, -s], [s, c]]
    a = (q * np.array([1, 1 + np.longdouble(1e-9), 5])) @ q.T
    _, x = eigenvectors((a + a.T) / 2)
    assert min(np.abs(x[:, 1] - q[:, 1]).max(), np.abs(x[:, 1] + q[:, 1]).max()) < 1e-8
    assert np.abs(np.abs(x[2, 0]) - 1) < 1e-18
