"""Whitening against numpy and against exact integer arithmetic."""
import math
from fractions import Fraction

import numpy as np
import pytest

from tessera.llm import whitening as W


def plain_polynomial(a):
    """det(t - a) by Faddeev and LeVerrier, in fractions."""
    d = len(a)
    m, c = [[Fraction(0)] * d for _ in range(d)], [Fraction(0)] * d + [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(Fraction(int(a[i][l])) * m[l][j] for l in range(d)) + (c[d - k + 1] if i == j else 0) for j in range(d)] for i in range(d)]
        am = [sum(Fraction(int(a[i][l])) * m[l][i] for l in range(d)) for i in range(d)]
        c[d - k] = -sum(am) / k
    return [int(v) for v in c]


def gram(rng, n, d, top=50):
    x = rng.integers(-top, top, (n, d)).astype(object)
    return x.T @ x


@pytest.mark.parametrize("case", ["random", "zero rows", "blocks", "rank", "big"])
def test_polynomial(spark, case):
    rng = np.random.default_rng(len(case))
    a = gram(rng, 9, 6, 10 ** 7 if case == "big" else 50)
    if case == "zero rows":
        a[2, :] = a[:, 2] = 0
    if case == "blocks":
        a[:3, 3:] = a[3:, :3] = 0
    if case == "rank":
        a = gram(rng, 3, 6)
    assert W.characteristic(spark, a) == plain_polynomial(a)


def times(*polys):
    out = [1]
    for p in polys:
        new = [0] * (len(out) + len(p) - 1)
        for i, x in enumerate(out):
            for j, y in enumerate(p):
                new[i + j] += x * y
        out = new
    return out


def test_roots_with_multiplicity():
    poly = times(*[[-r, 1] for r in (0, 0, 3, 7, 7, 10 ** 12, 10 ** 12 + 1)])
    found = W.largest_roots(poly, 9)
    assert [(round(float(r), 6), m) for r, m in found] == [(1e12 + 1, 1), (1e12, 1), (7.0, 2), (3.0, 1)]
    assert all(abs(r - e) <= Fraction(e, 1 << (W.DIGITS - 1)) for (r, _), e in zip(found, (10 ** 12 + 1, 10 ** 12, 7, 3)))
    assert W.largest_roots(poly, 1) == found[:1] and W.largest_roots([0, 0, 1], 4) == []
    two = W.largest_roots(times([1, -3, 1], [-5, 1]), 3)  # (3 +- sqrt 5) / 2 and 5
    assert [float(r) for r, _ in two] == pytest.approx([5, (3 + math.sqrt(5)) / 2, (3 - math.sqrt(5)) / 2], rel=1e-15)


def test_null_vectors():
    rng = np.random.default_rng(7)
    a = gram(rng, 20, 8)
    values, vectors = np.linalg.eigh(a.astype(float))
    poly = plain_polynomial(a)
    for k, (root, count) in enumerate(W.largest_roots(poly, 8)):
        v = np.array(W.null_vectors(a, root, count)[0])
        assert float(root) == pytest.approx(values[7 - k], rel=1e-12)
        assert abs(v @ vectors[:, 7 - k]) == pytest.approx(1, abs=1e-12)
    b = np.diag([5, 5, 5, 1]).astype(object)
    basis = np.array(W.null_vectors(b, Fraction(5), 3))
    assert np.allclose(basis @ basis.T, np.eye(3), atol=1e-15) and np.allclose(basis[:, 3], 0, atol=1e-30)


def brute(rows, components=4):
    """Expected output by numpy, by id."""
    kept = [(i, [math.floor(float(c) * 256) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), object)
    n, sums = len(fit), fit.sum(0)
    centred = (fit * n - sums).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    out = {}
    for i, x in kept:
        delta = np.array(x, object) * n - sums
        out.setdefault(i, []).append((n, int((delta * delta).sum()), (delta.astype(float) / n) @ vectors[:, order] / np.sqrt(values[order])))
    return out, values[order] / values.sum()


def compare(got, rows):
    want, shares = brute(rows)
    by_component = {}
    for r in got:
        by_component.setdefault(r.component, {}).setdefault(r[0], []).append(r)
    assert sorted(by_component) == [1, 2, 3, 4]
    for k, own in by_component.items():
        assert set(own) == set(want) and all(len(own[i]) == len(want[i]) for i in want)
        pairs = [(a, b) for i in want for a, b in zip(sorted(own[i], key=lambda r: r.deviation), sorted(want[i], key=lambda r: r[1]))]
        assert all((a.n, a.deviation) == b[:2] for a, b in pairs)
        x, y = np.array([a.whitened for a, _ in pairs]), np.array([b[2][k - 1] for _, b in pairs])
        assert np.allclose(x, y, atol=1e-9) or np.allclose(x, -y, atol=1e-9)
        assert all(a.explained == pytest.approx(shares[k - 1], rel=1e-9) and a.identity_error < 1e-9 for a, _ in pairs)


def test_query_against_numpy(spark):
    from tests.llm.conftest import SF
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(W.q_whitening(spark, SF).collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(k, [float(c) for c in rng.normal(size=6)]) for k in range(40)]
    rows += [(1, rows[1][1]), (90, rows[2][1]), (91, rows[2][1]), (None, rows[3][1])]
    rows += [(92, None), (93, [0.0, None] + [0.0] * 4), (94, [float("nan")] + [0.0] * 5), (95, [0.0] * 5 + [float("-inf")])]
    frame = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<double>, component int, x string")
    compare(W.whiten(frame).collect(), rows)


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 3, [[]], [[0.001, 0.002], [0.003, 0.001]]])
def test_no_spread(spark, vectors):
    frame = spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    assert W.whiten(frame).count() == 0


def test_lower_rank_unequal_lengths_and_large_values(spark):
    frame = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0]), (3, [5.0, 0.0])], "vec_id long, embedding array<double>")
    got = W.whiten(frame).collect()
    assert sorted({r.component for r in got}) == [1, 2] and sum(r.explained for r in got) / 3 == pytest.approx(1)
    assert all(r.identity_error < 1e-12 for r in got)
    large = [(k, [3e12 * k * k, 1e12 * k]) for k in range(5)]
    out = W.whiten(spark.createDataFrame(large, "vec_id long, embedding array<double>")).collect()
    assert len(out) == 10 and all(r.deviation is None for r in out) and max(r.identity_error for r in out) < 1e-9
    huge = W.whiten(spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert [r.component for r in huge] == [1, 1, 1]


def test_equal_eigenvalues(spark):
    rows = [(2 * k + s, [float(v) for v in (1 - 2 * s) * np.eye(5)[k]]) for k in range(5) for s in (0, 1)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 40 and got[0].identity_error < 1e-12 and {round(r.explained, 12) for r in got} == {0.2}
