import math
from fractions import Fraction

import numpy as np
import pytest

from subpanel.llm import whitening

from ..conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int, component int, n string, w string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "n", "w") for i, v in rows], SCHEMA)


def whole(rows):
    """x, n-times-centred deviations and covariance, stated plainly."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for _, v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    centred = n * x - sums
    return x, n, (centred ** 2).sum(axis=1), centred.astype(float) / n


def check(got, rows, k=8, tol=1e-8):
    x, n, deviation, centred = whole(rows)
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    k = min(k, int((e > 1e-9 * e[0]).sum()))
    table = {}
    for r in got:
        table.setdefault(r["component"], []).append(r)
    assert sorted(table) == list(range(1, k + 1))
    for c, part in table.items():
        part = sorted(part, key=lambda r: r["vec_id"])
        assert [r["vec_id"] for r in part] == sorted(i for i, _ in rows)
        order = np.argsort([i for i, _ in rows], kind="stable")
        assert [r["deviation"] for r in part] == [int(deviation[i]) for i in order]
        assert {r["n"] for r in part} == {n}
        assert math.isclose(part[0]["explained"], e[c - 1] / e.sum(), rel_tol=1e-9)
        w = np.array([r["whitened"] for r in part])
        want = (centred @ u[:, c - 1] / math.sqrt(e[c - 1]))[order]
        assert min(np.abs(w - want).max(), np.abs(w + want).max()) < tol
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-8


def test_against_numpy_on_the_given_vectors(spark):
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    check(whitening.whiten(vectors.repartition(5)).collect(), rows, tol=1e-7)


def test_large_entries_and_rank_below_components(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 3)) * [1e6, 1e5, 1e4]
    rows = [(i, [*map(float, b), 7.0]) for i, b in enumerate(base)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r["component"] for r in got} == {1, 2, 3}
    x, n, deviation, centred = whole(rows)
    shown = {r["vec_id"]: r["deviation"] for r in got}
    assert all(shown[i] == (int(v) if v < 1 << 63 else None) for i, v in enumerate(deviation))
    assert got[0]["identity_error"] < 1e-8


def test_equal_eigenvalues_give_orthonormal_components(spark):
    rows = [(2 * i + s, [2.0 * (1 - 2 * s) if j == i else 0.0 for j in range(4)]) for i in range(4) for s in (0, 1)]
    got = whitening.whiten(frame(spark, rows), count=3).collect()
    assert {r["component"] for r in got} == {1, 2, 3}
    assert all(math.isclose(r["explained"], 0.25) for r in got) and got[0]["identity_error"] < 1e-12


@pytest.mark.parametrize("d", [1, 2, 3, 7])
def test_polynomial_is_exact(spark, d):
    rng = np.random.default_rng(d)
    a = rng.integers(-10**6, 10**6, (d, d + 1)).astype(object)
    matrix = (a @ a.T).tolist()
    poly = whitening.characteristic_polynomial(spark, matrix)
    assert poly[-1] == 1 and poly[-2] == -sum(matrix[i][i] for i in range(d))
    for t in (-3, 0, 5, 10**9):     # exact determinants by fractions at d + 1 and more places
        m = [[Fraction((t if i == j else 0) - matrix[i][j]) for j in range(d)] for i in range(d)]
        det = Fraction(1)
        for k in range(d):
            pivot = next((i for i in range(k, d) if m[i][k]), None)
            if pivot is None:
                det = Fraction(0)
                break
            if pivot != k:
                m[k], m[pivot], det = m[pivot], m[k], -det
            det *= m[k][k]
            for i in range(k + 1, d):
                f = m[i][k] / m[k][k]
                m[i] = [x - f * y for x, y in zip(m[i], m[k], strict=True)]
        assert sum(c * t ** i for i, c in enumerate(poly)) == det


def test_roots_are_isolated():
    poly = np.array([1], dtype=object)
    for root in (0, 0, 3, 10**12, 10**12 + 1, 5 * 10**15, 5 * 10**15):
        poly = np.append([0], poly) - np.append(poly * root, [0])
    found = whitening.largest_roots([int(c) for c in poly], 7)
    assert [m for *_, m in found] == [2, 1, 1, 1]
    for (a, s, _), want in zip(found, (5 * 10**15, 10**12 + 1, 10**12, 3), strict=True):
        assert abs(Fraction(a, 1 << s) - want) < Fraction(want, 10**50)


def test_close_eigenvalues_to_double_precision():
    # [[2, eps], [eps, 2]] has eigenvectors (1, 1) and (1, -1), however small eps is
    big = 10**20
    matrix = [[2 * big, 1], [1, 2 * big]]
    poly = [4 * big * big - 1, -4 * big, 1]
    for (a, s, m), sign in zip(whitening.largest_roots(poly, 2), (1, -1), strict=True):
        v = whitening.null_vectors(np.array(matrix, dtype=object), a, s, m)[0]
        assert abs(abs(v[0]) - math.sqrt(0.5)) < 1e-15 and abs(v[0] - sign * v[1]) < 1e-15


def test_messy_and_empty(spark):
    good = [(i, [float(i % 5), float(i * i % 7), 1.0 * (i % 3)]) for i in range(30)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 0.0, 0.0]),
           (104, []), (105, [1.0]), (106, [1e300, 0.0, 0.0])]
    got = whitening.whiten(frame(spark, good + bad)).collect()
    check(got, good)
    repeated = good + good[:3] + [(None, [9.0, 9.0, 9.0])]
    got = whitening.whiten(frame(spark, repeated)).collect()
    assert len(got) == 3 * len(repeated) and sum(r["vec_id"] is None for r in got) == 3
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0])] * 3)).count() == 0
    assert whitening.whiten(frame(spark, good[:1])).count() == 0
    assert whitening.whiten(frame(spark, bad[:1])).count() == 0
    assert whitening.whiten(frame(spark, good).limit(0)).columns == [
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
