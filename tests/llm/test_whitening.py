"""Whitening against eigenvectors of the covariance, formed exactly."""

import math
from fractions import Fraction

import numpy as np
import pytest

from pointset.llm import queries, whitening
from pointset.llm.whitening import bidiagonalise, directions, dqds, triangle, whiten

SHAPE = "vec_id long, embedding array<double>, label int, v string, part string, dim string"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def integers(v):
    return [math.floor(64 * float(c)) + 1_000_000 for c in v]


def check(found, given, components=32):
    """``found`` rows of one fit against the covariance of the ``given`` vectors."""
    x = {i: integers(v) for i, v in given}
    n, d = len(given), len(given[0][1])
    sums = [sum(integers(v)[j] for _, v in given) for j in range(d)]
    gaps = np.array([[n * c - s for c, s in zip(integers(v), sums)] for _, v in given], dtype=object)
    exact = gaps.T.dot(gaps)
    covariance = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in exact])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(components, d)
    assert len(found) == n * k
    for j in range(k):
        rows = {r.vec_id: r for r in found if r.component == j + 1}
        truth = {i: (np.array(x[i], float) - np.array(sums, float) / n) @ vectors[:, j] / math.sqrt(values[j]) for i in x}
        sign = math.copysign(1, sum(rows[i].whitened * truth[i] for i in x))
        gap = min(abs(values[j] - values[i]) for i in range(d) if i != j) / values[0] if d > 1 else 1
        for i in x:
            assert rows[i].n == n
            assert rows[i].deviation == sum((n * c - s) ** 2 for c, s in zip(x[i], sums))
            assert abs(rows[i].whitened * sign - truth[i]) < 1e-6 + 1e-11 / gap
            assert abs(rows[i].explained / (values[j] / values.sum()) - 1) < 1e-9
            assert rows[i].identity_error < 1e-9


def rows_of(result):
    return [r for r in result.select(*COLUMNS).collect()]


def test_the_query(spark):
    d = "/root/testdata/sf0.001"
    given = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    check(rows_of(queries.op12_whitening(spark, d)), given)


@pytest.mark.parametrize("merged, cells", [(32, 1 << 20), (2, 50)])
def test_tasks_and_blocks(spark, monkeypatch, merged, cells):
    monkeypatch.setattr(whitening, "MERGED", merged)
    monkeypatch.setattr(whitening, "BLOCK_CELLS", cells)
    rng = np.random.default_rng(1)
    given = [(i, (rng.normal(size=5) * [9, 4, 2, 1, 0.5]).tolist()) for i in range(200)]
    table = spark.createDataFrame([(*g, 1, "a", "b", "c") for g in given], SHAPE).repartition(9)
    check(rows_of(whiten(table)), given)
    check(rows_of(whiten(table, components=2)), given, 2)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FIT_CELLS", 10)
    rng = np.random.default_rng(2)
    threes = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    twos = [(100 + i, rng.normal(size=2).tolist()) for i in range(40)]
    bad = [
        (200, None), (201, []), (202, [1.0, None, 2.0]), (203, [1.0, float("nan"), 2.0]), (204, [float("inf"), 0.0, 1.0]),
        (205, [1e300, 0.0, 1.0]),
    ]
    alone = [(300, [5.0] * 7)]
    table = spark.createDataFrame([(*g, None, "a", "b", "c") for g in [*threes, *twos, *bad, *alone]], SHAPE)
    found = rows_of(whiten(table))
    check([r for r in found if r.vec_id < 100], threes)
    check([r for r in found if 100 <= r.vec_id < 200], twos)
    rest = [r for r in found if r.vec_id >= 200]
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rest] == [(300, 1, 0, None, None, None)] * 7
    # repeated rows, a null id and dependent entries
    table = spark.createDataFrame([(None, [1.0, 2.0, 0.0], 1, "", "", "")] * 2 + [(1, [3.0, 6.0, 0.0], 1, "", "", "")] * 2, SHAPE)
    found = sorted(rows_of(whiten(table)), key=lambda r: r.component)
    assert [r.vec_id for r in found].count(None) == 6
    assert {round(abs(r.whitened), 9) for r in found[:4]} == {1.0} and abs(found[0].explained - 1) < 1e-12
    assert {(r.whitened, r.explained) for r in found[4:]} == {(None, 0.0)}
    assert rows_of(whiten(table.where("false"))) == []


def test_deviation_is_exact_or_null():
    gaps = np.array([[3_000_000_000, 1], [2_000_000_000, 500_000_001], [4_000_000_000, 0]])
    assert whitening.squares(gaps).to_pylist() == [9 * 10**18 + 1, 4 * 10**18 + 500_000_001**2, None]


@pytest.mark.parametrize("kind", ["random", "equal", "groups", "graded", "wide", "split", "one"])
def test_solver(kind):
    rng = np.random.default_rng(3)
    n, d = (300, 24) if kind != "wide" else (10, 24)
    a = rng.normal(size=(n, d))
    left, right = np.linalg.qr(rng.normal(size=(n, d)))[0], np.linalg.qr(rng.normal(size=(d, d)))[0]
    if kind == "equal":
        a = left @ right
    elif kind == "groups":
        a = left @ np.diag([7.0] * 4 + [2.0 + 1e-13] * 3 + [2.0] * 3 + [1.0] * (d - 10)) @ right
    elif kind == "graded":
        a = a * np.logspace(0, -7, d)
    elif kind == "split":
        a = np.vstack([np.diag(np.arange(1.0, d + 1)), np.zeros((3, d))])
    elif kind == "one":
        a = a[:, :1]
    r = triangle(a)
    diagonal, beside, w = bidiagonalise(r if len(r) == r.shape[1] else np.vstack([r, np.zeros((r.shape[1] - len(r), r.shape[1]))]))
    assert np.abs(w @ w.T - np.eye(len(w))).max() < 1e-13
    truth = np.linalg.svd(a, compute_uv=False) ** 2
    values, found, total = directions(r, 32)
    some = min(len(truth), len(values))
    assert np.allclose(values[:some], truth[:some], rtol=1e-13 if kind != "graded" else 1e-8, atol=1e-28)
    assert math.isclose(total, truth.sum(), rel_tol=1e-13)
    live = values > 0
    assert np.abs(found[live] @ found[live].T - np.eye(live.sum())).max() < 1e-11
    for value, z in zip(values[live], found[live]):
        assert np.abs(a.T @ (a @ z) - value * z).max() < 1e-12 * values[0]


def test_small_singular_values_keep_their_digits():
    """Of a bidiagonal matrix graded over 40 orders, where other methods lose all digits."""
    diagonal, beside = np.logspace(0, -20, 9), 0.5 * np.logspace(0, -20, 9)[1:]
    exact = [[Fraction(0)] * 9 for _ in range(9)]
    for i in range(9):
        exact[i][i] = Fraction(float(diagonal[i]))
        if i < 8:
            exact[i][i + 1] = Fraction(float(beside[i]))
    gram = [[sum(exact[k][i] * exact[k][j] for k in range(9)) for j in range(9)] for i in range(9)]

    def below(value):
        """Number of eigenvalues below ``value``, from the signs of exact pivots."""
        pivot, count = None, 0
        for i in range(9):
            pivot = gram[i][i] - value - (gram[i][i - 1] ** 2 / pivot if i else 0)
            count += pivot < 0
        return count

    for place, value in enumerate(dqds(diagonal, beside)):
        near = Fraction(float(value))
        assert below(near * (1 + Fraction(1, 10**12))) == 9 - place and below(near * (1 - Fraction(1, 10**12))) == 8 - place
