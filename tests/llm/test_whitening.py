"""Whitening (11): the solver against numpy, the operator against exact integers."""

from __future__ import annotations

from fractions import Fraction
from math import floor

import numpy as np
import pytest

from trackline.llm import op11_qd_whitening as op11
from trackline.llm.bidiagonal import bidiagonalised, dqds, principal

RNG = np.random.default_rng(5)


def turned(spread):
    q, _ = np.linalg.qr(RNG.standard_normal((len(spread), len(spread))))
    return np.diag(spread) @ q


MATRICES = {
    "random": RNG.standard_normal((300, 40)),
    "low rank": RNG.standard_normal((6, 40)),
    "equal columns": np.repeat(RNG.standard_normal((200, 10)), 3, axis=1),
    "equal eigenvalues": turned([3.0] * 5 + [1.0] * 20 + [0.5] * 5),
    "identity": np.eye(12) * 7,
    "close pairs": np.linalg.cholesky(np.diag([22.0 - 2 * abs(10 - k) + 12 for k in range(21)])
                                      + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)).T,
    "constant columns": np.hstack([RNG.standard_normal((50, 6)), np.zeros((50, 4))]),
    "one row": RNG.standard_normal((1, 9)),
    "one number": np.array([[4.0]]),
    "wide range": turned([10.0 ** -k for k in range(11)]),
}


@pytest.mark.parametrize("name", MATRICES)
def test_solver_equals_numpy(name):
    x = MATRICES[name]
    r = np.linalg.qr(x, mode="r")
    r = np.vstack([r, np.zeros((x.shape[1] - len(r), x.shape[1]))])
    expected = np.linalg.svd(r, compute_uv=False) ** 2
    values, vectors = principal(r, x.shape[1])
    real = int((expected > 1e-24 * expected[0]).sum())
    assert len(values) >= real and np.allclose(values[:real], expected[:real], rtol=1e-9, atol=1e-15 * expected[0])
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-11
    assert np.abs(x.T @ (x @ vectors.T) - vectors.T * values).max() < 1e-13 * expected[0]


def test_small_values_keep_their_digits():
    """dqds is accurate for every value, however small beside the largest: compare with exact fractions."""
    a, b = [1.0, 1e-6, 1e-9], [1e-3, 1e-7]
    least = dqds([x * x for x in a], [x * x for x in b])[-1]
    value, q, e = Fraction(least), [Fraction(x) ** 2 for x in a], [Fraction(x) ** 2 for x in b]

    def determinant(t):
        one, two = Fraction(1), q[0] - t
        for k in range(1, 3):
            one, two = two, (q[k] + e[k - 1] - t) * two - q[k - 1] * e[k - 1] * one
        return two

    assert determinant(value * (1 - Fraction(1, 10 ** 12))) * determinant(value * (1 + Fraction(1, 10 ** 12))) < 0
    assert principal(np.zeros((3, 3)), 2)[0].size == 0
    d, e, p = bidiagonalised(MATRICES["random"][:40])
    assert np.abs(p @ p.T - np.eye(40)).max() < 1e-13


def brute(rows, components=8):
    """{id: (deviation, whitened)}, explained and n by exact sums and numpy's solver for symmetric matrices."""
    x = [(i, [floor(1024 * Fraction(float(c))) + 100_000 for c in v]) for i, v in rows]
    n, dims = len(x), len(x[0][1])
    sums = [sum(v[k] for _, v in x) for k in range(dims)]
    apart = [[n * v[k] - sums[k] for k in range(dims)] for _, v in x]
    product = [[sum(r[j] * r[k] for r in apart) for k in range(dims)] for j in range(dims)]
    covariance = np.array([[float(Fraction(c, n ** 3)) for c in row] for row in product])
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    centred = np.array([[float(Fraction(c, n)) for c in row] for row in apart])
    return ([sum(c * c for c in row) for row in apart], centred @ vectors / np.sqrt(values),
            values / float(sum(Fraction(product[k][k], n ** 3) for k in range(dims))))


def test_query_equals_exact_sums(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").limit(120)
    rows = spark.createDataFrame(rows.collect(), rows.schema).repartition(7)
    given = [(r.vec_id, r.embedding) for r in rows.orderBy("vec_id").collect()]
    deviation, whitened, explained = brute(given)
    place = {i: k for k, (i, _) in enumerate(given)}
    found = op11.whiten(rows).collect()
    assert len(found) == 8 * len(given)
    sign = {}
    for row in found:
        k, c = place[row.vec_id], row.component - 1
        assert row.n == len(given) and int(row.deviation) == deviation[k] and row.identity_error < 1e-9
        assert row.explained == pytest.approx(explained[c], rel=1e-9)
        sign.setdefault(c, np.sign(row.whitened) * np.sign(whitened[k, c]))
        assert row.whitened * sign[c] == pytest.approx(whitened[k, c], abs=1e-8)


def test_registered_query(spark, sf_dir):
    found = op11.op11_qd_whitening(spark, sf_dir)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [
        ("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
        ("explained", "double"), ("identity_error", "double")]
    spread = found.groupBy("component").agg({"whitened": "var_pop"}).collect()
    assert len(spread) == 8 and all(abs(row[1] - 1) < 1e-9 for row in spread)


def frame(spark, rows):
    data = spark.createDataFrame([(i, v, "given", 1) for i, v in rows],
                                 "vec_id long, embedding array<double>, n string, component int")
    return data.selectExpr("*", "'x' AS id", "'y' AS _vector")


def test_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(1, [0.5, 0.25]), (2, [0.125, -0.25]), (None, [0.5, 1.0]), (2, [0.125, -0.25]), (4, None), (5, [1.0, None]),
            (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, -inf]), (9, []), (10, [1.0, 2.0, 3.0])]
    found = op11.whiten(frame(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.component, r.n) for r in found) == sorted(
        (i, c, 4) for i in (0, 1, 2, 2) for c in (1, 2))
    assert {r.identity_error < 1e-9 for r in found} == {True}
    assert op11.whiten(frame(spark, [])).count() == 0
    assert op11.whiten(frame(spark, [(4, None), (9, [])])).count() == 0
    assert op11.whiten(frame(spark, [(1, [0.5, 0.25])] * 3)).count() == 0  # nothing spreads
    line = op11.whiten(frame(spark, [(k, [k / 8, k / 4, 1.0]) for k in range(5)])).collect()
    assert {r.component for r in line} == {1} and line[0].explained == pytest.approx(1)


def test_large_numbers_stay_exact(spark):
    rows = [(k, [float(2 ** 29 * k), 1e300 if k == 3 else 0.5]) for k in range(4)]
    found = {r.vec_id: int(r.deviation) for r in op11.whiten(frame(spark, rows)).collect()}
    x = [[min(2 ** 39 * k, 2 ** 40) + 100_000, (2 ** 40 if k == 3 else 512) + 100_000] for k in range(4)]
    sums = [sum(v[d] for v in x) for d in range(2)]
    assert found == {k: sum((4 * v[d] - sums[d]) ** 2 for d in range(2)) for k, v in enumerate(x)}
    assert max(found.values()) > 2 ** 63
    with pytest.raises(ValueError):
        op11.whiten(frame(spark, [(1, [0.0] * 2_100)]))
