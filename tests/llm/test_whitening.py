from __future__ import annotations

import numpy as np
import pytest

from loomstat.llm import whitening

SCHEMA = "vec_id bigint, embedding array<double>, n string, component int"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, "s", 1) for i, v in rows], SCHEMA).repartition(parts)


def check(rows, result, components, tolerance=1e-6):
    """Against a plain eigen-decomposition of the exactly centred rows."""
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(v) for _, v in good)
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in [*v, *[0.0] * (width - len(v))]] for _, v in good], object)
    n, sums = len(x), x.sum(axis=0)
    off = n * x - sums
    real = (off / n).astype(float)
    singular, vectors = np.linalg.svd(real, full_matrices=False)[1:]
    values, vectors = singular ** 2 / n, vectors.T
    rank = int((singular > 1e-12 * singular[0]).sum())
    deviations = [s if s < 1 << 63 else None for s in ((o * o).sum() for o in off)]
    size = min(components, rank)
    assert len(result) == n * size
    by = {}
    for r in result:
        by.setdefault(r.component, []).append(r)
    for j in range(size):
        mine = sorted((r.vec_id is None, r.vec_id or 0, r.whitened) for r in by[j + 1])
        white = real @ vectors[:, j] / np.sqrt(values[j])
        ways = [
            sorted((i is None, i or 0, sign * w) for (i, _), w in zip(good, white)) for sign in (1, -1)
        ]
        assert any(
            [m[:2] for m in mine] == [w[:2] for w in way] and np.allclose([m[2] for m in mine], [w[2] for w in way], atol=tolerance) for way in ways
        )
        both = [[(i, d) for (i, _), d in zip(good, deviations)], [(r.vec_id, r.deviation) for r in by[j + 1]]]
        assert sorted(both[0], key=str) == sorted(both[1], key=str)
        assert by[j + 1][0].explained == pytest.approx(values[j] / values.sum(), rel=1e-5)
    assert {r.n for r in result} == {n}
    assert all(r.identity_error < 1e-6 for r in result)


def test_equals_plain_eigenvectors(spark):
    rnd = np.random.default_rng(1)
    rows = [(i, (rnd.normal(size=12) * np.arange(1, 13)).tolist()) for i in range(400)]
    result = whitening.whiten(table(spark, rows), components=8, offset=1_000_000)
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, result.collect(), 8)


def test_badly_conditioned(spark):
    rnd = np.random.default_rng(2)
    turn = np.linalg.qr(rnd.normal(size=(6, 6)))[0]
    rows = [(i, ((rnd.normal(size=6) * [1e7, 1e5, 1e3, 1e2, 30, 10]) @ turn).tolist()) for i in range(300)]
    check(rows, whitening.whiten(table(spark, rows), components=6, offset=1_000_000).collect(), 6, tolerance=1e-5)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0, 5.0]), (0, [1.0, 2.0, 5.0]), (1, [0.5, -2.0]), (None, [3.0, 1.0, 1.0]), (2, None), (3, [None, 1.0, 1.0]),
        (4, [float("nan"), 1.0, 1.0]), (5, [float("inf"), 1.0, 1.0]), (6, []), (7, [9.0, -4.0, 2.5]),
    ]
    check(rows, whitening.whiten(table(spark, rows), components=32, offset=1_000_000).collect(), 32)


def test_directions_without_variance(spark):
    rnd = np.random.default_rng(4)
    base = rnd.normal(size=(50, 3)) * 4
    rows = [(i, [*b, b[0], 7.0, 0.0]) for i, b in enumerate(base.tolist())]  # a repeated and two constant dimensions
    check(rows, whitening.whiten(table(spark, rows), components=32, offset=1_000_000).collect(), 32)
    rows = [(i, rnd.normal(size=9).tolist()) for i in range(4)]  # fewer rows than dimensions
    assert whitening.whiten(table(spark, rows), components=32).count() == 4 * 3


def test_no_components(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(9)]):
        assert whitening.whiten(table(spark, rows)).count() == 0


def test_deviation_beyond_doubles(spark):
    rows = [(i, [float(i * 2 ** 20), float(i % 3)]) for i in range(40)]
    check(rows, whitening.whiten(table(spark, rows), components=2, offset=1_000_000).collect(), 2)
    rows = [(i, [float(i) * 2 ** 30, 1.0]) for i in range(20)]
    assert whitening.whiten(table(spark, rows), components=1).filter("deviation IS NULL").count() > 0


def test_triangular_solve():
    rnd = np.random.default_rng(0)
    triangle = np.triu(rnd.normal(size=(7, 7))) + 4 * np.eye(7)
    rows = rnd.normal(size=(20, 7))
    assert np.allclose(whitening.solve_right(rows, triangle) @ triangle, rows)
