from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.llm import topk
from loomstat.llm.vectors import integer_rows

SCHEMA = "vec_id bigint, embedding array<double>, score string, rank int"


def brute(rows, k, divisor, scale=256):
    good = [(i, [math.floor(scale * c) for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (query, x) in enumerate(good):
        if query is None or query % divisor:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y)), i is None, i or 0, i) for other, (i, y) in enumerate(good) if other != at]
        out += [(query, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def found(spark, rows, k=5, divisor=50, parts=3, **sizes):
    table = spark.createDataFrame([(i, v, "s", 1) for i, v in rows], SCHEMA).repartition(parts)
    result = topk.top_k(table, F.col("vec_id") % divisor == 0, k=k, **sizes)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in result.collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"cell": 40, "pack": 3}])
def test_equals_all_pairs(spark, sizes):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(6, 20))
    rows = [(i, (centres[i % 6] + 0.2 * rnd.normal(size=20)).tolist()) for i in range(240)]
    assert found(spark, rows, divisor=7, **sizes) == brute(rows, 5, 7)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0, 3.0]), (0, [1.0, 2.0, 3.0]), (50, [0.5, -2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 3.0]),
        (None, [1.0, 2.0, 3.0]), (None, None), (3, None), (4, [1.0, None, 1.0]), (5, [1.0, float("nan"), 1.0]),
        (6, [float("inf")] * 3), (100, []), (7, [1.0]), (8, [1.0, 2.0, 3.0, 4.0]), (-50, [1e-3] * 3),
    ]
    for k in (1, 3, 20):
        assert found(spark, rows, k=k) == brute(rows, k, 50)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0] * 40) for i in range(300)]
    result = found(spark, rows, k=4, divisor=50, cell=64, pack=2)
    assert [r[2] for r in result if r[0] == 0] == [1, 2, 3, 4]
    assert [r[2] for r in result if r[0] == 50] == [0, 1, 2, 3]


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [float(2 ** 22 + i), 1.0 / 256]) for i in range(60)]
    assert found(spark, rows) == brute(rows, 5, 50)
    assert found(spark, [(0, [2.0 ** 60] * 2), (1, [2.0 ** 60] * 2)])[0][3] == (1 << 63) - 1


def test_empty_and_single(spark):
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_bounds_hold_and_prune():
    rnd = np.random.default_rng(5)
    _, matrix = integer_rows(__import__("pyarrow").array((np.repeat(rnd.normal(size=(300, 8)), 8, axis=1)).tolist()), 256.0)
    both = topk.Vectors(matrix)
    exact = matrix @ matrix.T
    for level in both.levels:
        assert np.all(level @ level.T >= exact - 1e-3)
    asked, floor = np.arange(4), np.full(300, np.sort(exact[:4], axis=1)[:, -6].min(), float)
    pairs = [(a, b) for a, b, _ in topk._survivors(both, both, asked, floor)]
    kept = sum(len(a) for a, _ in pairs)
    assert kept == (exact[:4] >= floor[0]).sum() < 0.2 * 4 * 300
