"""Nearest centroids by blocks: any number of classes, the same labels as all distances give."""

from __future__ import annotations

import numpy as np
import pytest

from loomstat.operators import scoring


def brute(rows):
    labels = sorted({label for _, _, label in rows})
    centres = np.array([np.mean([v for _, v, other in rows if other == label], axis=0) for label in labels])
    x = np.array([v for _, v, _ in rows])
    return {i: labels[((c := (centres - v))**2).sum(axis=1).argmin()] for (i, v, _), v in zip(rows, x)}


@pytest.mark.parametrize("spread", [0.0, 3.0])
def test_blocks_equal_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(scoring, "CELLS", 2)
    rnd = np.random.default_rng(7)
    centres = rnd.normal(size=(60, 5)) * (1 + spread * rnd.random((60, 1)))
    rows = [(i, (centres[i % 60] + 0.3 * rnd.normal(size=5)).tolist(), 100 + i % 60) for i in range(600)]
    table = spark.createDataFrame([(*r, "kept") for r in rows], "id bigint, embedding array<double>, label int, other string").repartition(3)
    found = scoring.score_batch(table, most=10, block=16)
    assert found.columns == [*table.columns, "prediction"]
    assert {r.id: r.prediction for r in found.collect()} == brute(rows)
    assert {r.id: r.prediction for r in scoring.score_batch(table).collect()} == brute(rows)


def test_far_blocks_are_not_asked(spark, monkeypatch):
    """Classes on shells of different norms: a row's block meets its own shell and at most its neighbours."""
    asked, met = [], scoring._met
    monkeypatch.setattr(scoring, "_met", lambda rows, *a: asked.append(scoring.durable(rows, "asked")) or met(asked[-1], *a))
    rnd = np.random.default_rng(3)
    rows = []
    for i in range(800):
        shell = i % 80
        way = np.random.default_rng(shell).normal(size=4)
        rows.append((i, (way / np.linalg.norm(way) * 10 * (1 + shell // 8) + 0.01 * rnd.normal(size=4)).tolist(), shell))
    table = spark.createDataFrame(rows, "id bigint, embedding array<double>, label int")
    found = scoring.score_batch(table, most=5, block=8)
    assert {r.id: r.prediction for r in found.collect()} == brute(rows)
    blocks = asked[0].count()
    assert sum(a.count() for a in asked) < 4 * blocks  # of ten blocks of centroids for each block of rows


def test_ties_go_to_the_smaller_label(spark):
    rows = [(i, [float(i % 2)], 50 - i % 4) for i in range(40)]
    table = spark.createDataFrame(rows, "id bigint, embedding array<double>, label int")
    assert {r.prediction for r in scoring.score_batch(table, most=2, block=1).collect()} == {47, 48} == set(brute(rows).values())


def test_blocks_of_rows_are_sent_once_per_pack(spark, monkeypatch):
    """Not once per block of centroids: the bytes moved would grow with the product of both sides."""
    answers, met = [], scoring._met
    monkeypatch.setattr(scoring, "_met", lambda *a: answers.append(scoring.durable(met(*a), "answers")) or answers[-1])
    rnd = np.random.default_rng(5)
    rows = [(i, rnd.normal(size=6).tolist(), i // 2) for i in range(400)]
    table = spark.createDataFrame(rows, "id bigint, embedding array<double>, label int")
    for pack, packs in ((1 << 20, 1), (3 * 8 * 6 * 8, 9)):  # all centroids in one pack; three blocks of eight in a pack
        monkeypatch.setattr(scoring, "PACK_BYTES", pack)
        answers.clear()
        assert {r.id: r.prediction for r in scoring.score_batch(table, most=10, block=8).collect()} == brute(rows)
        per_block = answers[1].groupBy("id").count().agg({"count": "max"}).first()[0]
        assert 1 <= per_block <= packs < 200 / 8


def test_packs_are_sent_to_few_salts():
    """Each salt of the rows gets all packs: many small blocks must not make many salts once there are enough groups."""
    blocks, block_bytes = 2400, 256 * 64 * 8
    assert scoring._spread(blocks, blocks * block_bytes, 10, 12) == 10  # 38 by blocks alone
    assert scoring._spread(blocks, blocks * block_bytes, 1, 12) == 12  # as many groups as tasks
    assert scoring._spread(3, 3 * block_bytes, 1, 200) == 1
