from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomstat.llm import quality
from loomstat.llm.labelled import fold_of, labelled_sample
from loomstat.llm.queries import op9_quality_classifier

SF_DIR = "/root/testdata/sf0.001"


def corpus(spark, n=600):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice("abcdeot") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(20, 80))]
        good = rnd.random() < 0.7
        rows.append((i, " ".join(words if good else [w + rnd.choice(["%%%", "###"]) for w in words]), "s"))
        labels.append((i, int(good)))
    rows += [(n, None, "s"), (n + 1, "", "s"), (n + 2, "x" * 200_000, None), rows[0], (None, "null id", "s")]
    labels += [(None, 0), (n + 5, None), labels[0], labels[1]]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score string").repartition(3)
    return docs, spark.createDataFrame(labels, "doc_id bigint, quality int"), labels


def test_learns_and_filters(spark):
    docs, labels, truth = corpus(spark)
    model = quality.fit_documents(docs, labels)
    scored = docs.select("doc_id", model.column("text").alias("s")).collect()
    assert all(0 <= r.s <= 1 for r in scored)
    known = dict(t for t in truth if None not in t)
    held = [(r.s >= 0.3, known[r.doc_id]) for r in scored if r.doc_id in known and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([a == bool(b) for a, b in held]) > 0.97
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.s >= 0.3 for r in scored)


def test_equations_match_one_pass(spark):
    """The summed normal equations give the weights of a direct solution over all rows."""
    docs, labels, _ = corpus(spark, 200)
    sample = labelled_sample(docs, labels, "quality")
    model = quality.fit(sample)
    rows = sample.collect()
    stats = np.array([quality.statistics(r.text.encode()) for r in rows])
    assert np.allclose(model.mean, stats.mean(axis=0))
    own = [r.fold != 4 for r in rows]
    x, y = model.features(stats[own]), np.array([r.label for r in rows])[own]
    direct = np.linalg.solve(x.T @ x + quality.RIDGE * np.eye(x.shape[1]), x.T @ y)
    assert np.allclose(model.features(stats) @ direct, model.raw(stats), atol=1e-6)


def test_sample_leaves_out_the_held_out_fold(spark):
    docs, labels, truth = corpus(spark, 300)
    assert {r.fold for r in labelled_sample(docs, labels, "quality").collect()} == {1, 2, 3, 4}
    assert 30 < labelled_sample(docs, labels, "quality", fit_rows=80).count() < 150
    ids = spark.createDataFrame([(None,), (5,), (-7,)], "doc_id bigint").select("doc_id", fold_of("doc_id").alias("f"))
    for r in ids.collect():
        assert r.f == zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 5


def test_pooling():
    out = quality.pooled(np.array([1, 1, 2, 1]), np.array([0, 1, 0, 1]))
    assert out == pytest.approx([0, 1 / 3, 1 / 3, 1])


def test_without_labels_or_documents(spark):
    docs, labels, _ = corpus(spark, 20)
    model = quality.fit_documents(docs, labels.filter("false"))
    assert {round(r.s, 1) for r in docs.select(model.column("text").alias("s")).collect()} <= {0.5}
    ones = quality.fit_documents(docs, labels.filter("quality = 1"))
    assert docs.select(F.min(ones.column("text"))).first()[0] > 0.9
    assert quality.keep_good(docs.filter("false"), model).collect() == []


def test_query(spark):
    out = op9_quality_classifier(spark, SF_DIR)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    assert out.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
