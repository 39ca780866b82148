"""Each learner beats the largest class on texts whose class can be learned."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from loomstat.functions.text import clean_text
from loomstat.operators import models as L
from loomstat.operators import rows as R
from loomstat.operators.metrics import classification_metrics
from loomstat.session import durable


@pytest.fixture(scope="module")
def parts(spark):
    """Documents by language, which their words tell; a fifth is held out."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), clean_text(F.col("text")).alias("clean_text"), F.col("lang").alias("Sentiment"))
    rows = durable(rows.filter("clean_text <> ''").withColumn("place", R.seeded_hash(F.col("id"))), "learners")
    cut = int(0.8 * (1 << 60))
    return rows.filter(F.col("place") < cut).drop("place"), rows.filter(F.col("place") >= cut).drop("place")


@pytest.mark.parametrize("name", [*L.CLASSIFIERS, "constant"])
def test_beats_the_largest_class(spark, parts, name):
    train, held = parts
    largest = train.groupBy("Sentiment").count().orderBy(F.desc("count")).first()["Sentiment"]
    share = held.filter(F.col("Sentiment") == largest).count() / held.count()
    if name == "constant":  # the test can fail
        assert share < 0.7
        return
    make = L.CLASSIFIERS[name]
    model = L.train(train, make(20) if name == "Random Forest" else make(max_iter=40) if "SVM" in name else make())
    found = classification_metrics(model.transform(held).select("label", "prediction")).first()
    assert found["accuracy"] > share + 0.05


def test_vectors_are_stored_without_names_of_features(spark):
    """The names of all features would travel with every task of every pass; the vectors stay the same."""
    rows = spark.createDataFrame([(f"good film number {i % 4}", "a" if i % 3 else "b") for i in range(24)], "clean_text string, Sentiment string")
    features = L.TextFeatures(buckets=50)
    model, vectors = L.featurize(rows, features)
    assert vectors.schema["features"].metadata == {"ml_attr": {"num_attrs": 100}}
    assert vectors.schema["label"].metadata["ml_attr"]["vals"] == ["a", "b", "__unknown"]
    assert "Project" not in vectors._jdf.queryExecution().analyzed().toString()
    assert sorted(map(str, vectors.collect())) == sorted(map(str, model.transform(rows).select("features", "label").collect()))


def test_a_task_reads_few_vectors(spark):
    """Vectors of one task's text, which take little disk, are dealt over many tasks of a learner."""
    text = F.concat_ws(" ", F.concat(F.lit("w"), F.col("id") % 50), F.concat(F.lit("v"), F.col("id") % 7))
    rows = spark.range(0, 30_000, 1, 1).select(text.alias("clean_text"), F.concat(F.lit("c"), F.col("id") % 2).alias("Sentiment"))
    vectors = L.featurize(rows)[1]
    sizes = [r["count"] for r in vectors.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) <= 2 * L.VECTOR_ROWS


def test_linear_learners_pass_over_few_partitions(spark, monkeypatch):
    """As many tasks as cores, or one per so many vectors; trees get the vectors as they are stored."""

    class Linear:
        def fit(self, rows):
            return rows

    class Tree(Linear):
        pass

    cores = spark.sparkContext.defaultParallelism
    monkeypatch.setattr(L, "TREES", (Tree,))
    rows = spark.range(1000).repartition(5 * cores)
    assert L.fit(Linear(), rows).rdd.getNumPartitions() == cores
    assert L.fit(Tree(), rows).rdd.getNumPartitions() == 5 * cores
    monkeypatch.setattr(L, "PASS_ROWS", 1000 // (2 * cores))
    many = L.fit(Linear(), rows)
    assert cores < many.rdd.getNumPartitions() < 5 * cores
    assert sorted(r["id"] for r in many.collect()) == list(range(1000))
