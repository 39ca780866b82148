"""Classifier metrics from one pass over the predictions: everything follows from the label x prediction counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomstat.session import durable


def prediction_counts(predictions: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predictions.groupBy(
        F.col(label).cast("double").alias("label"), F.col(prediction).cast("double").alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(predictions: DataFrame, **columns) -> DataFrame:
    """Rows per (label, prediction), 0 for pairs of classes that do not occur, with the share of the label's rows.

    Classes are few; only their counts are completed, and each label row is spread over the class list of a
    one-row aggregate.
    """
    counts = durable(prediction_counts(predictions, **columns), "counts")
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("c")).agg(
        F.array_sort(F.collect_set("c")).alias("classes")
    )
    found = counts.groupBy("label").agg(F.map_from_entries(F.collect_list(F.struct("prediction", "n"))).alias("by"))
    labels = classes.select(F.explode("classes").alias("label"), "classes")
    cells = labels.join(found, "label", "left").select(
        "label", F.explode("classes").alias("prediction"), "by"
    )
    filled = cells.select("label", "prediction", F.coalesce(F.col("by")[F.col("prediction")], F.lit(0)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("label"))
    return filled.withColumn(
        "row_share", F.when(total > 0, F.round(F.col("n").cast("double") / total, 6)).otherwise(F.lit(0.0))
    )


def per_class_recall(predictions: DataFrame, **columns) -> DataFrame:
    counts = prediction_counts(predictions, **columns)
    correct = F.coalesce(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))), F.lit(0))
    return counts.groupBy("label").agg(
        F.sum("n").alias("support"),
        correct.alias("correct"),
        F.round(correct * F.lit(100.0).cast("double") / F.sum("n"), 2).alias("recall_pct"),
    )


def _per_class(counts: DataFrame) -> DataFrame:
    """Per class: support, true positives and rows predicted as the class, with precision, recall and F1."""
    same = F.col("label") == F.col("prediction")
    sides = counts.select(F.inline(F.array(
        F.struct(F.col("label").alias("c"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(same, F.col("n")).otherwise(0).alias("hits")),
        F.struct(F.col("prediction").alias("c"), F.lit(0).cast("bigint").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
    )))
    sums = sides.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("support", "predicted", "hits")])
    zero = F.lit(0.0)
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(zero)
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(zero)
    f1 = F.when(F.col("p") + F.col("r") > 0, 2 * F.col("p") * F.col("r") / (F.col("p") + F.col("r"))).otherwise(zero)
    return sums.withColumn("p", precision).withColumn("r", recall).withColumn("f", f1)


def classification_metrics(predictions: DataFrame, **columns) -> DataFrame:
    """One row: accuracy, f1, weightedPrecision and weightedRecall, the weights being the class supports."""
    per_class = _per_class(prediction_counts(predictions, **columns))
    total = F.sum("support")

    def weighted(column: str):
        return F.sum(F.col(column) * F.col("support")) / total

    return per_class.agg(
        (F.sum("hits") / total).alias("accuracy"),
        weighted("f").alias("f1"),
        weighted("p").alias("weightedPrecision"),
        weighted("r").alias("weightedRecall"),
    )


def classification_report(predictions: DataFrame, **columns) -> DataFrame:
    """Precision, recall, F1 and support per class, and one row of weighted averages."""
    counts = prediction_counts(predictions, **columns)
    rows = _per_class(counts).select(
        F.col("c").cast("int").cast("string").alias("class"),
        F.round("p", 6).alias("precision"), F.round("r", 6).alias("recall"), F.round("f", 6).alias("f1"), "support",
    )
    average = _per_class(counts).agg(
        F.lit("weighted avg").alias("class"),
        *[F.round(F.sum(F.col(x) * F.col("support")) / F.sum("support"), 6).alias(name)
          for x, name in (("p", "precision"), ("r", "recall"), ("f", "f1"))],
        F.sum("support").alias("support"),
    )
    return rows.unionByName(average)
