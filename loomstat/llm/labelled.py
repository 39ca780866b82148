"""Labelled rows to learn from: a bounded sample of them, and the folds that a document's id puts it in."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
# Documents that a classifier is fitted on at most.
FIT_ROWS = 40_000


def fold_of(id_col: str, folds: int = FOLDS) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; a null id counts as empty text, so its fold is 0."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds)).cast("int")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, *, id_col: str = "doc_id", text_col: str = "text",
    held_out: int = 0, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """``text, label, fold`` of some ``fit_rows`` labelled documents whose fold is not ``held_out``.

    The sample is drawn by a hash of the id, the same in every run; with fewer labels it is all of them. Of several
    labels of one id the mean counts; null ids and labels are left out. The sampled labels, a bounded number of ids,
    are broadcast, so texts are not shuffled.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label).isNotNull())
    known = known.groupBy(F.col(id_col).alias("lid")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("label"))
    known = known.withColumn("fold", fold_of("lid")).filter(F.col("fold") != held_out)
    total = known.count()
    if total > fit_rows:
        share = math.floor(fit_rows / total * 1_000_000)
        known = known.filter(F.pmod(F.xxhash64("lid", F.lit(11)), F.lit(1_000_000)) < share)
    rows = docs.select(F.col(id_col).alias("rid"), F.col(text_col).alias("text"))
    return rows.join(F.broadcast(known), F.col("rid") == F.col("lid")).select("text", "label", "fold")
