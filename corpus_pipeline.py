"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the one before it kept. All but the last return the
columns of ``documents``. ``n_chars`` follows the text where a stage changes it.

Defined cases are those of the operators: a null text counts as empty, rows with equal ids are told apart by their
text, rows equal in both are one to the near-duplicate stage, which keeps one row of each group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import decontamination, line_dedup, quality, sentencepiece_codec, simhash
from loomstat.llm.common import durable, read_table
from loomstat.llm.queries import PIECE_MODEL


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier, fitted on labelled ones outside the held-out fold, scores below 0.3."""
    model = quality.fit_documents(docs, read_table(spark, sf_dir, "labels"), "quality", held_out=0)
    return quality.keep_good(docs, model, threshold=0.3)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines of 40 signs and more that 5 or more documents hold, but from the largest id; keeps all rows."""
    kept = line_dedup.drop_repeated_lines(docs, min_chars=40, min_docs=5)
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", size).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints over 4-word shingles that link at 4 or fewer differing bits."""
    return simhash.keep_one_of_each(docs, shingle=4, distance=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of 10 words of a benchmark text, or all of a shorter one."""
    return decontamination.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), window=10)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of each text with an end id, their number, and the digests of ids and of the decoded text.

    Columns of ``docs`` that are named like one of these, in any case, give way to them.
    """
    results = {name.lower() for name in sentencepiece_codec.ENCODED.names}
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in results])
    both = docs.select(own.alias("row"), sentencepiece_codec.encoded("text", PIECE_MODEL).alias("tokens"))
    return both.select("row.*", "tokens.*")


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece),
]

# SQL cannot state the classifier, the fingerprints or the tokens; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), "stage")
    return docs
