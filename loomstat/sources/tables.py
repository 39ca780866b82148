"""Readers and writers: Parquet, JSON Lines, JSON arrays, CSV, and one-row table profiles."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomstat.sources.json_arrays import scan_records

# The nested paper record. Weights are read as text: some writers quote them, and a quoted number read as a
# double would be lost. Undeclared fields are not parsed.
PAPER_SCHEMA = (
    "id string, title string, year string, n_citation string, doc_type string, "
    "authors array<struct<id: string, name: string, org: string>>, "
    "venue struct<id: string, raw: string, type: string>, "
    "references array<string>, fos array<struct<name: string, w: string>>"
)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_json_lines(spark: SparkSession, path: str, schema: str = PAPER_SCHEMA) -> DataFrame:
    """Splittable JSON Lines under a declared schema; a malformed line gives a row of nulls."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def scan_json_array(spark: SparkSession, path: str, schema: str = PAPER_SCHEMA) -> DataFrame:
    """Records of top-level JSON arrays in any layout, one array per file, as many tasks as the files have splits.

    A malformed array or record stops the job, so no record is lost in silence.
    """
    record = F.from_json("record", schema, {"mode": "FAILFAST"}).alias("r")
    return scan_records(spark, path).select(record).select("r.*")


def json_array_to_lines(spark: SparkSession, source: str, target: str, schema: str = PAPER_SCHEMA) -> DataFrame:
    """Write a JSON array as JSON Lines of the declared fields, once: an existing target is kept as it is.

    Lines repeat the names of all fields, so they are compressed to a tenth or so. A file is what one task wrote, hence of
    bounded size, and is read by one task.
    """
    scan_json_array(spark, source, schema).write.mode("ignore").json(target, compression="gzip")
    return scan_json_lines(spark, target, schema)


def write_json_array(records: DataFrame, path: str) -> None:
    """A JSON array per part file, one record per line."""

    def arrays(batches):
        opened = False
        for batch in batches:
            values = batch.column("value").to_pylist()
            lines = [("," if opened or i else "[") + value for i, value in enumerate(values)]
            opened = opened or bool(values)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
        yield pa.RecordBatch.from_arrays([pa.array(["]" if opened else "[]"])], ["value"])

    texts = records.select(F.to_json(F.struct(*records.columns)).alias("value"))
    texts.mapInArrow(arrays, "value string").write.text(path)


def write_once(df: DataFrame, path: str) -> DataFrame:
    """Materialise once: write Parquet only where nothing is there yet, and read what is there."""
    df.write.mode("ignore").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_overwrite(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_partitioned(df: DataFrame, path: str, *columns: str) -> DataFrame:
    """One directory per value of ``columns``; filters on them later prune whole directories.

    Rows are not moved for the write, so a value that holds most rows is still written by many tasks.
    """
    df.write.mode("overwrite").partitionBy(*columns).parquet(path)
    return df.sparkSession.read.parquet(path)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per named table with its row count."""
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n")) for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def write_metrics(metrics: DataFrame, path: str) -> DataFrame:
    """Model metrics as CSV with a header, best F1 first; a handful of rows, hence one file."""
    metrics.orderBy(F.desc("f1"), "model").coalesce(1).write.mode("overwrite").csv(path, header=True)
    return read_metrics(metrics.sparkSession, path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    schema = "model string, accuracy double, f1 double, weightedPrecision double, weightedRecall double"
    return spark.read.schema(schema).csv(path, header=True)


def append_metric_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new).orderBy(F.desc("f1"), "model")


def table_profile(df: DataFrame) -> DataFrame:
    """One row: rows, columns and the column list."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
        F.lit(",".join(df.columns)).alias("columns"),
    )


def clean_comment_schema(raw: T.StructType) -> T.StructType:
    """Schema of a cleaned comment table, from the raw one: repaired columns change type, others pass through."""
    repaired = {
        "Likes": T.StructField("Likes", T.IntegerType(), False),
        "Replies": T.StructField("Replies", T.IntegerType(), False),
        "CountryCode": T.StructField("CountryCode", T.StringType(), False),
    }
    derived = [
        T.StructField("clean_text", T.StringType(), False),
        T.StructField("comment_word_count", T.IntegerType(), False),
        T.StructField("comment_char_count", T.IntegerType(), False),
        T.StructField("engagement_total", T.IntegerType(), False),
        T.StructField("engagement_level", T.StringType(), False),
    ]
    return T.StructType([repaired.get(field.name, field) for field in raw.fields] + derived)
