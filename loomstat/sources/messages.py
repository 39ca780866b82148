"""Message envelopes: JSON payloads keyed by comment id, and the streams that carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.constants import MESSAGE_FIELDS
from loomstat.functions.text import parse_rfc3339, to_rfc3339, utc_now

PAYLOAD_SCHEMA = ", ".join(f"{name} string" for name in MESSAGE_FIELDS)
ENVELOPE_SCHEMA = "key binary, value binary"


def encode_messages(rows: DataFrame, *, fetched_at: Column | None = None) -> DataFrame:
    """``key`` and JSON ``value`` per message, as bytes.

    Missing text becomes '' and a missing author 'unknown'; instants are written in UTC with a ``Z``.
    """
    fetched = fetched_at if fetched_at is not None else utc_now()
    payload = {
        "text": F.coalesce("text", F.lit("")),
        "author": F.coalesce("author", F.lit("unknown")),
        "published_at": to_rfc3339(parse_rfc3339(F.col("published_at"))),
        "fetched_at": to_rfc3339(fetched),
    }
    fields = [payload.get(name, F.col(name)).alias(name) for name in MESSAGE_FIELDS]
    return rows.select(
        F.col("comment_id").cast("binary").alias("key"), F.to_json(F.struct(*fields)).cast("binary").alias("value")
    )


def parse_envelope(envelopes: DataFrame, *, keep_key: bool = False) -> DataFrame:
    """The payload's fields as string columns; with ``keep_key`` the message key as ``comment_key``."""
    payload = F.from_json(F.col("value").cast("string"), PAYLOAD_SCHEMA).alias("payload")
    key = [F.col("key").cast("string").alias("comment_key")] if keep_key else []
    parsed = envelopes.select(*key, payload)
    return parsed.select(*[c for c in parsed.columns if c != "payload"], "payload.*")


def topic_stream(spark: SparkSession, servers: str, topic: str, *, starting: str = "earliest") -> DataFrame:
    """Envelopes of a Kafka topic; needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
        .select("key", "value")
    )


def file_stream(spark: SparkSession, path: str, *, files_per_batch: int = 1000) -> DataFrame:
    """Envelopes from a folder of Parquet files, new files becoming new micro-batches."""
    return (
        spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )
