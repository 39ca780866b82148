"""Score a stream of message envelopes and upsert the results, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loomstat.sources import files
from loomstat.sources.messages import PAYLOAD_SCHEMA, parse_envelope
from loomstat.streaming import changes
from loomstat.streaming.keyed import KeyedTable

SCORED_SCHEMA = (
    f"{PAYLOAD_SCHEMA}, predicted_sentiment string, prediction_index int, model_name string, scored_at timestamp"
)
# Trigger interval and monitoring window of a live run, in seconds.
TRIGGER_SECONDS = 30
MONITOR_SECONDS = 3600
CHANGE = ("change", "n_messages")

Scorer = Callable[[DataFrame], DataFrame]


def batch_writer(score: Scorer, table: KeyedTable, run: str) -> Callable[[DataFrame, int], None]:
    """The work on one micro-batch: parse, score, store, fold what is due. Nothing of the batch passes through the driver.

    Messages without an id are stored too, under the null key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table.upsert(score(parse_envelope(batch)), run=run, batch_id=batch_id)
        table.fold()

    return write


def change_writer(table: KeyedTable, run: str, counters: str) -> Callable[[DataFrame, int], None]:
    """Stores a micro-batch of ``changes.tracked`` and leaves a row of its counts below ``counters``.

    The batch is worked out once: the counts are read from two columns of the files that were just written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        commit = table.upsert(batch, run=run, batch_id=batch_id, keep=CHANGE)
        schema = f"{table.schema}, change string, n_messages bigint"
        stored = table.spark.read.schema(schema).parquet(f"{table.path}/{table.batch_folder(run, batch_id, commit)}")
        changes.counts(stored, table).write.mode("overwrite").parquet(f"{counters}/run={run}/batch={batch_id}")
        table.fold()

    return write


@contextmanager
def _state_store(spark):
    """State of this kind needs the store on RocksDB; a query keeps the provider that it was started with."""
    before = spark.conf.get(changes.PROVIDER, None)
    spark.conf.set(changes.PROVIDER, changes.ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(changes.PROVIDER) if before is None else spark.conf.set(changes.PROVIDER, before)


def start_scoring(
    stream: DataFrame, score: Scorer, table: KeyedTable, checkpoint: str, *, available_now: bool = False,
    trigger_seconds: int = TRIGGER_SECONDS, counters: str | None = None,
) -> StreamingQuery:
    """Start scoring ``stream`` into ``table``.

    Micro-batches are replayed after a failure with the same number, and every key ends up stored once. ``available_now``
    takes what is there and stops. ``counters`` names a folder for a row per batch: keys matched, modified and inserted,
    and messages without an id. They come from state kept per key, so they cost what the batch costs; the state
    begins with what the table holds when the checkpoint is new. Streams that write into one table at the same time and
    count must be one query, on the union of them: another query's writes are not in this one's state.
    """
    spark, run = table.spark, table.run_for(checkpoint)
    if counters is None:
        return _started(stream.writeStream.foreachBatch(batch_writer(score, table, run)), checkpoint, available_now, trigger_seconds)
    fresh = not files.exists(spark, f"{checkpoint}/offsets")
    # a restart must be given an initial state as well, which it does not read
    known = table.read() if fresh else table.read().limit(0)
    with _state_store(spark):
        changed = changes.tracked(score(parse_envelope(stream)), table, initial=known)
        writer = changed.writeStream.foreachBatch(change_writer(table, run, counters))
        return _started(writer, checkpoint, available_now, trigger_seconds)


def _started(writer, checkpoint: str, available_now: bool, trigger_seconds: int) -> StreamingQuery:
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def run_for(query: StreamingQuery, seconds: int = MONITOR_SECONDS) -> bool:
    """Let a query run for a window, then stop it; True if it ended by itself."""
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()
