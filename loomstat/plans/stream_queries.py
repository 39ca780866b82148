"""Queries on message envelopes, incremental ingest, the keyed table and the scoring stream."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from loomstat.constants import SENTIMENTS
from loomstat.functions.nested import label_map
from loomstat.functions.text import clean_text
from loomstat.operators import models as L
from loomstat.plans.model_queries import splits
from loomstat.plans.registry import query
from loomstat.session import durable, new_path
from loomstat.sources import ingest as I
from loomstat.sources import messages as E
from loomstat.streaming.keyed import KeyedTable
from loomstat.streaming.scoring import SCORED_SCHEMA, start_scoring

FETCHED = "2026-06-03T00:00:00Z"


def envelopes(t):
    fetched = F.to_timestamp(F.lit(FETCHED))
    return E.encode_messages(t.view("messages"), fetched_at=fetched)


# Envelopes of a file, which is a micro-batch.
FILE_ROWS = 200_000


def add_files(stored, path: str, rows: int = FILE_ROWS) -> None:
    """Adds written envelopes to a folder in as few files of at most ``rows`` as hold them, and one at least.

    A task's share of the input would be a file, and a micro-batch takes seconds however small it is.
    """
    dealt = stored.repartition(max(1, math.ceil(stored.count() / rows)))
    dealt.write.option("maxRecordsPerFile", rows).mode("append").parquet(path)


def stored_envelopes(t, rows: int = FILE_ROWS) -> str:
    """A folder of envelope files of bounded size, two of them at least, for several micro-batches."""
    path = new_path(t.spark, "envelopes")
    stored = durable(envelopes(t), "envelopes")
    for part in (F.xxhash64("key") > 0, F.xxhash64("key") <= 0):
        add_files(stored.filter(part), path, rows)
    return path


def rule_score(messages):
    """A scorer without a model, so that SQL can restate it: the class follows from the length of the clean text."""
    index = (F.length(clean_text(F.col("text"))) % 3).cast("int")
    return messages.select(
        "*",
        label_map(dict(enumerate(SENTIMENTS)))[index].alias("predicted_sentiment"),
        index.alias("prediction_index"),
        F.lit("rule").alias("model_name"),
        E.parse_rfc3339(F.col("published_at")).alias("scored_at"),
    )


def scored_table(t) -> KeyedTable:
    return KeyedTable(t.spark, new_path(t.spark, "scored"), SCORED_SCHEMA)


def stored_scores(t) -> KeyedTable:
    """The keyed table after all messages were scored and stored."""
    table = scored_table(t)
    table.upsert(rule_score(t.view("messages")), run="a", batch_id=0)
    return table


RULE = r"""
clean_messages AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')),
  'https?://\S+|www\.\S+', ' ', 'g'), '@[\p{L}\p{N}_]+', ' ', 'g'), '[^\p{L}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g')) AS words FROM messages),
scored AS (SELECT comment_id, video_id, published_at, CAST(length(words) % 3 AS INT) AS prediction_index, CASE length(words) % 3
  WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' ELSE 'Positive' END AS predicted_sentiment FROM clean_messages)"""


@query("encode_messages", """
SELECT comment_id AS key, CAST(json_object('comment_id', comment_id, 'video_id', video_id, 'text', coalesce(text, ''),
  'author', coalesce(author, 'unknown'), 'published_at', published_at, 'fetched_at', fetched_at, 'source', source) AS VARCHAR) AS value
FROM messages""")
def encode_messages(t):
    return envelopes(t).select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query("stream_parse_envelope", """
SELECT comment_id AS comment_key, comment_id, video_id, text, author, published_at, fetched_at, source FROM messages""")
def stream_parse_envelope(t):
    return E.parse_envelope(envelopes(t), keep_key=True)


@query("stream_source", "SELECT comment_id AS key, video_id FROM messages")
def stream_source(t):
    """Envelopes copied from a file stream to a table, one file per micro-batch."""
    target = new_path(t.spark, "copied")
    stream = E.file_stream(t.spark, stored_envelopes(t), files_per_batch=1)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", new_path(t.spark, "offsets"))
    writer.trigger(availableNow=True).start(target).awaitTermination()
    copied = E.parse_envelope(t.spark.read.schema(E.ENVELOPE_SCHEMA).parquet(target), keep_key=True)
    return copied.select(F.col("comment_key").alias("key"), "video_id")


MARK = "2026-06-02T12:00:00Z"
OLD_SOURCES = "'v0', 'v2', 'v4', 'v6'"


@query("incremental_ingest", f"""
WITH fresh AS (SELECT * FROM messages WHERE video_id NOT IN ({OLD_SOURCES}) OR published_at > '{MARK}'),
sources AS (SELECT DISTINCT video_id FROM messages UNION ALL SELECT 'v-empty')
SELECT s.video_id, count(f.comment_id) AS n_taken,
  coalesce(max(f.published_at), CASE WHEN s.video_id IN ({OLD_SOURCES}) THEN '{MARK}' ELSE '{FETCHED}' END) AS last_fetched_time
FROM sources s LEFT JOIN fresh f ON s.video_id = f.video_id GROUP BY s.video_id""")
def incremental_ingest(t):
    """Two rounds through the stored state: rows of four sources up to a mark, then all rows of all sources and one
    source without any. Rows that the second round takes and the marks it leaves."""
    messages = t.view("messages")
    folder = new_path(t.spark, "ingest")
    old = messages.filter(f"video_id IN ({OLD_SOURCES})")
    first = old.filter(F.col("published_at") < MARK).union(old.select("video_id").distinct().select(
        F.lit("at-mark").alias("comment_id"), "video_id", *[F.lit(None).cast("string").alias(c) for c in ("text", "author")],
        F.lit(MARK).alias("published_at"), F.lit(FETCHED).alias("fetched_at"), F.lit("fixture").alias("source"),
    ).select(*messages.columns))
    now = F.to_timestamp(F.lit(FETCHED))
    I.ingest(first, old.select("video_id").distinct(), folder, now=now)
    tracked = messages.select("video_id").distinct().union(t.spark.sql("SELECT 'v-empty'"))
    path = I.ingest(messages, tracked, folder, now=now)
    batch = t.spark.read.schema(messages.schema).parquet(path)
    after = t.spark.read.schema(I.STATE_SCHEMA).parquet(f"{folder}/state/round=1")
    taken = batch.groupBy("video_id").agg(F.count(F.lit(1)).alias("n_taken"))
    return after.join(taken, "video_id", "left").fillna(0, ["n_taken"]).select("video_id", "n_taken", "last_fetched_time")


@query("sink_upsert_keyed", """
SELECT comment_id, video_id, CASE WHEN video_id IN ('v0', 'v1', 'v2') THEN 'edited' ELSE author END AS author,
  (SELECT count(*) FROM messages WHERE video_id IN ('v0', 'v1', 'v2')) AS matched,
  (SELECT count(*) FROM messages WHERE video_id IN ('v0', 'v1', 'v2')) AS modified, CAST(0 AS BIGINT) AS upserted FROM messages""")
def sink_upsert_keyed(t):
    """All messages, then a second batch that edits some; the second is written twice, as after a failure."""
    table = scored_table(t)
    scored = rule_score(t.view("messages"))
    table.upsert(scored.unionAll(scored), run="a", batch_id=0)
    edited = scored.filter("video_id IN ('v0', 'v1', 'v2')").withColumn("author", F.lit("edited"))
    for _ in range(2):
        table.upsert(edited, run="a", batch_id=1)
    counters = table.counters(run="a", batch_id=1)
    return table.read().select("comment_id", "video_id", "author").crossJoin(F.broadcast(counters))


@query("scored_inspect", f"""
WITH {RULE} SELECT comment_id, video_id, predicted_sentiment, published_at AS scored_at FROM scored
ORDER BY published_at DESC, comment_id LIMIT 200""")
def scored_inspect(t):
    newest = stored_scores(t).read().orderBy(F.desc("scored_at"), "comment_id").limit(200)
    return newest.select(
        "comment_id", "video_id", "predicted_sentiment", F.col("published_at").alias("scored_at")
    )


@query("prediction_distribution", f"""
WITH {RULE} SELECT predicted_sentiment, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM scored
GROUP BY predicted_sentiment""")
def prediction_distribution(t):
    counts = stored_scores(t).read().groupBy("predicted_sentiment").agg(F.count(F.lit(1)).alias("n"))
    counts = durable(counts, "counts")  # a row per class
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total"))))


EDITED = "video_id IN ('v0', 'v1', 'v2')"


@query("sink_folded_lookup", f"""
SELECT comment_id, video_id, 'edited' AS author, true AS few_folders, 0 AS first_level FROM messages WHERE {EDITED}""")
def sink_folded_lookup(t):
    """Nine batches, every three folders folded into one, then an edit of some keys, which are looked up again."""
    table = KeyedTable(t.spark, new_path(t.spark, "scored"), SCORED_SCHEMA, fan=3)
    scored = durable(rule_score(t.view("messages")).withColumn("nth", F.pmod(F.xxhash64("comment_id"), F.lit(9))), "scored")
    for n in range(9):
        table.upsert(scored.filter(F.col("nth") == n), run="a", batch_id=n)
        table.fold()
    edited = scored.filter(EDITED).withColumn("author", F.lit("edited"))
    table.upsert(edited, run="b", batch_id=0)
    folders = table.snapshot().folders
    found = table.lookup(edited.select("comment_id", "video_id")).select("comment_id", "video_id", "author")
    newest = min(int(f.split("/")[0].removeprefix("level=")) for f in folders)
    return found.select("*", F.lit(len(folders) <= 2).alias("few_folders"), F.lit(newest).alias("first_level"))


RESULT = "comment_id", "video_id", "predicted_sentiment", "prediction_index"


@query("stream_foreach_batch", f"WITH {RULE} SELECT comment_id, video_id, predicted_sentiment, prediction_index FROM scored")
def stream_foreach_batch(t):
    table = scored_table(t)
    stream = E.file_stream(t.spark, stored_envelopes(t), files_per_batch=1)
    start_scoring(stream, rule_score, table, new_path(t.spark, "offsets"), available_now=True).awaitTermination()
    return table.read().select(*RESULT)


@query("stream_restart", f"WITH {RULE} SELECT comment_id, video_id, predicted_sentiment, prediction_index FROM scored")
def stream_restart(t):
    """Half of the input, a stop, the rest after a restart from the checkpoint, then everything replayed."""
    table, checkpoint, folder = scored_table(t), new_path(t.spark, "offsets"), new_path(t.spark, "envelopes")
    early = durable(envelopes(t), "envelopes").withColumn("early", F.xxhash64("key") > 0)
    for part in ("early", "NOT early"):
        add_files(early.filter(part).select("key", "value"), folder)
        stream = E.file_stream(t.spark, folder, files_per_batch=1)
        start_scoring(stream, rule_score, table, checkpoint, available_now=True).awaitTermination()
    again = E.file_stream(t.spark, folder)
    start_scoring(again, rule_score, table, new_path(t.spark, "offsets"), available_now=True).awaitTermination()
    return table.read().select(*RESULT)


@query("stream_score_upsert", "SELECT comment_id, video_id, true AS agrees FROM messages")
def stream_score_upsert(t):
    """A trained model on the stream, the input played twice; next to it the same model on the rows as one batch."""
    model = L.train(splits(t)[0], L.naive_bayes())
    table, folder = scored_table(t), stored_envelopes(t)

    def score(rows):
        return L.score_rows(model, rows, model_name="naive bayes")

    for _ in range(2):
        stream = E.file_stream(t.spark, folder, files_per_batch=2)
        start_scoring(stream, score, table, new_path(t.spark, "offsets"), available_now=True).awaitTermination()
    expected = score(t.view("messages")).select("comment_id", F.col("predicted_sentiment").alias("expected"))
    stored = table.read().select(*RESULT).join(expected, "comment_id")
    return stored.select("comment_id", "video_id", (F.col("predicted_sentiment") == F.col("expected")).alias("agrees"))


@query("stream_counters", f"""
SELECT 'first' AS phase, CAST(0 AS BIGINT) AS matched, CAST(0 AS BIGINT) AS modified, count(*) AS upserted FROM messages
UNION ALL SELECT 'again', count(*), 0, 0 FROM messages UNION ALL SELECT 'edited', count(*), count(*), 0 FROM messages WHERE {EDITED}""")
def stream_counters(t):
    """What each stream did to the table, from its state: all messages, all of them again, and some with another author."""
    table, folder = scored_table(t), new_path(t.spark, "counters")
    plain, changed = stored_envelopes(t), new_path(t.spark, "envelopes")
    edits = t.view("messages").filter(EDITED).withColumn("author", F.lit("edited"))
    add_files(durable(E.encode_messages(edits, fetched_at=F.to_timestamp(F.lit(FETCHED))), "envelopes"), changed)
    phases = []
    for phase, source in (("first", plain), ("again", plain), ("edited", changed)):
        checkpoint = new_path(t.spark, "offsets")
        stream = E.file_stream(t.spark, source, files_per_batch=1)
        start_scoring(stream, rule_score, table, checkpoint, available_now=True, counters=folder).awaitTermination()
        phases.append((table.run_for(checkpoint), phase))
    schema = "matched bigint, modified bigint, upserted bigint, without_id bigint, run string, batch int"
    counts = t.spark.read.schema(schema).parquet(folder).join(F.broadcast(t.spark.createDataFrame(phases, "run string, phase string")), "run")
    return counts.groupBy("phase").agg(*[F.sum(c).alias(c) for c in ("matched", "modified", "upserted")])
