"""Scoring streams: counts from state, the folded table, snapshots, a run for a while."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from loomstat.plans.stream_queries import add_files
from loomstat.session import new_path
from loomstat.sources import files
from loomstat.sources.messages import ENVELOPE_SCHEMA, encode_messages, file_stream
from loomstat.streaming.keyed import KeyedTable
from loomstat.streaming.scoring import run_for, start_scoring

SCHEMA = "comment_id string, video_id string, text string, author string, published_at string, fetched_at string, source string"
WIDER = SCHEMA + ", score int, scored_at timestamp"
COUNTS = "matched", "modified", "upserted"


def score(rows):
    """Null for some rows, and a time with microseconds."""
    return rows.select(
        "*", F.when(F.length("text") > 1, F.length("text")).cast("int").alias("score"),
        (F.to_timestamp("published_at") + F.expr("INTERVAL 0.123456 SECOND")).alias("scored_at"),
    )


def messages(rows):
    """(id, text, hour) per message."""
    return [(i, "v", text, None, f"2026-01-01T{hour:02d}:00:00Z", "", "s") for i, text, hour in rows]


def put(spark, folder, rows):
    encode_messages(spark.createDataFrame(messages(rows), SCHEMA), fetched_at=F.to_timestamp(F.lit("2026-01-02"))).coalesce(1).write.mode(
        "append").parquet(folder)


def run(spark, source, table, checkpoint, counters):
    streams = [file_stream(spark, s, files_per_batch=1) for s in ([source] if isinstance(source, str) else source)]
    stream = streams[0] if len(streams) == 1 else streams[0].unionAll(streams[1])
    start_scoring(stream, score, table, checkpoint, available_now=True, counters=counters).awaitTermination()


def counted(spark, folder, name):
    rows = spark.read.parquet(folder).filter(F.col("run") == name).collect()
    return {r["batch"]: tuple(r[c] for c in COUNTS) for r in rows}


def test_counts_from_state_equal_a_pass_over_the_table(spark):
    """A stop and a restart, then all of it again from a new checkpoint, then a stream of two sources."""
    table, counters = KeyedTable(spark, new_path(spark, "keyed"), WIDER, fan=3), new_path(spark, "counters")
    rnd = random.Random(1)
    sources = [new_path(spark, "envelopes") for _ in range(3)]
    checkpoints = [new_path(spark, "offsets") for _ in range(3)]

    def some():
        return [(rnd.choice([None, *map(str, range(12))]), rnd.choice(["a", "bb", "ccc"]), rnd.randrange(3)) for _ in range(15)]

    for _ in range(2):
        put(spark, sources[0], some())
        run(spark, sources[0], table, checkpoints[0], counters)
    run(spark, sources[0], table, checkpoints[1], counters)  # everything again
    for source in sources[1:]:
        put(spark, source, some())
    run(spark, sources[1:], table, checkpoints[2], counters)  # two streams, one query
    seen = 0
    for checkpoint in checkpoints:
        name = table.run_for(checkpoint)
        for batch, found in counted(spark, counters, name).items():
            want = table.counters(run=name, batch_id=batch).first()
            assert found == tuple(want[c] for c in COUNTS)
            seen += sum(found)
    assert seen > 30
    # the plain writer stores the same rows
    plain = KeyedTable(spark, new_path(spark, "keyed"), WIDER)
    for source in (sources[0], sources[0]):
        start_scoring(file_stream(spark, source, files_per_batch=1), score, plain, new_path(spark, "offsets"), available_now=True).awaitTermination()
    both = [t.read().orderBy(*t.keys).collect() for t in (plain, KeyedTable(spark, new_path(spark, "keyed"), WIDER))]
    assert len(both[0]) and not both[1]


def test_stored_rows_do_not_depend_on_counting(spark):
    source = new_path(spark, "envelopes")
    rows = [("1", "a", 0), ("1", "bb", 1), ("1", "bb", 1), ("2", "x", 0), (None, "n", 0), (None, "nn", 0), ("3", "", 0)]
    put(spark, source, rows)
    tables = [KeyedTable(spark, new_path(spark, "keyed"), WIDER) for _ in range(2)]
    counters = new_path(spark, "counters")
    run(spark, source, tables[0], new_path(spark, "offsets"), counters)
    run(spark, source, tables[1], new_path(spark, "offsets"), None)
    found = [sorted(map(str, t.read().collect())) for t in tables]
    assert found[0] == found[1] and len(found[0]) == 4 and "123456" in found[0][0]
    row = spark.read.parquet(counters).first()
    assert (row["matched"], row["modified"], row["upserted"], row["without_id"]) == (0, 0, 4, 2)


def batch(spark, rows):
    return spark.createDataFrame(messages(rows), SCHEMA)


def test_reads_open_a_bounded_number_of_folders(spark):
    table = KeyedTable(spark, new_path(spark, "keyed"), SCHEMA, fan=4)
    want, rnd = {}, random.Random(2)
    for n in range(40):
        rows = [(str(rnd.randrange(30)), f"t{n}", n % 24) for _ in range(3)]
        # one row per key: of several the newest counts, and these are of one time
        rows = list({r[0]: r for r in rows}.values())
        table.upsert(batch(spark, rows), run="ab"[n % 2], batch_id=n // 2, commit=n)
        want |= {i: text for i, text, _ in rows}
        table.fold()
        assert len(table.snapshot().folders) <= 3 * 4
    assert {r["comment_id"]: r["text"] for r in table.read().collect()} == want
    two = sorted(want)[:2]
    some = spark.createDataFrame([(i, "v") for i in [*two, "none"]], "comment_id string, video_id string")
    assert {r["comment_id"]: r["text"] for r in table.lookup(some).collect()} == {i: want[i] for i in two}
    assert max(int(f[6]) for f in table.snapshot().folders) == 2


def test_a_reader_keeps_its_snapshot(spark):
    table = KeyedTable(spark, new_path(spark, "keyed"), SCHEMA, fan=2)
    table.upsert(batch(spark, [("1", "old", 0)]), run="r", batch_id=0, commit=1)
    table.upsert(batch(spark, [("2", "old", 0)]), run="r", batch_id=1, commit=2)
    before = table.read()
    table.fold()
    table.upsert(batch(spark, [("1", "new", 0)]), run="r", batch_id=2, commit=3)
    assert {r["text"] for r in before.collect()} == {"old"}
    assert {r["comment_id"]: r["text"] for r in table.read().collect()} == {"1": "new", "2": "old"}
    assert table.vacuum(older_than=3600) == 0
    assert table.vacuum(older_than=-5) == 2  # the two folded batches
    assert {r["comment_id"]: r["text"] for r in table.read().collect()} == {"1": "new", "2": "old"}


def test_only_one_of_two_folds_counts(spark, monkeypatch):
    table = KeyedTable(spark, new_path(spark, "keyed"), SCHEMA, fan=2)
    for n in range(2):
        table.upsert(batch(spark, [(str(n), "x", 0)]), run="r", batch_id=n, commit=n)
    begun = table.snapshot()
    assert table.fold() == 1
    monkeypatch.setattr(KeyedTable, "snapshot", lambda self: begun)
    assert table.fold() == 0  # began from the same snapshot, too late
    monkeypatch.undo()
    assert table.read().count() == 2 and len(table.snapshot().folders) == 1


def test_a_late_batch_of_another_clock_does_not_win(spark):
    table = KeyedTable(spark, new_path(spark, "keyed"), SCHEMA, fan=2)
    for n, text in ((5, "new"), (4, "late"), (3, "later"), (2, "latest")):
        table.upsert(batch(spark, [("1", text, 0)]), run="r", batch_id=n, commit=n)
        table.fold()
    assert table.read().first()["text"] == "new"


def test_half_written_batches_are_not_read(spark):
    table = KeyedTable(spark, new_path(spark, "keyed"), SCHEMA)
    table.upsert(batch(spark, [("1", "x", 0)]), run="r", batch_id=0, commit=1)
    files.delete(spark, f"{table.path}/{table.batch_folder('r', 0, 1)}/_SUCCESS")
    assert table.read().count() == 0


def test_small_files(spark):
    path = new_path(spark, "small") + "/a/b.json"
    assert files.put_new(spark, path, "ü") and not files.put_new(spark, path, "other")
    assert files.get(spark, path) == "ü" and files.names(spark, path.rsplit("/", 1)[0]) == ["b.json"]
    assert files.names(spark, new_path(spark, "nowhere")) == []


def test_run_for_a_while(spark):
    source = new_path(spark, "envelopes")
    put(spark, source, [("1", "a", 0)])
    table = KeyedTable(spark, new_path(spark, "keyed"), WIDER)
    stream = spark.readStream.schema(ENVELOPE_SCHEMA).parquet(source)
    query = start_scoring(stream, score, table, new_path(spark, "offsets"), trigger_seconds=1)
    assert run_for(query, seconds=12) is False and not query.isActive
    assert table.read().count() == 1
    ended = start_scoring(stream, score, table, new_path(spark, "offsets"), available_now=True)
    assert run_for(ended, seconds=60) is True


def test_files_are_as_many_as_the_rows_need(spark):
    """Not as many as tasks: each is a micro-batch."""
    stored = spark.range(0, 1000, 1, 20).selectExpr("cast(id as string) AS key", "'x' AS value")
    for rows, want in ((10_000, 1), (1000, 1), (400, 3)):
        path = new_path(spark, "files")
        add_files(stored, path, rows)
        files_of = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
        assert len(files_of) == want and sum(r["count"] for r in files_of) == 1000 and max(r["count"] for r in files_of) <= rows
    path = new_path(spark, "files")
    add_files(stored.limit(0), path)
    assert spark.read.parquet(path).count() == 0
