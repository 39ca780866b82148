"""Cleaning rules, row operators, metrics, nested records, ingest, keyed table."""

from __future__ import annotations

import json
import re

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from loomstat.functions import nested as N
from loomstat.functions import text as T
from loomstat.functions.nested import primary_by_weight
from loomstat.graph import build as B
from loomstat.graph.model import motif_legs
from loomstat.operators import metrics as M
from loomstat.operators import models as L
from loomstat.operators import rows as R
from loomstat.plans import inputs as inputs_module
from loomstat.session import new_path
from loomstat.sources import ingest as I
from loomstat.sources import tables as S
from loomstat.sources.messages import encode_messages, parse_envelope
from loomstat.streaming.keyed import KeyedTable
from loomstat.streaming.scoring import batch_writer

TEXTS = [
    None, "", "   ", "Hello World", "@user_1 hi", "see https://ex.org/x?y=1 now", "www.site.com", "http://a.b", "!!! ???",
    "Éclair 中文 @héllo_é x", "a_b c__d", "@@@", "@ https://x", "WWW.A.b HTTPS://C", "tab\tnew\nline", "____", "9 lives",
    "x@y.z", "😀 ok", "www.", "https://", "https:// x", "@a@b c", "-_-", "http://x\nword",
]


def python_clean(text):
    text = (text or "").lower()
    for pattern in (r"https?://[^ \t\n\x0b\f\r]+|www\.[^ \t\n\x0b\f\r]+", r"@[\p{L}\p{N}_]+", r"[^\p{L}\p{N}_ \t\n\x0b\f\r]", r"[ \t\n\x0b\f\r]+"):
        text = regex.sub(pattern, " ", text)
    return text.strip(" ")


def test_clean_text_rule(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = df.select("t", T.clean_text(F.col("t")).alias("c"), T.has_words(F.col("t")).alias("keep"),
                    T.word_count(T.clean_text(F.col("t"))).alias("n")).collect()
    for row in got:
        want = python_clean(row["t"])
        assert (row["c"], row["keep"], row["n"]) == (want, want != "", len(want.split()))


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(alphabet="aB9_@é中 .:/!\thtpsw-", max_size=25), min_size=1, max_size=60))
def test_cleaning_properties(spark, texts):
    clean = T.clean_text(F.col("t"))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", clean.alias("c"), T.clean_text(clean).alias("again"), T.has_words(F.col("t")).alias("keep"),
                     T.clean_text_strict(F.col("t")).alias("s"), T.has_words_strict(F.col("t")).alias("keep_s")).collect()
    for row in rows:
        assert row["c"] == python_clean(row["t"])
        assert row["keep"] == (row["c"] != "") and row["keep_s"] == (row["s"] != "")
        assert not re.search(r"[A-Z]|  ", row["c"])


def test_numbers_and_codes(spark):
    df = spark.createDataFrame([(" 7 ", " de "), ("n/a", None), ("3.0", "  "), (None, "x"), ("99999999999", "usa")], "n string, c string")
    got = [tuple(r) for r in df.select(T.safe_integer(F.col("n")), T.clean_country_code(F.col("c"))).collect()]
    assert got == [(7, "DE"), (0, "Unknown"), (0, "Unknown"), (0, "X"), (0, "US")]


def test_primary_by_weight(spark):
    rows = [([("b", "0.5"), ("a", "0.5")],), ([("x", None), ("y", "0.1")],), ([("x", "bad")],), ([],), (None,)]
    df = spark.createDataFrame(rows, "fos array<struct<name: string, w: string>>")
    got = [r[0] for r in df.select(N.primary_by_weight(F.col("fos"))).collect()]
    assert got == ["b", "y", "x", None, None]


def test_cagr(spark):
    df = spark.createDataFrame([(100, 400), (0, 5)], "a int, b int")
    assert [r[0] for r in df.select(N.cagr(F.col("a"), F.col("b"), years=2)).collect()] == [pytest.approx(100.0), None]


def test_stratified_split_shares(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "rare").otherwise("common").alias("y"))
    for bits, cut_rows in ((1, 10), (4, 10_000), (12, 1)):
        got = R.stratified_split(df, "y", "id", bits=bits, cut_rows=cut_rows)
        counts = {(r["y"], r["split"]): r["n"] for r in got.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
        assert counts == {("rare", "train"): 1335, ("rare", "val"): 166, ("rare", "test"): 166,
                          ("common", "train"): 2667, ("common", "val"): 333, ("common", "test"): 333}


def test_split_of_tiny_classes_keeps_all_rows(spark):
    df = spark.createDataFrame([(i, "a" if i else "b") for i in range(6)], "id long, y string")
    assert {r["split"] for r in R.stratified_split(df, "y", "id").collect()} == {"train"}


def test_samples(spark):
    df = spark.range(20000)
    part = R.hash_sample(df, "id", 0.4)
    assert abs(part.count() / 20000 - 0.4) < 0.02
    assert sorted(part.collect()) == sorted(R.hash_sample(df.repartition(7), "id", 0.4).collect())
    assert abs(R.sample_fraction(df).count() / 20000 - 0.4) < 0.02


def test_dedupe_prefers_order(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "c"), ("k", 1, "a"), ("m", None, "z")], "k string, n int, v string")
    assert {tuple(r) for r in R.dedupe_rows(df, ["k"], order=[F.col("n")]).collect()} == {("k", 1, "a"), ("m", None, "z")}


def test_metrics_equal_the_evaluator(spark):
    pairs = [(float(i % 3), float((i * 7 + i // 5) % 4)) for i in range(300)]
    df = spark.createDataFrame(pairs, "label double, prediction double")
    got = M.classification_metrics(df).first().asDict()
    for ours, theirs in (("accuracy", "accuracy"), ("f1", "f1"), ("weightedPrecision", "weightedPrecision"), ("weightedRecall", "weightedRecall")):
        assert got[ours] == pytest.approx(MulticlassClassificationEvaluator(metricName=theirs).evaluate(df), abs=1e-9)
    cells = M.confusion_matrix(df)
    assert cells.count() == 16 and cells.agg(F.sum("n")).first()[0] == 300


def test_counted_vocabulary_and_reload(spark):
    rows = [(f"good fine happy day {i % 5}", "Positive") for i in range(40)] + [(f"bad sad awful day {i % 5}", "Negative") for i in range(40)]
    df = spark.createDataFrame(rows, "clean_text string, Sentiment string")
    features = L.TextFeatures(vocabulary="counted", buckets=50, min_df=2, invalid_labels="skip")
    model = L.train(df, L.naive_bayes(), features)
    assert model.transform(df).filter("label <> prediction").count() == 0
    path = new_path(spark, "model")
    L.save_model(model, path)
    scored = L.score_rows(L.load_model(path), spark.createDataFrame([("1", "such a HAPPY day!")], "comment_id string, text string"))
    assert scored.first()["predicted_sentiment"] == "Positive"


def test_best_model_is_the_one_with_the_best_f1(spark):
    metrics = spark.createDataFrame([("a", 0.1, 0.3), ("b", 0.9, 0.2)], "model string, accuracy double, f1 double")
    assert L.best_model(metrics, {"a": 1, "b": 2}) == ("a", 1)


def test_nested_and_flat_records_build_the_same_graph(inputs):
    fresh = inputs_module.Inputs(inputs.spark, inputs.sf_dir)
    years = {"min_year": inputs_module.FIXTURE_MIN_YEAR, "max_year": inputs_module.FIXTURE_MAX_YEAR}
    from_nested = B.build_graph(B.tables_from_nested(fresh.nested_papers, **years))
    flat = B.build_graph(fresh.paper_tables)
    for part in ("vertices", "edges"):
        a, b = getattr(from_nested, part), getattr(flat, part)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_json_array_lines(spark, tmp_path):
    (tmp_path / "in.json").write_text('[\n{"id": "1", "title": "a, b]", "fos": [{"name": "x", "w": 0.5}]},\n{"id": "2"}\n]\n')
    got = S.json_array_to_lines(spark, str(tmp_path / "in.json"), str(tmp_path / "out"))
    assert [(r["id"], r["title"]) for r in got.orderBy("id").collect()] == [("1", "a, b]"), ("2", None)]
    assert got.filter("id = '1'").first()["fos"][0]["w"] == "0.5"


def test_ingest_marks(spark):
    source = spark.createDataFrame(
        [("1", "a", "2026-01-01T00:00:00Z"), ("2", "a", "2026-01-02T00:00:00Z"), ("3", "b", "2026-01-01T00:00:00.5Z")],
        "comment_id string, video_id string, published_at string")
    state = spark.createDataFrame([("a", "2026-01-01T00:00:00Z", True, "u"), ("d", "2025-01-01T00:00:00Z", True, "u")], I.STATE_SCHEMA)
    tracked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "video_id string")
    now = F.to_timestamp(F.lit("2026-03-01T00:00:00Z"))
    batch = I.new_rows(source, state)
    assert sorted(r["comment_id"] for r in batch.collect()) == ["2", "3"]
    after = {r["video_id"]: (r["last_fetched_time"], r["updated_at"]) for r in I.next_state(batch, state, tracked, now=now).collect()}
    stamp = "2026-03-01T00:00:00Z"
    assert after == {"a": ("2026-01-02T00:00:00Z", stamp), "b": ("2026-01-01T00:00:00.500000Z", stamp), "c": (stamp, stamp),
                     "d": ("2025-01-01T00:00:00Z", "u")}
    again = I.new_rows(source, I.next_state(batch, state, tracked, now=now))
    assert again.count() == 0


SCHEMA = "comment_id string, video_id string, text string, published_at string, fetched_at string"


def test_keyed_table(spark):
    table = KeyedTable(spark, new_path(spark, "keyed"), SCHEMA)
    assert table.read().count() == 0

    def rows(*items):
        return spark.createDataFrame([(i, "v", text, "p", at) for i, text, at in items], SCHEMA)

    run = table.run_for("check/one")
    table.upsert(rows(("1", "old", "1"), ("1", "new", "2"), ("2", "x", "1")), run=run, batch_id=0)
    assert table.counters(run=run, batch_id=0).first().asDict() == {"matched": 0, "modified": 0, "upserted": 2}
    table.upsert(rows(("2", "y", "1"), ("1", "new", "2"), ("3", "z", "1")), run=run, batch_id=1)
    assert table.counters(run=run, batch_id=1).first().asDict() == {"matched": 2, "modified": 1, "upserted": 1}
    want = {"1": "new", "2": "y", "3": "z"}
    assert {r["comment_id"]: r["text"] for r in table.read().collect()} == want
    assert table.run_for("check/one") == run != table.run_for("check/two")
    folded = table.compacted(new_path(spark, "folded"))
    assert {r["comment_id"]: r["text"] for r in folded.read().collect()} == want
    folded.upsert(rows(("3", "late", "9")), run=folded.run_for("check/two"), batch_id=0)
    assert {r["comment_id"]: r["text"] for r in folded.read().collect()} == {**want, "3": "late"}


def test_empty_batch_writes_nothing(spark):
    table = KeyedTable(spark, new_path(spark, "keyed"), SCHEMA)
    empty = spark.createDataFrame([], "key binary, value binary")
    batch_writer(lambda messages: messages, table, "000001-x")(empty, 0)
    assert table.read().count() == 0


def test_envelope_defaults(spark):
    row = [("1", "v", None, None, "2026-01-01T01:00:00+01:00", "", "s")]
    messages = spark.createDataFrame(row, "comment_id string, video_id string, text string, author string, published_at string, fetched_at string, source string")
    parsed = parse_envelope(encode_messages(messages), keep_key=True).first()
    assert (parsed["comment_key"], parsed["text"], parsed["author"], parsed["published_at"]) == ("1", "", "unknown", "2026-01-01T00:00:00Z")


def test_rfc3339_does_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2026-01-01T00:30:00.25+02:00",), ("no time",)], "t string")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = [r[0] for r in df.select(T.to_rfc3339(T.parse_rfc3339(F.col("t")))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2025-12-31T22:30:00.250000Z", None]


def test_two_streams_into_one_table(spark):
    """The last write wins, whichever stream it comes from, and a batch written again changes nothing."""
    table = KeyedTable(spark, new_path(spark, "keyed"), SCHEMA)
    one, two = table.run_for("check/one"), table.run_for("check/two")

    def store(run, batch, text, commit=None):
        rows = spark.createDataFrame([("1", "v", text, "p", "1")], SCHEMA)
        return table.upsert(rows, run=run, batch_id=batch, commit=commit)

    first = store(one, 0, "a")
    second = store(two, 0, "b")
    assert second > first
    store(one, 1, "c")
    assert table.read().first()["text"] == "c"
    store(one, 1, "c")
    assert table.counters(run=one, batch_id=1).first().asDict() == {"matched": 1, "modified": 1, "upserted": 0}
    store(two, 1, "d")
    assert [r["text"] for r in table.read().collect()] == ["d"]


def test_ingest_rounds(spark):
    """The state moves with the batch; a round that failed before its state was written takes nothing twice."""
    schema = "comment_id string, video_id string, published_at string"
    day = lambda n: f"2026-01-0{n}T00:00:00Z"
    tracked = spark.createDataFrame([("a",), ("b",)], "video_id string")
    folder = new_path(spark, "ingest")
    one = spark.createDataFrame([("1", "a", day(1)), ("2", "a", day(2))], schema)
    two = one.union(spark.createDataFrame([("3", "a", day(3)), ("4", "b", day(1)), ("5", "a", "no time")], schema))
    ids = lambda path: sorted(r["comment_id"] for r in spark.read.schema(schema).parquet(path).collect())
    now = F.to_timestamp(F.lit(day(1)))
    assert ids(I.ingest(one, tracked.filter("video_id = 'a'"), folder, now=now)) == ["1", "2"]
    # A failure between batch and state: the batch of round 1 is there, its state is not.
    I.new_rows(two, spark.read.schema(I.STATE_SCHEMA).parquet(f"{folder}/state/round=0")).write.parquet(f"{folder}/batch/round=1")
    assert ids(I.ingest(two, tracked, folder, now=now)) == ["3", "4"]
    assert ids(I.ingest(two, tracked, folder, now=now)) == []
    assert ids(f"{folder}/unreadable/round=1") == ["5"]


LAYOUTS = {
    "lines": '[\n{"id": "1", "title": "a, b]"},\n{"id": "2"}\n,{"id": "3", "fos": [{"name": "x", "w": 0.5}]}\n]\n',
    "several on a line": '[{"id": "1", "title": "a, b]"}, {"id": "2"},\n{"id": "3", "fos": [{"name": "x", "w": 0.5}]}]',
    "one line": '[{"id": "1", "title": "a, b]"}, {"id": "2"}, {"id": "3", "fos": [{"name": "x", "w": 0.5}]}]',
    "pretty": '[\n  {\n    "id": "1",\n    "title": "a, b]"\n  },\n  {"id": "2"},\n  {\n    "id": "3",\n    "fos": [\n      {"name": "x", "w": 0.5}\n    ]\n  }\n]\n',
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_json_array_in_any_layout(spark, tmp_path, layout):
    (tmp_path / "in.json").write_text(LAYOUTS[layout])
    rows = S.scan_json_array(spark, str(tmp_path / "in.json")).orderBy("id").collect()
    assert [(r["id"], r["title"]) for r in rows] == [("1", "a, b]"), ("2", None), ("3", None)]
    assert rows[2]["fos"][0]["w"] == "0.5"


def test_malformed_json_array_stops_the_job(spark, tmp_path):
    (tmp_path / "in.json").write_text('[\n{"id": "1"},\n{"id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        S.scan_json_array(spark, str(tmp_path / "in.json")).collect()


def test_written_json_arrays_are_arrays(spark, tmp_path):
    records = spark.range(50).selectExpr("cast(id as string) id", "concat('t', id) title").repartition(3)
    S.write_json_array(records, str(tmp_path / "out"))
    found = [r for f in (tmp_path / "out").glob("part-*.txt") for r in json.loads(f.read_text())]
    assert len(found) == 50 and S.scan_json_array(spark, str(tmp_path / "out")).count() == 50


def test_long_lists_stay_one_record(spark, tmp_path):
    record = {"id": "p", "fos": [{"name": f"f{i}", "w": str(i)} for i in range(5000)], "references": [str(i) for i in range(5000)]}
    (tmp_path / "in.json").write_text(json.dumps([record]))
    rows = S.json_array_to_lines(spark, str(tmp_path / "in.json"), str(tmp_path / "lines"))
    assert [len(r["references"]) for r in rows.collect()] == [5000]
    assert rows.select(primary_by_weight(F.col("fos"))).first()[0] == "f4999"


def test_stratified_split_moves_no_rows_by_class(spark):
    rows = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'rare' when id % 50 = 1 then null else 'common' end label")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        split = R.stratified_split(rows, "label", "id", val=0.1, test=0.2, cut_rows=5)
        found = {(r["label"], r["split"]): r["count"] for r in split.groupBy("label", "split").count().collect()}
        plan = split._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning" not in plan
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    for label, n in sizes.items():
        test, val = int(n * 0.2), int(n * 0.1)
        assert (found[label, "test"], found[label, "val"], found[label, "train"]) == (test, val, n - test - val)


def test_one_pass_is_enough(spark, tmp_path):
    """What a summary and a confusion matrix read of the data itself is read once."""
    predictions = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)], "label double, prediction double")
    predictions.write.parquet(str(tmp_path / "p"))
    plan = M.confusion_matrix(spark.read.parquet(str(tmp_path / "p")))._jdf.queryExecution().toString()
    assert str(tmp_path) not in plan.replace("file:", "")


def test_motif_patterns():
    assert motif_legs("(c)-[e1]->(a); (c)-[e2]->(b)") == [("c", "e1", "a"), ("c", "e2", "b")]
    for wrong in ("", "(a)-[]->(b)", "(a)-[e]->(b) (b)-[f]->(c)", "a-[e]->b"):
        with pytest.raises(ValueError):
            motif_legs(wrong)
