"""Queries over the comment table: scans, sinks, cleaning, aggregates, windows, word statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.constants import SENTIMENTS
from loomstat.functions import text as T
from loomstat.operators import comments as C
from loomstat.operators import metrics as M
from loomstat.operators import rows as R
from loomstat.plans.registry import query
from loomstat.plans.views import CLEAN, CLEAN_STRICT
from loomstat.session import durable, new_path
from loomstat.sources import tables as S

MODEL_COLUMNS = (
    "CommentText", "clean_text", "Sentiment", "Likes", "Replies", "comment_word_count", "engagement_total",
    "engagement_level",
)


@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def scan_parquet(t):
    path = f"{t.sf_dir}/orders.parquet"
    return S.scan_parquet(t.spark, path).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


STORED = "CommentID", "Likes", "Replies", "CountryCode", "engagement_level", "comment_word_count"


@query("sink_parquet_overwrite", f"SELECT {', '.join(STORED)} FROM comments")
def sink_parquet_overwrite(t):
    path = new_path(t.spark, "clean-comments")
    return S.write_overwrite(t.comments.select(*STORED), path)


@query("sink_parquet_partitioned", "SELECT CommentID, engagement_level FROM comments")
def sink_parquet_partitioned(t):
    path = new_path(t.spark, "comments-by-level")
    return S.write_partitioned(t.comments.select("CommentID", "engagement_level"), path, "engagement_level")


CLEAN_TYPES = {
    "CommentID": "string", "VideoID": "string", "CommentText": "string", "Likes": "int", "Replies": "int",
    "CountryCode": "string", "Sentiment": "string", "clean_text": "string", "comment_word_count": "int",
    "comment_char_count": "int", "engagement_total": "int", "engagement_level": "string",
}


@query("derive_clean_schema", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{kind}' AS type_name, count({c}) AS n_values FROM comments"
    for c, kind in CLEAN_TYPES.items()))
def derive_clean_schema(t):
    """The schema derived from the raw one, which the cleaned table must have, with the values per column."""
    derived = S.clean_comment_schema(t.raw_comments.schema)
    if [(f.name, f.dataType) for f in derived] != [(f.name, f.dataType) for f in t.comments.schema]:
        raise AssertionError("the cleaned table does not have the derived schema")
    filled = t.comments.agg(*[F.count(f.name).alias(f.name) for f in derived])
    types = F.create_map(*[F.lit(x) for f in derived for x in (f.name, f.dataType.simpleString())])
    return filled.unpivot([], derived.names, "column_name", "n_values").select(
        "column_name", types[F.col("column_name")].alias("type_name"), "n_values"
    )


@query("table_profile", """
SELECT count(*) AS n_rows, 7 AS n_columns,
  'CommentID,VideoID,CommentText,Likes,Replies,CountryCode,Sentiment' AS columns FROM raw_comments""")
def table_profile(t):
    return S.table_profile(t.raw_comments)


@query("select_model_columns", f"SELECT {', '.join(MODEL_COLUMNS)} FROM comments")
def select_model_columns(t):
    return t.comments.select(*MODEL_COLUMNS)


@query("normalise_null_category", """
SELECT CommentID, CASE WHEN CountryCode IS NULL OR trim(CountryCode) = '' THEN 'none given' ELSE CountryCode END AS country
FROM raw_comments""")
def normalise_null_category(t):
    return t.raw_comments.select("CommentID", T.known_or(F.col("CountryCode"), "none given").alias("country"))


@query("cast_types", """
SELECT id, TRY_CAST(year AS INT) AS year, TRY_CAST(n_citation AS BIGINT) AS n_citation,
  TRY_CAST(year AS DOUBLE) AS year_value, CAST(TRY_CAST(n_citation AS BIGINT) AS VARCHAR) AS citation_text FROM p_paper""")
def cast_types(t):
    return t.view("p_paper").select(
        "id",
        F.col("year").try_cast("int").alias("year"),
        F.col("n_citation").try_cast("bigint").alias("n_citation"),
        F.col("year").try_cast("double").alias("year_value"),
        F.col("n_citation").try_cast("bigint").cast("string").alias("citation_text"),
    )


@query("filter_in_list", """
SELECT CommentID, Sentiment, CountryCode FROM comments
WHERE Sentiment IN ('Negative', 'Positive') AND CountryCode NOT IN ('Unknown', 'AE')""")
def filter_in_list(t):
    kept = F.col("Sentiment").isin("Negative", "Positive") & ~F.col("CountryCode").isin("Unknown", "AE")
    return t.comments.filter(kept).select("CommentID", "Sentiment", "CountryCode")


@query("drop_null_rows", """
SELECT CommentID, Sentiment FROM raw_comments
WHERE CommentText IS NOT NULL AND Sentiment IS NOT NULL AND trim(CommentText) <> ''""")
def drop_null_rows(t):
    return R.drop_null_rows(t.raw_comments, "CommentText", "Sentiment").select("CommentID", "Sentiment")


@query("sample_fraction", """
SELECT CommentID, Sentiment FROM comments
WHERE CAST('0x' || substr(md5('42:' || CommentID), 1, 15) AS BIGINT) < CAST(floor(0.4 * 1152921504606846976) AS BIGINT)""")
def sample_fraction(t):
    return R.hash_sample(t.comments, "CommentID", 0.40).select("CommentID", "Sentiment")


@query("train_test_split", "SELECT CommentID, Sentiment, CAST(1 AS BIGINT) AS copies FROM comments")
def train_test_split(t):
    """Both parts together hold every row once."""
    train, test = R.train_test_split(durable(t.comments.select("CommentID", "Sentiment"), "split"), 0.8)
    return train.unionByName(test).groupBy("CommentID", "Sentiment").agg(F.count(F.lit(1)).alias("copies"))


@query("stratified_split", """
SELECT CommentID, label_id, CASE WHEN rn <= floor(n * 0.1) THEN 'test'
  WHEN rn <= floor(n * 0.1) + floor(n * 0.1) THEN 'val' ELSE 'train' END AS split
FROM (SELECT CommentID, label_id, count(*) OVER (PARTITION BY label_id) AS n, row_number() OVER (PARTITION BY label_id
    ORDER BY CAST('0x' || substr(md5('42:' || CommentID), 1, 15) AS BIGINT), CommentID) AS rn
  FROM (SELECT CommentID, CASE Sentiment WHEN 'Negative' THEN 0 WHEN 'Neutral' THEN 1 ELSE 2 END AS label_id
        FROM raw_comments WHERE CommentText IS NOT NULL AND trim(CommentText) <> '') x) y""")
def stratified_split(t):
    kept = R.drop_null_rows(t.raw_comments, "CommentText", "Sentiment")
    ids = F.array_position(F.array(*[F.lit(s) for s in SENTIMENTS]), F.col("Sentiment")).cast("int") - 1
    return R.stratified_split(kept.select("CommentID", ids.alias("label_id")), "label_id", "CommentID")


@query("dedupe_rows", """
SELECT text, doc_id, lang FROM (SELECT text, doc_id, lang, row_number() OVER (PARTITION BY text ORDER BY doc_id, lang) AS rn
  FROM documents) x WHERE rn = 1""")
def dedupe_rows(t):
    return R.dedupe_rows(t.table("documents").select("text", "doc_id", "lang"), ["text"], order=[F.col("doc_id")])


@query("distinct_values", """
SELECT lang, count(DISTINCT source) AS n_sources, count(DISTINCT text) AS n_texts FROM documents GROUP BY lang""")
def distinct_values(t):
    return t.table("documents").groupBy("lang").agg(
        F.count_distinct("source").alias("n_sources"), F.count_distinct("text").alias("n_texts")
    )


@query("shuffle_rows", "SELECT CommentID, Sentiment FROM comments")
def shuffle_rows(t):
    return R.shuffle_rows(t.comments.select("CommentID", "Sentiment"), "CommentID")


@query("join_broadcast_lookup", """
SELECT c.CommentID, m.label_id FROM comments c
JOIN (VALUES ('Negative', 0), ('Neutral', 1)) m(Sentiment, label_id) ON c.Sentiment = m.Sentiment""")
def join_broadcast_lookup(t):
    rows = [("Negative", 0), ("Neutral", 1)]  # a literal table of two rows; other labels drop out
    labels = t.spark.createDataFrame(rows, "Sentiment string, label_id int")
    return t.comments.join(F.broadcast(labels), "Sentiment").select("CommentID", "label_id")


SUMMARY = """
SELECT Sentiment, count(*) AS total_comments, round(avg(Likes), 2) AS avg_likes, round(avg(Replies), 2) AS avg_replies,
  max(Likes) AS max_likes, round(100.0 * count(*) / sum(count(*)) OVER (), 2) AS pct_of_total
FROM comments GROUP BY Sentiment"""


@query("join_cross_scalar", """
SELECT engagement_level, n, grand_total FROM (SELECT engagement_level, count(*) AS n FROM comments GROUP BY engagement_level) a
CROSS JOIN (SELECT count(*) AS grand_total FROM comments) b""")
def join_cross_scalar(t):
    counts = t.comments.groupBy("engagement_level").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("grand_total"))
    return counts.crossJoin(F.broadcast(total))


@query("summary_with_share", SUMMARY)
def summary_with_share(t):
    return C.summary_with_share(t.comments, "Sentiment").orderBy(F.desc("total_comments"), "Sentiment")


@query("join_topn_subquery", """
WITH cells AS (SELECT CountryCode, Sentiment, count(*) AS n FROM comments WHERE CountryCode <> 'Unknown' GROUP BY ALL),
ranked AS (SELECT CountryCode, sum(n) AS size, rank() OVER (ORDER BY sum(n) DESC, CountryCode) AS place FROM cells GROUP BY CountryCode)
SELECT CountryCode, Sentiment, n, round(100.0 * n / size, 1) AS pct_within FROM cells JOIN ranked USING (CountryCode)
WHERE place <= 5""")
def join_topn_subquery(t):
    return C.topn_group_shares(t.comments, "CountryCode", "Sentiment", n=5).orderBy(
        "CountryCode", F.desc("n"), "Sentiment"
    )


@query("group_count_sorted", "SELECT CountryCode, count(*) AS n FROM comments GROUP BY CountryCode")
def group_count_sorted(t):
    return C.group_counts(t.comments, "CountryCode")


@query("class_share_pct", """
SELECT Sentiment, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM comments), 2) AS pct
FROM comments GROUP BY Sentiment""")
def class_share_pct(t):
    return C.class_share(t.comments, "Sentiment")


@query("engagement_by_class", """
SELECT Sentiment, count(*) AS n, round(avg(Likes), 2) AS avg_likes, round(avg(Replies), 2) AS avg_replies,
  max(Likes) AS max_likes, max(Replies) AS max_replies FROM comments GROUP BY Sentiment""")
def engagement_by_class(t):
    return C.engagement_by_class(t.comments, "Sentiment")


RAW_COLUMNS = "CommentID VideoID CommentText Likes Replies CountryCode Sentiment".split()


@query("missing_values_by_column", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS missing FROM raw_comments"
    for c in RAW_COLUMNS))
def missing_values_by_column(t):
    return C.missing_values_by_column(t.raw_comments)


@query("kept_removed_counts", """
SELECT (SELECT count(*) FROM raw_comments) AS before, (SELECT count(*) FROM comments) AS after,
  (SELECT count(*) FROM raw_comments) - (SELECT count(*) FROM comments) AS removed""")
def kept_removed_counts(t):
    return C.kept_removed_counts(t.raw_comments, T.has_words(F.col("CommentText")))


@query("word_count_top20", """
SELECT word, count(*) AS n FROM comment_words GROUP BY word ORDER BY n DESC, word LIMIT 20""")
def word_count_top20(t):
    return C.top_words(t.comments, k=20)


@query("top_words_per_class", """
SELECT Sentiment, word, n, CAST(position AS INT) AS position FROM (
  SELECT Sentiment, word, count(*) AS n, row_number() OVER (PARTITION BY Sentiment ORDER BY count(*) DESC, word) AS position
  FROM comment_words GROUP BY Sentiment, word) x WHERE position <= 10""")
def top_words_per_class(t):
    return C.top_words_per_class(t.comments, "Sentiment", k=10).orderBy("Sentiment", "position")


@query("share_within_group", """
SELECT CountryCode, engagement_level, count(*) AS n,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY CountryCode), 1) AS pct_within
FROM comments GROUP BY CountryCode, engagement_level""")
def share_within_group(t):
    return C.share_within(t.comments, "CountryCode", "engagement_level")


@query("rank_within_group", """
SELECT engagement_level, Sentiment, count(*) AS n,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY engagement_level), 1) AS pct_within,
  CAST(rank() OVER (PARTITION BY engagement_level ORDER BY count(*) DESC) AS INT) AS rank_within
FROM comments GROUP BY engagement_level, Sentiment""")
def rank_within_group(t):
    return C.rank_within(t.comments, "engagement_level", "Sentiment").orderBy("engagement_level", "rank_within")


@query("top3_per_group", """
SELECT Sentiment, CommentText, Likes, Replies, CAST(position AS INT) AS position FROM (
  SELECT Sentiment, CommentText, Likes, Replies, row_number() OVER (PARTITION BY Sentiment ORDER BY Likes DESC, CommentID) AS position
  FROM comments WHERE Likes > 0) x WHERE position <= 3""")
def top3_per_group(t):
    needed = t.comments.select("CommentID", "Sentiment", "CommentText", "Likes", "Replies")
    return C.top_liked(needed, "Sentiment").drop("CommentID").orderBy("Sentiment", "position")


@query("topk_global", """
SELECT CommentID, Likes, Sentiment FROM comments ORDER BY Likes DESC, CommentID LIMIT 10""")
def topk_global(t):
    return t.comments.select("CommentID", "Likes", "Sentiment").orderBy(F.desc("Likes"), "CommentID").limit(10)


@query("multi_key_sort", "SELECT CountryCode, engagement_total, CommentID FROM comments")
def multi_key_sort(t):
    return t.comments.select("CountryCode", "engagement_total", "CommentID").orderBy(
        "CountryCode", F.desc("engagement_total"), "CommentID"
    )


@query("union_all", "SELECT lang AS tag FROM documents UNION ALL SELECT source FROM documents")
def union_all(t):
    documents = t.table("documents")
    return documents.select(F.col("lang").alias("tag")).union(documents.select("source"))


@query("ranking_overlap", """
SELECT word, count(*) OVER () AS overlap FROM (
  (SELECT word FROM comment_words WHERE Sentiment = 'Positive' GROUP BY word ORDER BY count(*) DESC, word LIMIT 10)
  INTERSECT
  (SELECT word FROM comment_words WHERE Sentiment = 'Negative' GROUP BY word ORDER BY count(*) DESC, word LIMIT 10)) x""")
def ranking_overlap(t):
    top = C.top_words_per_class(
        t.comments.filter(F.col("Sentiment").isin("Positive", "Negative")), "Sentiment", k=10
    )
    both = top.groupBy("word").agg(F.count(F.lit(1)).alias("lists")).filter("lists = 2").select("word")
    return both.crossJoin(F.broadcast(both.agg(F.count(F.lit(1)).alias("overlap"))))


@query("clean_text", f"SELECT CommentID, {CLEAN} AS clean_text FROM raw_comments")
def clean_text(t):
    return t.raw_comments.select("CommentID", T.clean_text(F.col("CommentText")).alias("clean_text"))


@query("clean_text_column", f"""
SELECT CommentID, strict AS clean_text FROM (SELECT CommentID, {CLEAN_STRICT} AS strict FROM raw_comments) x WHERE strict <> ''""")
def clean_text_column(t):
    return C.clean_text_column(t.raw_comments, "CommentText").select("CommentID", "clean_text")


@query("safe_integer", """
SELECT CommentID, coalesce(TRY_CAST(Likes AS INT), 0) AS likes, coalesce(TRY_CAST(Replies AS INT), 0) AS replies FROM raw_comments""")
def safe_integer(t):
    return t.raw_comments.select(
        "CommentID", *[T.safe_integer(F.col(c)).alias(c.lower()) for c in ("Likes", "Replies")]
    )


@query("clean_country_code", """
SELECT CommentID, CASE WHEN CountryCode IS NULL OR trim(CountryCode) = '' THEN 'Unknown'
  ELSE substr(upper(trim(CountryCode)), 1, 2) END AS country FROM raw_comments""")
def clean_country_code(t):
    return t.raw_comments.select("CommentID", T.clean_country_code(F.col("CountryCode")).alias("country"))


@query("classify_engagement", """
SELECT CommentID, CASE WHEN n >= 20 THEN 'high' WHEN n >= 5 THEN 'medium' WHEN n > 0 THEN 'low' ELSE 'none' END AS level
FROM (SELECT CommentID, coalesce(TRY_CAST(Likes AS INT), 0) + coalesce(TRY_CAST(Replies AS INT), 0) AS n FROM raw_comments) x""")
def classify_engagement(t):
    total = T.safe_integer(F.col("Likes")) + T.safe_integer(F.col("Replies"))
    return t.raw_comments.select("CommentID", T.classify_engagement(total).alias("level"))


PREPARED = """CommentID, VideoID, CommentText, Likes, Replies, CountryCode, Sentiment, clean_text, comment_word_count,
  comment_char_count, engagement_total, engagement_level"""


@query("prepare_comments", f"SELECT {PREPARED} FROM comments")
def prepare_comments(t):
    return t.comments


@query("rfc3339_parse_format", """
SELECT comment_id, strftime(CAST(published_at AS TIMESTAMP) + INTERVAL 90 MINUTE, '%Y-%m-%dT%H:%M:%SZ') AS shifted,
  CAST(epoch(CAST(published_at AS TIMESTAMP)) AS BIGINT) AS seconds FROM messages""")
def rfc3339_parse_format(t):
    instant = T.parse_rfc3339(F.col("published_at"))
    return t.view("messages").select(
        "comment_id",
        T.to_rfc3339(instant + F.expr("INTERVAL 90 MINUTE")).alias("shifted"),
        F.unix_timestamp(instant).alias("seconds"),
    )


@query("text_ellipsis", "SELECT CommentID, substr(CommentText, 1, 40) || '...' AS label FROM raw_comments")
def text_ellipsis(t):
    return t.raw_comments.select("CommentID", T.text_ellipsis(F.col("CommentText"), 40).alias("label"))


@query("confusion_matrix", """
SELECT a.c AS label, b.c AS prediction, coalesce(x.n, 0) AS n,
  round(coalesce(x.n, 0) / sum(coalesce(x.n, 0)) OVER (PARTITION BY a.c), 6) AS row_share
FROM (SELECT DISTINCT label AS c FROM predictions) a CROSS JOIN (SELECT DISTINCT label AS c FROM predictions) b
LEFT JOIN (SELECT label, prediction, count(*) AS n FROM predictions GROUP BY label, prediction) x
  ON x.label = a.c AND x.prediction = b.c""")
def confusion_matrix(t):
    return M.confusion_matrix(t.view("predictions")).orderBy("label", "prediction")


@query("per_class_recall", """
SELECT CAST(label AS DOUBLE) AS label, count(*) AS support, count(*) FILTER (WHERE label = prediction) AS correct,
  round(count(*) FILTER (WHERE label = prediction) * 100.0 / count(*), 2) AS recall_pct FROM predictions GROUP BY label""")
def per_class_recall(t):
    return M.per_class_recall(t.view("predictions"))


PER_CLASS = """
pc AS (SELECT c, support, hits / predicted AS p, hits / support AS r, 2.0 * hits / (predicted + support) AS f FROM (
  SELECT c, (SELECT count(*) FROM predictions WHERE label = c) AS support, (SELECT count(*) FROM predictions WHERE prediction = c) AS predicted,
    (SELECT count(*) FROM predictions WHERE prediction = c AND label = c) AS hits
  FROM (SELECT DISTINCT label AS c FROM predictions) d) e)"""


@query("classification_metrics", f"""
WITH {PER_CLASS}
SELECT round((SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FROM predictions), 6) AS accuracy,
  round(sum(f * support) / sum(support), 6) AS f1, round(sum(p * support) / sum(support), 6) AS weightedPrecision,
  round(sum(r * support) / sum(support), 6) AS weightedRecall FROM pc""")
def classification_metrics(t):
    metrics = M.classification_metrics(t.view("predictions"))
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])


@query("classification_report", f"""
WITH {PER_CLASS}
SELECT CAST(CAST(c AS INT) AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM pc
UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
  round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM pc""")
def classification_report(t):
    return M.classification_report(t.view("predictions"))
