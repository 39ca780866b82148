"""The registered queries of this folder and the SQL that gives the same rows, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomstat.llm import (
    decontamination, language_model, line_dedup, prefix_trie, quality, quality_rules, quotation, sentencepiece_codec, simhash, topk,
    toxicity, warc, whitening,
)
from loomstat.llm.common import durable, read_table
from loomstat.llm.labelled import fold_of

# The vocabulary file of op7; another one can be named here or passed to the operator.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# White space of the contracts: blank and 0x09-0x0D, as DuckDB text.
SQL_BLANKS = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
SQL_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_line_dedup", f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT doc_id, pos, line, {SQL_FOLD.format(f"trim(line, {SQL_BLANKS})")} AS k FROM lines
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT doc_id, pos, line, repeated.k IS NOT NULL AND doc_id <> keeper AS gone
  FROM keyed LEFT JOIN repeated ON keyed.k = repeated.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = line_dedup.with_bitmaps(read_table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    digest = line_dedup.kept_digest(F.col("row.text"), "keep", "n_lines", "n_dropped")
    return marked.select("row.doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    marked = docs.select("doc_id", sentencepiece_codec.digest("text", PIECE_MODEL).alias("d"))
    return marked.select("doc_id", "d.*")


_SQL_ITEM_WORDS = r"""
  list_filter(regexp_split_to_array({fold}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')
"""


def _sql_words(text: str) -> str:
    return _SQL_ITEM_WORDS.format(fold=SQL_FOLD.format(f"coalesce({text}, '')"))


@query("op8_decontamination", f"""
WITH d AS (SELECT doc_id, {_sql_words('text')} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_sql_words('text')} AS w FROM benchmark),
sized AS (SELECT item, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT item, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT item, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM sized)
),
sizes AS (SELECT DISTINCT n FROM windows),
found AS (
  SELECT doc_id, item, p.n, i FROM (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)
  ) p JOIN windows ON p.k = windows.k AND p.n = windows.n
),
hits AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (
  SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS pos FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN named ON d.doc_id = named.doc_id
""")
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_benchmark(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), carry=["doc_id"], window=10
    )
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op2_simhash")
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=4, distance=4)
    written = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return groups.select(F.col("id").alias("doc_id"), written, F.col("component").alias("component_id"))


@query("op9_quality_classifier")
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = quality.fit_documents(docs, labels, "quality", held_out=0)
    scored = docs.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), model.column("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    model = toxicity.fit_documents(docs, labels, "toxic", held_out=0)
    scored = docs.select("doc_id", (fold_of("doc_id") == 0).alias("held_out"), model.column("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op5_quality_rules", f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text,
  list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: trim(x, {SQL_BLANKS}) <> '') AS lines FROM t),
p AS (SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS k
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 4)) AS i FROM w WHERE len(words) >= 5)),
r AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (
  SELECT doc_id, unnest(generate_series(i, i + 4)) AS pos
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM p) WHERE c > 1) GROUP BY doc_id),
f AS (SELECT w.doc_id, text, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
  len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r ON w.doc_id = r.doc_id),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    OR 2 * n_dup_lines > n_lines OR 10 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 4 * word_chars
    OR 10 * (length(text) - length(replace(text, '!', ''))) > 3 * n_words
    OR 10 * length(regexp_replace(text, '[^0-9]', '', 'g')) > 3 * word_chars) AS kept
FROM b
""")
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(read_table(spark, sf_dir, "documents"))
    return judged.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op6_quotation_linking", r"""
WITH RECURSIVE m AS (SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn FROM conversations),
lines AS (SELECT conv_id, CAST(turn AS BIGINT) AS turn, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM conversations),
parsed AS (SELECT conv_id, turn,
  length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) AS level,
  trim(regexp_replace(lower(regexp_replace(line, '^(?:[ \t]*>)+', '')), '\s+', ' ', 'g')) AS body FROM lines),
found AS (SELECT q.conv_id, q.turn, q.level,
  (SELECT max(o.turn) FROM parsed o WHERE o.conv_id = q.conv_id AND o.level = 0 AND o.body = q.body AND o.turn < q.turn) AS origin
  FROM parsed q WHERE q.level > 0 AND q.body <> ''),
counts AS (SELECT conv_id, turn, level, origin, count(*) AS n FROM found GROUP BY ALL),
quotes AS (SELECT conv_id, turn, sum(n) AS n_quoted, coalesce(sum(n) FILTER (WHERE origin IS NOT NULL), 0) AS n_linked,
  first(origin ORDER BY level, n DESC, origin DESC) FILTER (WHERE origin IS NOT NULL) AS origin FROM counts GROUP BY ALL),
t AS (SELECT m.conv_id, m.turn, n_quoted, n_linked, origin,
  lag(m.turn) OVER (PARTITION BY m.conv_id ORDER BY m.turn) AS previous
  FROM m LEFT JOIN quotes ON m.conv_id = quotes.conv_id AND m.turn = quotes.turn),
r AS (SELECT *, coalesce(origin, previous) AS reply_to,
  CASE WHEN previous IS NULL OR coalesce(origin, previous) <> previous THEN turn END AS start FROM t),
s AS (SELECT *, max(start) OVER (PARTITION BY conv_id ORDER BY turn) AS strand FROM r),
paths AS (
  SELECT conv_id, strand, '' AS path FROM s WHERE start IS NOT NULL AND reply_to IS NULL
  UNION ALL
  SELECT c.conv_id, c.strand, p.path || '/' || lpad(CAST(999999999999 - c.reply_to AS VARCHAR), 12, '0') || '.'
    || lpad(CAST(c.strand AS VARCHAR), 12, '0')
  FROM paths p JOIN s u ON u.conv_id = p.conv_id AND u.strand = p.strand
  JOIN s c ON c.conv_id = u.conv_id AND c.reply_to = u.turn AND c.start IS NOT NULL
)
SELECT c.conv_id, CAST(c.turn AS BIGINT) AS turn, c.role, CAST(coalesce(n_quoted, 0) AS BIGINT) AS n_quoted,
  CAST(coalesce(n_linked, 0) AS BIGINT) AS n_linked, reply_to, s.strand, path,
  sha256(array_to_string(list_filter(string_split(coalesce(c.text, ''), chr(10)),
    lambda x: NOT regexp_matches(x, '^(?:[ \t]*>)+')), chr(10))) AS own_sha256
FROM conversations c LEFT JOIN s ON c.conv_id = s.conv_id AND c.turn = s.turn
LEFT JOIN paths ON s.conv_id = paths.conv_id AND s.strand = paths.strand
""")
def op6_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = quotation.link_conversations(read_table(spark, sf_dir, "conversations"))
    return linked.select(
        F.col("row.conv_id").alias("conv_id"), F.col("row.turn").cast("bigint").alias("turn"), F.col("row.role").alias("role"),
        "n_quoted", "n_linked", "reply_to", "strand", "path", F.sha2(F.col("own").cast("binary"), 256).alias("own_sha256"),
    )


@query("op4_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
t AS (SELECT html, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
  CASE WHEN keeper IS NULL OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM p LEFT JOIN t ON p.html = t.html
""")
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.convert(read_table(spark, sf_dir, "pages"), version=2, revisit_bytes=1000)
    found = warc.read_warc(spark, archive, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_language_model")
def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    training = docs.filter(fold_of("doc_id") != 1)
    counts = durable(language_model.count_tokens(training), "token-counts")
    model = language_model.train(training, counts=counts)
    scored = language_model.score(docs, model, counts)
    return scored.select(
        F.col("id").alias("doc_id"), (fold_of("id") == 1).alias("held_out"), "n_tokens", "n_known",
        F.lit(int(model.total)).cast("bigint").alias("train_tokens"), "base_score", "score",
    )


@query("op11_topk_search", """
WITH v AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, q.r, v.vec_id, CAST(list_inner_product(q.x, v.x) AS BIGINT) AS score
  FROM v q JOIN v ON q.r <> v.r WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
""")
def op11_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), components=32, scale=64.0, offset=1_000_000)


# CRC-32 by its bytes' table, which is made from the polynomial.
_SQL_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1]))"""


@query("op13_prefix_trie", f"""
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, CAST(range(8) AS BIGINT[])),
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS steps),
t AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, l, xor({_SQL_CRC.format(id="conv_id")}, 4294967295) % 9 AS h FROM t, crc),
c AS (SELECT h.conv_id, list_concat(coalesce(b.l, [])[1:h], h.l[h + 1:]) AS l
  FROM h LEFT JOIN t b ON b.conv_id = h.conv_id - h.conv_id % 5),
m AS (SELECT conv_id, unnest(range(len(l) + 1)) AS d, l FROM c),
n AS (SELECT d, l[1:d] AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(l) = d), '')) AS ends_sha256
  FROM m GROUP BY ALL),
k AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children,
    CASE WHEN n.d = 0 THEN 0 ELSE (n_convs - 1) * strlen(n.p[-1].text) END AS w
  FROM n LEFT JOIN k ON n.d = k.d AND n.p = k.p),
u AS (SELECT e AS d, p[1:e] AS p, sum(w) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(d + 1)) AS e FROM w) GROUP BY ALL)
SELECT w.conv_id, w.d AS depth, a.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, w.ends_sha256
FROM w JOIN u ON w.d = u.d AND w.p = u.p LEFT JOIN n a ON a.d = w.d - 1 AND a.p = w.p[1:w.d - 1] AND w.d > 0
""")
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = durable(prefix_trie.paths(read_table(spark, sf_dir, "conversations")), "conversations")
    return prefix_trie.trie(prefix_trie.rebuilt(convs, group=5, most=9))
