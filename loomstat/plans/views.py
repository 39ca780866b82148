"""The test inputs as SQL views over the supplied tables, valid in Spark and DuckDB alike, plus DuckDB-only views
that restate cleaning and graph building for the comparison SQL."""

from __future__ import annotations

import re

from loomstat.constants import STOP_WORDS

FIXTURE_MIN_YEAR = 1996
FIXTURE_MAX_YEAR = 2000
# The eight brands that stand in for the eight fields of the social scope, in ascending name order.
FIXTURE_FIELDS = ("Brand#1", "Brand#10", "Brand#11", "Brand#12", "Brand#13", "Brand#14", "Brand#15", "Brand#16")

SHARED_VIEWS = {
    "raw_comments": """
SELECT concat('c', d.doc_id) AS CommentID,
  concat('v', d.doc_id % 20) AS VideoID,
  CASE WHEN d.doc_id % 101 = 0 THEN NULL
       WHEN d.doc_id % 103 = 0 THEN ' !!! ??? '
       WHEN d.doc_id % 7 = 0 THEN concat('@user_', d.doc_id, ' see https://ex.org/', d.doc_id, ' ', d.text)
       ELSE d.text END AS CommentText,
  CASE WHEN d.doc_id % 13 = 0 THEN NULL WHEN d.doc_id % 17 = 0 THEN 'n/a'
       WHEN d.doc_id % 5 = 0 THEN '0' ELSE CAST(d.n_chars % 41 AS STRING) END AS Likes,
  CASE WHEN d.doc_id % 19 = 0 THEN NULL WHEN d.doc_id % 5 = 0 THEN '0'
       ELSE CAST(d.doc_id % 7 AS STRING) END AS Replies,
  CASE WHEN d.doc_id % 11 = 0 THEN NULL WHEN d.doc_id % 11 = 1 THEN '  '
       ELSE concat(' ', substr('abcdefgh', CAST(d.doc_id % 8 AS INT) + 1, 1), d.lang) END AS CountryCode,
  CASE WHEN l.toxic = 1 THEN 'Negative' WHEN l.quality = 1 THEN 'Positive' WHEN l.quality = 0 THEN 'Neutral'
       WHEN d.doc_id % 3 = 0 THEN 'Positive' WHEN d.doc_id % 3 = 1 THEN 'Neutral' ELSE 'Negative' END AS Sentiment
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "p_paper": """
SELECT CAST(o.o_orderkey AS STRING) AS id,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE concat('Paper ', o.o_orderkey % 5000) END AS title,
  CASE WHEN o.o_orderkey % 89 = 0 THEN '0' WHEN o.o_orderkey % 83 = 0 THEN 'n/a'
       ELSE CAST(year(o.o_orderdate) AS STRING) END AS year,
  CAST(CAST(floor(o.o_totalprice / 5000) AS BIGINT) AS STRING) AS n_citation,
  CASE WHEN o.o_orderkey % 29 = 0 THEN NULL WHEN o.o_orderkey % 31 = 0 THEN '(proc)' WHEN o.o_orderkey % 37 = 0 THEN '12th'
       WHEN o.o_orderkey % 3 = 0 THEN concat(' CONF ', n.n_name) ELSE concat('conf ', lower(n.n_name)) END AS venue_raw,
  CASE WHEN o.o_orderpriority < '3' THEN 'C' WHEN o.o_orderpriority < '4' THEN 'J' END AS venue_type
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "p_author": """
SELECT DISTINCT CAST(l.l_orderkey AS STRING) AS paper_id, CAST(s.s_suppkey AS STRING) AS author_id,
  CASE WHEN l.l_orderkey % 5 = 0 THEN concat('S. ', s.s_suppkey % 40) ELSE concat('Supplier ', s.s_suppkey % 40) END AS author_name,
  n.n_name AS org
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "p_field": """
SELECT CAST(l.l_orderkey AS STRING) AS paper_id, p.p_brand AS name, SUM(l.l_quantity) / 1000.0 AS w
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY l.l_orderkey, p.p_brand""",
    "p_ref": """
SELECT DISTINCT CAST(src AS STRING) AS paper_id, CAST(dst AS STRING) AS ref_id FROM (
  SELECT o_orderkey AS src, lag(o_orderkey) OVER (PARTITION BY l_partkey ORDER BY o_orderdate, o_orderkey) AS dst
  FROM (SELECT DISTINCT o.o_orderkey, o.o_orderdate, l.l_partkey FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey) x) y
WHERE dst IS NOT NULL""",
    "copurchase": """
SELECT DISTINCT CAST(o.o_custkey AS STRING) AS author_id, CAST(l.l_partkey AS STRING) AS paper_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "messages": """
SELECT concat(conv_id, ':', turn) AS comment_id, concat('v', conv_id % 10) AS video_id, text, role AS author,
  concat('2026-06-02T', lpad(CAST(conv_id % 24 AS STRING), 2, '0'), ':', lpad(CAST(turn % 60 AS STRING), 2, '0'), ':00Z') AS published_at,
  '2026-06-03T00:00:00Z' AS fetched_at, 'fixture' AS source
FROM conversations""",
    "predictions": """
SELECT doc_id, CAST(CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END AS DOUBLE) AS label,
  CAST((CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END
        + CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END) % 3 AS DOUBLE) AS prediction
FROM labels""",
}


def _scrub(text: str, symbols: str) -> str:
    for pattern in (r"https?://\S+|www\.\S+", r"@[\p{L}\p{N}_]+", symbols, r"\s+"):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return f"trim({text})"


def sql_list(values) -> str:
    return ", ".join("'" + str(value).replace("'", "''") + "'" for value in values)


CLEAN = _scrub("lower(coalesce(CommentText, ''))", r"[^\p{L}\p{N}_\s]")
CLEAN_STRICT = _scrub("lower(CommentText)", r"[^\p{L}\p{N}\s]")
FIELD_LIST = sql_list(FIXTURE_FIELDS)

DUCKDB_VIEWS = {
    "clean_comments": f"""
SELECT * FROM (
  SELECT CommentID, VideoID, CommentText, Sentiment,
    coalesce(TRY_CAST(Likes AS INT), 0) AS Likes, coalesce(TRY_CAST(Replies AS INT), 0) AS Replies,
    CASE WHEN CountryCode IS NULL OR trim(CountryCode) = '' THEN 'Unknown'
         ELSE substr(upper(trim(CountryCode)), 1, 2) END AS CountryCode,
    clean_text, CAST(len(string_split(clean_text, ' ')) AS INT) AS comment_word_count,
    CAST(length(clean_text) AS INT) AS comment_char_count,
    coalesce(TRY_CAST(Likes AS INT), 0) + coalesce(TRY_CAST(Replies AS INT), 0) AS engagement_total
  FROM (SELECT *, {CLEAN} AS clean_text FROM raw_comments) a) b
WHERE clean_text <> ''""",
    "comments": """
SELECT *, CASE WHEN engagement_total >= 20 THEN 'high' WHEN engagement_total >= 5 THEN 'medium'
               WHEN engagement_total > 0 THEN 'low' ELSE 'none' END AS engagement_level
FROM clean_comments""",
    "comment_words": f"""
SELECT Sentiment, word FROM (
  SELECT Sentiment, unnest(string_split(clean_text, ' ')) AS word FROM comments) u
WHERE length(word) > 2 AND word NOT IN ({sql_list(STOP_WORDS)})""",
    "papers": f"""
SELECT id, title, TRY_CAST(year AS INT) AS year, TRY_CAST(n_citation AS BIGINT) AS n_citation, venue_raw, venue_type,
  CASE WHEN venue_raw IS NULL OR trim(venue_raw) = '' THEN 'unknown_venue' ELSE lower(trim(venue_raw)) END AS venue_key
FROM p_paper WHERE TRY_CAST(year AS INT) BETWEEN {FIXTURE_MIN_YEAR} AND {FIXTURE_MAX_YEAR}""",
    "primary_fields": """
SELECT paper_id, name AS primary_field FROM (
  SELECT paper_id, name, row_number() OVER (PARTITION BY paper_id ORDER BY w DESC, name) AS rn FROM p_field) z
WHERE rn = 1""",
    "paper_authors": "SELECT a.* FROM p_author a WHERE a.paper_id IN (SELECT id FROM papers)",
    "author_names": """
SELECT author_id, author_name FROM (
  SELECT author_id, author_name, row_number() OVER (PARTITION BY author_id ORDER BY count(*) DESC, author_name) AS rn
  FROM paper_authors GROUP BY author_id, author_name) z WHERE rn = 1""",
    "venues": """
SELECT venue_key, venue_raw, venue_type FROM (
  SELECT venue_key, venue_raw, venue_type, row_number() OVER (PARTITION BY venue_key
    ORDER BY count(*) DESC, venue_raw, coalesce(venue_type, '~')) AS rn
  FROM papers
  WHERE venue_key <> 'unknown_venue' AND length(venue_key) >= 4 AND venue_key NOT LIKE '(%' AND venue_key NOT LIKE '#%'
    AND NOT regexp_matches(venue_key, '^[0-9]') AND NOT regexp_matches(venue_key, '^\\s')
    AND regexp_matches(venue_key, '[a-z]')
  GROUP BY venue_key, venue_raw, venue_type) z WHERE rn = 1""",
    "paper_vertices": """
SELECT 'P:' || p.id AS id, p.title AS name, 'paper' AS node_type, p.year, p.n_citation, p.venue_key, f.primary_field
FROM papers p LEFT JOIN primary_fields f ON p.id = f.paper_id""",
    "vertices": """
SELECT id, name, node_type, year, n_citation, venue_key, primary_field, CAST(NULL AS VARCHAR) AS venue_type FROM paper_vertices
UNION ALL SELECT 'A:' || author_id, author_name, 'author', NULL, NULL, NULL, NULL, NULL FROM author_names
UNION ALL SELECT 'V:' || venue_key, venue_raw, 'venue', NULL, NULL, NULL, NULL, venue_type FROM venues""",
    "wrote": "SELECT DISTINCT 'A:' || author_id AS src, 'P:' || paper_id AS dst, 'wrote' AS rel_type FROM paper_authors",
    "published_in": """
SELECT 'P:' || id AS src, 'V:' || venue_key AS dst, 'published_in' AS rel_type FROM papers
WHERE venue_key IN (SELECT venue_key FROM venues)""",
    "cites": """
SELECT DISTINCT 'P:' || paper_id AS src, 'P:' || ref_id AS dst, 'cites' AS rel_type FROM p_ref
WHERE paper_id IN (SELECT id FROM papers) AND ref_id IN (SELECT id FROM papers)""",
    "edges": "SELECT * FROM wrote UNION ALL SELECT * FROM published_in UNION ALL SELECT * FROM cites",
    "cited": "SELECT dst AS id, count(*) AS n FROM cites GROUP BY dst",
    "core_papers": f"SELECT id FROM paper_vertices WHERE primary_field IN ({FIELD_LIST})",
    "scope_edges": """
SELECT e.* FROM edges e LEFT JOIN core_papers s ON e.src = s.id LEFT JOIN core_papers d ON e.dst = d.id
WHERE s.id IS NOT NULL OR d.id IS NOT NULL""",
    "scope_vertices": """
SELECT v.*, c.id IS NOT NULL AS is_core FROM vertices v
JOIN (SELECT src AS id FROM scope_edges UNION SELECT dst FROM scope_edges) e ON v.id = e.id LEFT JOIN core_papers c ON v.id = c.id""",
    "scope_cites": "SELECT * FROM scope_edges WHERE rel_type = 'cites'",
    "coauthors": """
SELECT a.author_id AS a, b.author_id AS b, count(*) AS shared FROM copurchase a
JOIN copurchase b ON a.paper_id = b.paper_id AND a.author_id < b.author_id
GROUP BY a.author_id, b.author_id HAVING count(*) >= 2""",
}

ALL_VIEWS = {**SHARED_VIEWS, **DUCKDB_VIEWS}


def _needed(sql: str, found: list[str]) -> None:
    sql = re.sub(r"'[^']*'", "''", sql)
    for name, text in ALL_VIEWS.items():
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(text, found)
            if name not in found:
                found.append(name)


def with_views(sql: str) -> str:
    """``sql`` preceded by the views it mentions, directly or through other views."""
    body = sql.strip()
    found: list[str] = []
    _needed(body, found)
    if not found:
        return body
    # Views that build on others are worked out once, however often a query names them.
    ctes = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in DUCKDB_VIEWS else ''}({ALL_VIEWS[name].strip()})" for name in found
    )
    match = re.match(r"WITH\s+(RECURSIVE\s+)?", body, re.IGNORECASE)
    if match:
        return f"WITH {'RECURSIVE ' if match.group(1) else ''}{ctes},\n{body[match.end():]}"
    return f"WITH {ctes}\n{body}"
