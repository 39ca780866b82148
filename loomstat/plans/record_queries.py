"""Queries over nested paper records: JSON readers, nested columns, arrays, quality report."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.functions.nested import array_size_default as size_of
from loomstat.functions.nested import primary_by_weight as heaviest
from loomstat.graph import build as B
from loomstat.plans.registry import query
from loomstat.session import new_path, partitions_for
from loomstat.sources import tables as S


def stored_lines(t):
    """Nested papers as JSON Lines plus one malformed line, read back under the declared schema."""
    path = new_path(t.spark, "papers-jsonl")
    with partitions_for(t.spark, t.table("lineitem").count()):
        t.nested_papers.write.json(path)
    t.spark.createDataFrame([('{"id": "broken", "title": ',)], "value string").write.mode("append").text(path)
    return S.scan_json_lines(t.spark, path)


@query("scan_json_lines", """
SELECT p.id, p.title, p.year, p.n_citation, p.venue_raw, p.venue_type, CAST(coalesce(a.n, 0) AS INT) AS n_authors, CAST(coalesce(r.n, 0) AS INT) AS n_refs
FROM p_paper p LEFT JOIN (SELECT paper_id, count(*) AS n FROM p_author GROUP BY paper_id) a ON p.id = a.paper_id
LEFT JOIN (SELECT paper_id, count(*) AS n FROM p_ref GROUP BY paper_id) r ON p.id = r.paper_id
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, 0, 0""")
def scan_json_lines(t):
    return B.flatten_venue(stored_lines(t)).select(
        "id", "title", "year", "n_citation", "venue_raw", "venue_type",
        size_of(F.col("authors")).alias("n_authors"), size_of(F.col("references")).alias("n_refs"),
    )


@query("json_array_to_lines", "SELECT id, title, year, n_citation FROM p_paper")
def json_array_to_lines(t):
    source, target = new_path(t.spark, "papers-array"), new_path(t.spark, "papers-lines")
    with partitions_for(t.spark, t.table("lineitem").count()):
        S.write_json_array(t.nested_papers, source)
    S.json_array_to_lines(t.spark, source, target)
    again = S.json_array_to_lines(t.spark, source, target)  # the second call finds the target and keeps it
    return again.select("id", "title", "year", "n_citation")


@query("flatten_struct", "SELECT id, venue_raw, venue_type FROM p_paper")
def flatten_struct(t):
    return B.flatten_venue(t.nested_papers).select("id", "venue_raw", "venue_type")


@query("primary_by_weight", "SELECT p.id, f.primary_field FROM p_paper p LEFT JOIN primary_fields f ON p.id = f.paper_id")
def primary_by_weight(t):
    return t.nested_papers.select("id", heaviest(F.col("fos")).alias("primary_field"))


@query("array_size_default", """
SELECT p.id, coalesce(a.n, 0) AS n_authors, coalesce(r.n, 0) AS n_refs FROM p_paper p
LEFT JOIN (SELECT paper_id, count(*) AS n FROM p_author GROUP BY paper_id) a ON p.id = a.paper_id
LEFT JOIN (SELECT paper_id, count(*) AS n FROM p_ref GROUP BY paper_id) r ON p.id = r.paper_id""")
def array_size_default(t):
    return t.nested_papers.select(
        "id", size_of(F.col("authors")).cast("bigint").alias("n_authors"),
        size_of(F.col("references")).cast("bigint").alias("n_refs"),
    )


@query("explode_nested", """
SELECT paper_id, 'author' AS kind, author_id AS value FROM p_author WHERE paper_id IN (SELECT id FROM p_paper)
UNION ALL SELECT paper_id, 'reference', ref_id FROM p_ref WHERE paper_id IN (SELECT id FROM p_paper)""")
def explode_nested(t):
    nested = t.nested_papers
    authors = B.explode_authors(nested).select("paper_id", F.lit("author").alias("kind"), F.col("author_id").alias("value"))
    references = B.explode_references(nested)
    return authors.union(references.select("paper_id", F.lit("reference"), "ref_id"))


@query("quality_report", """
SELECT count(*) AS total_papers, count(*) FILTER (WHERE title IS NULL) AS null_title, count(*) FILTER (WHERE a.n IS NULL) AS null_authors,
  count(*) FILTER (WHERE venue_raw IS NULL OR trim(venue_raw) = '') AS unknown_venue,
  count(*) FILTER (WHERE f.primary_field IS NULL) AS null_field, count(*) FILTER (WHERE r.n IS NULL) AS null_references,
  round(avg(coalesce(r.n, 0)), 2) AS avg_refs, round(avg(coalesce(a.n, 0)), 2) AS avg_authors
FROM p_paper p LEFT JOIN (SELECT paper_id, count(*) AS n FROM p_author GROUP BY paper_id) a ON p.id = a.paper_id
LEFT JOIN (SELECT paper_id, count(*) AS n FROM p_ref GROUP BY paper_id) r ON p.id = r.paper_id
LEFT JOIN primary_fields f ON p.id = f.paper_id""")
def quality_report(t):
    return B.quality_report(t.nested_papers)
