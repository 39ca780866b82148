"""Queries that build the typed graph, run graph algorithms on it and answer bibliometric questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomstat.functions.nested import cagr as growth_rate
from loomstat.graph import biblio as Q
from loomstat.graph import build as B
from loomstat.graph.components import connected_components as components_of
from loomstat.graph.components import group_sizes
from loomstat.graph.model import PropertyGraph
from loomstat.graph.paths import bfs_paths as bfs
from loomstat.graph.paths import landmark_distances as landmark_hops
from loomstat.graph.paths import path_counts as count_paths
from loomstat.graph.paths import distance_histogram
from loomstat.graph.paths import shortest_paths as shortest
from loomstat.graph import projection as P
from loomstat.graph.ranking import label_propagation as propagate
from loomstat.graph.ranking import pagerank as rank
from loomstat.operators.comments import top_per_group
from loomstat.plans.registry import query
from loomstat.plans.views import FIELD_LIST, FIXTURE_FIELDS, FIXTURE_MAX_YEAR, FIXTURE_MIN_YEAR
from loomstat.session import durable, new_path, partitions_for
from loomstat.sources import tables as S

FIELD = FIXTURE_FIELDS[0]
OTHER_FIELD = FIXTURE_FIELDS[1]


def scoped(t) -> PropertyGraph:
    return P.scope_subgraph(t.graph, t.fields)


# Building the graph


@query("scope_filter", "SELECT id, year FROM papers")
def scope_filter(t):
    papers = B.cast_papers(t.view("p_paper"))
    return B.scope_filter(papers, min_year=FIXTURE_MIN_YEAR, max_year=FIXTURE_MAX_YEAR).select("id", "year")


@query("venue_quality_filter", "SELECT DISTINCT venue_key FROM papers WHERE venue_key IN (SELECT venue_key FROM venues)")
def venue_quality_filter(t):
    papers = t.paper_tables.papers.filter(F.col("venue_key") != "unknown_venue")
    return B.venue_quality_filter(papers).select("venue_key").distinct()


@query("build_paper_vertices", "SELECT * FROM paper_vertices")
def build_paper_vertices(t):
    return B.build_paper_vertices(t.paper_tables)


@query("build_author_vertices", "SELECT 'A:' || author_id AS id, author_name AS name, 'author' AS node_type FROM author_names")
def build_author_vertices(t):
    return B.build_author_vertices(t.paper_tables)


@query("representative_name", "SELECT author_id, author_name FROM author_names")
def representative_name(t):
    return B.representative_name(B.in_scope(t.paper_tables.authors, t.paper_tables.papers))


@query("representative_venue", "SELECT venue_key, venue_raw, venue_type FROM venues")
def representative_venue(t):
    return B.representative_venue(t.paper_tables.papers)


@query("build_venue_vertices", "SELECT 'V:' || venue_key AS id, venue_raw AS name, 'venue' AS node_type, venue_type FROM venues")
def build_venue_vertices(t):
    return B.build_venue_vertices(t.paper_tables)


VERTEX_COLUMNS = "id", "name", "node_type", "year", "n_citation", "venue_key", "primary_field", "venue_type"


@query("build_vertices", "SELECT * FROM vertices")
def build_vertices(t):
    return B.build_vertices(t.paper_tables).select(*VERTEX_COLUMNS)


@query("union_by_name_missing", """
SELECT id, name, node_type, CAST(NULL AS VARCHAR) AS venue_type FROM vertices WHERE node_type = 'author'
UNION ALL SELECT id, name, node_type, venue_type FROM vertices WHERE node_type = 'venue'""")
def union_by_name_missing(t):
    tables = t.paper_tables
    return B.build_author_vertices(tables).unionByName(B.build_venue_vertices(tables), allowMissingColumns=True)


@query("build_wrote_edges", "SELECT * FROM wrote")
def build_wrote_edges(t):
    return B.build_wrote_edges(t.paper_tables)


@query("build_published_in_edges", "SELECT * FROM published_in")
def build_published_in_edges(t):
    return B.build_published_in_edges(t.paper_tables)


@query("build_cites_edges", "SELECT * FROM cites")
def build_cites_edges(t):
    return B.build_cites_edges(t.paper_tables)


@query("build_edges", "SELECT * FROM edges")
def build_edges(t):
    return B.build_edges(t.paper_tables)


@query("union_by_name", "SELECT src, dst, rel_type FROM wrote UNION ALL SELECT src, dst, rel_type FROM published_in")
def union_by_name(t):
    wrote, published = (t.graph.edges.filter(F.col("rel_type") == kind) for kind in ("wrote", "published_in"))
    return wrote.unionByName(published.select("rel_type", "dst", "src")).select("src", "dst", "rel_type")


@query("edge_id_trim_check", """
SELECT rel_type, count(*) AS n, count(*) FILTER (WHERE trim(src) <> src) AS trimmed_src,
  count(*) FILTER (WHERE trim(dst) <> dst) AS trimmed_dst FROM edges GROUP BY rel_type""")
def edge_id_trim_check(t):
    changed = {c: F.count(F.when(F.trim(c) != F.col(c), 1)).alias(f"trimmed_{c}") for c in ("src", "dst")}
    return t.graph.edges.groupBy("rel_type").agg(F.count(F.lit(1)).alias("n"), *changed.values())


@query("reload_check", """
SELECT 'vertices' AS table_name, count(*) AS n FROM vertices UNION ALL SELECT 'edges', count(*) FROM edges""")
def reload_check(t):
    paths = {name: new_path(t.spark, name) for name in ("vertices", "edges")}
    S.write_partitioned(t.graph.vertices, paths["vertices"], "node_type")
    S.write_partitioned(t.graph.edges, paths["edges"], "rel_type")
    return S.row_counts({name: S.scan_parquet(t.spark, path) for name, path in paths.items()})


@query("graph_coherence", """
SELECT count(*) AS edges, count(*) FILTER (WHERE src NOT IN (SELECT id FROM vertices)) AS dangling_src,
  count(*) FILTER (WHERE dst NOT IN (SELECT id FROM vertices)) AS dangling_dst FROM edges""")
def graph_coherence(t):
    return t.graph.coherence()


@query("count_distinct_having", """
SELECT author_name, count(DISTINCT author_id) AS n_ids FROM p_author GROUP BY author_name HAVING count(DISTINCT author_id) > 1""")
def count_distinct_having(t):
    names = t.view("p_author").groupBy("author_name").agg(F.count_distinct("author_id").alias("n_ids"))
    return names.filter(F.col("n_ids") > 1).orderBy(F.desc("n_ids"), "author_name")


@query("papers_with_field", "SELECT count(*) AS total_papers, count(primary_field) AS with_field FROM paper_vertices")
def papers_with_field(t):
    return Q.papers_with_field(t.graph)


# Joins


@query("join_left_semi", "SELECT paper_id, ref_id FROM p_ref WHERE ref_id IN (SELECT id FROM papers)")
def join_left_semi(t):
    return B.in_scope(t.references, t.paper_tables.papers, "ref_id").select("paper_id", "ref_id")


@query("join_inner_collision", """
SELECT count(*) AS collisions FROM (SELECT DISTINCT author_id FROM paper_authors) a JOIN papers p ON a.author_id = p.id""")
def join_inner_collision(t):
    papers = t.paper_tables.papers
    authors = B.in_scope(t.paper_tables.authors, papers).select("author_id").distinct()
    return authors.join(papers, authors.author_id == papers.id).agg(F.count(F.lit(1)).alias("collisions"))


@query("join_inner_using", "SELECT id, n AS in_degree, primary_field FROM cited JOIN paper_vertices USING (id)")
def join_inner_using(t):
    return t.citations.in_degrees().join(t.citations.vertices.select("id", "primary_field"), "id")


@query("join_left_enrich", """
SELECT c.src, c.dst, s.year AS citing_year, d.year AS cited_year FROM cites c
LEFT JOIN vertices s ON c.src = s.id LEFT JOIN vertices d ON c.dst = d.id""")
def join_left_enrich(t):
    years = t.citations.vertices.select("id", "year")
    enriched = t.citations.edges.select("src", "dst")
    for end, name in (("src", "citing_year"), ("dst", "cited_year")):
        enriched = enriched.join(years.select(F.col("id").alias(end), F.col("year").alias(name)), end, "left")
    return enriched


@query("fill_missing_zero", "SELECT p.id, coalesce(c.n, 0) AS in_degree FROM paper_vertices p LEFT JOIN cited c ON p.id = c.id")
def fill_missing_zero(t):
    papers = t.citations.vertices.select("id")
    return papers.join(t.citations.in_degrees(), "id", "left").fillna({"in_degree": 0})


@query("join_self_theta_pairs", "SELECT a, b, shared FROM coauthors")
def join_self_theta_pairs(t):
    return P.coauthor_pairs(t.view("copurchase"), author="author_id", paper="paper_id")


@query("join_semi_or", "SELECT src, dst, rel_type FROM scope_edges")
def join_semi_or(t):
    return P.edges_touching(t.graph.edges, P.core_papers(t.graph, t.fields)).select("src", "dst", "rel_type")


# Degrees, subgraphs, motifs


DEGREES = """
deg AS (SELECT v.id, v.node_type, v.name, coalesce(i.n, 0) + coalesce(o.n, 0) AS degree, coalesce(i.n, 0) AS in_degree,
  coalesce(o.n, 0) AS out_degree FROM vertices v
  LEFT JOIN (SELECT dst, count(*) AS n FROM edges GROUP BY dst) i ON v.id = i.dst
  LEFT JOIN (SELECT src, count(*) AS n FROM edges GROUP BY src) o ON v.id = o.src)"""


@query("degrees", f"WITH {DEGREES} SELECT id, node_type, degree, in_degree, out_degree FROM deg")
def degrees(t):
    return t.graph.degrees().select("id", "node_type", "degree", "in_degree", "out_degree")


@query("node_type_summary", f"""
WITH {DEGREES} SELECT node_type, count(*) AS n, round(avg(degree), 2) AS avg_degree, quantile_disc(degree, 0.5) AS median_degree,
  max(degree) AS max_degree FROM deg GROUP BY node_type""")
def node_type_summary(t):
    return t.graph.degrees().groupBy("node_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("degree"), 2).alias("avg_degree"),
        F.percentile_approx("degree", 0.5).alias("median_degree"),
        F.max("degree").alias("max_degree"),
    )


@query("top5_per_node_type", f"""
WITH {DEGREES} SELECT node_type, id, degree, CAST(position AS INT) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY node_type ORDER BY degree DESC, id) AS position FROM deg) x WHERE position <= 5""")
def top5_per_node_type(t):
    ranked = top_per_group(t.graph.degrees(), "node_type", F.desc("degree"), F.col("id"), k=5)
    return ranked.select("node_type", "id", "degree", "position")


@query("degree_distribution", f"WITH {DEGREES} SELECT degree, count(*) AS n FROM deg GROUP BY degree")
def degree_distribution(t):
    return t.graph.degrees().groupBy("degree").agg(F.count(F.lit(1)).alias("n")).orderBy("degree")


@query("graph_density", """
SELECT n_vertices, n_edges, round(n_edges / (CAST(n_vertices AS DOUBLE) * (n_vertices - 1)), 12) AS density
FROM (SELECT count(*) AS n_vertices FROM vertices) a CROSS JOIN (SELECT count(*) AS n_edges FROM edges) b""")
def graph_density(t):
    return t.graph.density().withColumn("density", F.round("density", 12))


@query("subgraph_filter", """
WITH kept AS (SELECT id FROM paper_vertices WHERE n_citation >= 50),
  links AS (SELECT src, dst FROM cites WHERE src IN (SELECT id FROM kept) AND dst IN (SELECT id FROM kept))
SELECT src, dst FROM links""")
def subgraph_filter(t):
    g = t.graph.filter_edges("rel_type = 'cites'").filter_vertices("node_type = 'paper' AND n_citation >= 50")
    return g.drop_isolated_vertices().edges.select("src", "dst")


@query("motif_find", """
SELECT w.src AS author, w.dst AS paper, p.dst AS venue, v.year FROM wrote w JOIN published_in p ON w.dst = p.src
JOIN vertices v ON v.id = w.dst""")
def motif_find(t):
    kinds = {"w": F.col("rel_type") == "wrote", "p": F.col("rel_type") == "published_in"}
    found = t.graph.find("(a)-[w]->(b); (b)-[p]->(c)", kinds, vertices=("b",))
    return found.select(
        F.col("a.id").alias("author"), F.col("b.id").alias("paper"), F.col("c.id").alias("venue"), "b.year"
    )


@query("count_distinct_struct", """
SELECT p.dst AS venue, count(DISTINCT w.src) AS n_authors FROM wrote w JOIN published_in p ON w.dst = p.src GROUP BY p.dst""")
def count_distinct_struct(t):
    kinds = {"w": F.col("rel_type") == "wrote", "p": F.col("rel_type") == "published_in"}
    found = t.graph.find([("a", "w", "b"), ("b", "p", "c")], kinds, vertices=("a",))
    return found.groupBy(F.col("c.id").alias("venue")).agg(F.count_distinct("a").alias("n_authors"))


@query("cocitation_pairs", """
SELECT x.a, x.b, va.name AS a_name, vb.name AS b_name, x.shared FROM (
  SELECT c1.dst AS a, c2.dst AS b, count(*) AS shared FROM cites c1 JOIN cites c2 ON c1.src = c2.src AND c1.dst < c2.dst
  GROUP BY c1.dst, c2.dst ORDER BY shared DESC, a, b LIMIT 10) x
JOIN vertices va ON x.a = va.id JOIN vertices vb ON x.b = vb.id""")
def cocitation_pairs(t):
    return P.cocitation_pairs(t.graph, k=10)


@query("venue_loyalty", """
SELECT w.src AS author, p.dst AS venue, count(*) AS papers_total, count(*) - 1 AS papers_at_venue
FROM wrote w JOIN published_in p ON w.dst = p.src GROUP BY w.src, p.dst HAVING count(*) >= 2""")
def venue_loyalty(t):
    return P.venue_loyalty(t.graph)


@query("scope_subgraph", "SELECT id, node_type, is_core FROM scope_vertices")
def scope_subgraph(t):
    return scoped(t).vertices.select("id", "node_type", "is_core")


@query("landmark_select", f"""
SELECT id, name, primary_field, n AS in_degree FROM cited JOIN paper_vertices USING (id)
WHERE primary_field = '{FIELD}' ORDER BY in_degree DESC, id LIMIT 3""")
def landmark_select(t):
    return P.landmarks(t.citations, k=3, field=FIELD).select("id", "name", "primary_field", "in_degree")


@query("coauthor_projection", """
SELECT a AS src, b AS dst, shared FROM coauthors UNION ALL SELECT b, a, shared FROM coauthors""")
def coauthor_projection(t):
    pairs = durable(P.coauthor_pairs(t.view("copurchase"), author="author_id", paper="paper_id"), "pairs")
    return P.coauthor_projection(pairs).edges


@query("triangle_count", """
WITH tri AS (SELECT x.a AS p, x.b AS q, y.b AS r FROM coauthors x JOIN coauthors y ON x.b = y.a
  JOIN coauthors z ON z.a = x.a AND z.b = y.b),
corners AS (SELECT p AS id FROM tri UNION ALL SELECT q FROM tri UNION ALL SELECT r FROM tri)
SELECT v.id, count(c.id) AS triangles FROM (SELECT a AS id FROM coauthors UNION SELECT b FROM coauthors) v
LEFT JOIN corners c ON v.id = c.id GROUP BY v.id""")
def triangle_count(t):
    pairs = durable(P.coauthor_pairs(t.view("copurchase"), author="author_id", paper="paper_id"), "pairs")
    return P.triangle_count(P.coauthor_projection(pairs))


# Iterative algorithms on the whole citation graph


def pagerank_sql(vertices: str, edges: str, rounds: int = 5) -> str:
    """Unrolled rounds as further CTEs; the result is ``pr(id, pagerank)``."""
    parts = [
        f"od AS (SELECT src, count(*) AS n FROM {edges} GROUP BY src)",
        f"w AS (SELECT e.src, e.dst, 1.0 / CAST(od.n AS DOUBLE) AS s FROM {edges} e JOIN od ON e.src = od.src)",
        f"r0 AS (SELECT id, CAST(1.0 AS DOUBLE) AS r FROM {vertices})",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"r{i} AS (SELECT v.id, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(m.s, 0) AS r FROM {vertices} v LEFT JOIN ("
            f"SELECT w.dst, sum(r.r * w.s) AS s FROM w JOIN r{i - 1} r ON w.src = r.id GROUP BY w.dst) m ON v.id = m.dst)"
        )
    parts.append(
        f"pr AS (SELECT id, r * (SELECT count(*) FROM r{rounds}) / (SELECT sum(r) FROM r{rounds}) AS pagerank FROM r{rounds})"
    )
    return ",\n".join(parts)


@query("pagerank", f"WITH {pagerank_sql('paper_vertices', 'cites')} SELECT id, round(pagerank, 6) AS pagerank FROM pr")
def pagerank(t):
    return rank(t.citations).select("id", F.round("pagerank", 6).alias("pagerank"))


@query("pagerank_vs_degree", f"""
WITH {pagerank_sql('paper_vertices', 'cites')}
SELECT pr.id, round(pagerank, 6) AS pagerank, coalesce(c.n, 0) AS in_degree, v.n_citation
FROM pr JOIN paper_vertices v ON pr.id = v.id LEFT JOIN cited c ON pr.id = c.id""")
def pagerank_vs_degree(t):
    g = t.citations
    ranked = rank(g)
    with partitions_for(t.spark, g.edges.count()):
        rows = ranked.join(g.in_degrees(), "id", "left").join(g.vertices.select("id", "n_citation"), "id")
        return durable(
            rows.fillna(0, ["in_degree"]).select("id", F.round("pagerank", 6).alias("pagerank"), "in_degree", "n_citation"),
            "rank-and-degree",
        )


@query("field_top_papers", f"""
WITH {pagerank_sql('paper_vertices', 'cites')}
SELECT v.id, v.name, v.year, round(pagerank, 6) AS pagerank FROM pr JOIN paper_vertices v ON pr.id = v.id
WHERE v.primary_field = '{FIELD}' ORDER BY round(pagerank, 6) DESC, v.id LIMIT 10""")
def field_top_papers(t):
    papers = t.citations.vertices.filter(F.col("primary_field") == FIELD).select("id", "name", "year")
    ranked = rank(t.citations).join(papers, "id").select("id", "name", "year", F.round("pagerank", 6).alias("pagerank"))
    return ranked.orderBy(F.desc("pagerank"), "id").limit(10)


COMPONENTS = """
sym AS (SELECT src AS a, dst AS b FROM cites UNION SELECT dst, src FROM cites),
cc(id, component) USING KEY (id) AS (
  SELECT id, id FROM paper_vertices
  UNION
  SELECT s.b, min(cc.component) FROM cc JOIN sym s ON s.a = cc.id JOIN recurring.cc r ON r.id = s.b
  WHERE cc.component < r.component GROUP BY s.b)"""


@query("connected_components", f"WITH RECURSIVE {COMPONENTS} SELECT id, component FROM cc")
def connected_components(t):
    return components_of(t.citations)


@query("component_sizes", f"""
WITH RECURSIVE {COMPONENTS}
SELECT component, count(*) AS size, round(count(*) * 100.0 / (SELECT count(*) FROM cc), 6) AS share_pct,
  (SELECT count(DISTINCT component) FROM cc) AS groups FROM cc GROUP BY component""")
def component_sizes(t):
    return group_sizes(durable(components_of(t.citations), "components"), "component")


def propagation_sql(vertices: str, edges: str, rounds: int = 5) -> str:
    parts = [
        f"sym AS (SELECT src AS a, dst AS b FROM {edges} UNION ALL SELECT dst, src FROM {edges})",
        f"l0 AS (SELECT id, id AS label FROM {vertices})",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"l{i} AS (SELECT p.id, coalesce(m.label, p.label) AS label FROM l{i - 1} p LEFT JOIN (SELECT id, label FROM ("
            f"SELECT s.b AS id, q.label, row_number() OVER (PARTITION BY s.b ORDER BY count(*) DESC, q.label) AS rn "
            f"FROM sym s JOIN l{i - 1} q ON s.a = q.id GROUP BY s.b, q.label) z WHERE rn = 1) m ON p.id = m.id)"
        )
    return ",\n".join(parts) + f",\nlp AS (SELECT id, label FROM l{rounds})"


@query("label_propagation", f"WITH {propagation_sql('paper_vertices', 'cites')} SELECT id, label FROM lp")
def label_propagation(t):
    return propagate(t.citations)


@query("community_dominant_field", f"""
WITH {propagation_sql('paper_vertices', 'cites')},
big AS (SELECT label, count(*) AS size FROM lp GROUP BY label ORDER BY size DESC, label LIMIT 5)
SELECT label, size, primary_field AS dominant_field, n AS field_papers FROM (
  SELECT b.label, b.size, v.primary_field, count(*) AS n,
    row_number() OVER (PARTITION BY b.label ORDER BY count(*) DESC, v.primary_field) AS rn
  FROM big b JOIN lp ON lp.label = b.label JOIN paper_vertices v ON v.id = lp.id WHERE v.primary_field IS NOT NULL
  GROUP BY b.label, b.size, v.primary_field) x WHERE rn = 1""")
def community_dominant_field(t):
    return Q.dominant_field(durable(propagate(t.citations), "communities"), t.citations, top=5)


LANDMARK = "SELECT id FROM cited ORDER BY n DESC, id LIMIT 1"


@query("bfs_paths", f"""
WITH RECURSIVE target AS ({LANDMARK}),
walk(origin, pos, hops, path) AS (
  SELECT v.id, v.id, 0, v.id FROM paper_vertices v WHERE v.primary_field = '{OTHER_FIELD}'
  UNION ALL
  SELECT w.origin, c.dst, w.hops + 1, w.path || '>' || c.dst FROM walk w JOIN cites c ON w.pos = c.src
  WHERE w.hops < 10 AND NOT EXISTS (SELECT 1 FROM walk d WHERE d.pos IN (SELECT id FROM target)))
SELECT origin AS from_id, pos AS to_id, hops, path FROM walk WHERE pos IN (SELECT id FROM target)""")
def bfs_paths(t):
    sources = t.citations.vertices.filter(F.col("primary_field") == OTHER_FIELD).select("id")
    target = P.landmarks(t.citations, k=1).select("id")
    paths = bfs(t.citations, sources, target, max_length=10)
    return paths.withColumn("path", F.concat_ws(">", "path"))


DISTANCES = """
dist(id, landmark, hops) AS (
  SELECT id, id, 0 FROM marks
  UNION
  SELECT c.src, d.landmark, d.hops + 1 FROM dist d JOIN cites c ON c.dst = d.id)"""


@query("shortest_paths", f"""
WITH RECURSIVE marks AS (SELECT id FROM cited ORDER BY n DESC, id LIMIT 3), {DISTANCES}
SELECT v.id, coalesce(string_agg(d.landmark || '=' || d.hops, ',' ORDER BY d.landmark), '') AS distances FROM paper_vertices v
LEFT JOIN (SELECT id, landmark, min(hops) AS hops FROM dist GROUP BY id, landmark) d ON v.id = d.id GROUP BY v.id""")
def shortest_paths(t):
    distances = shortest(t.citations, P.landmarks(t.citations, k=3).select("id"))
    entries = F.transform(F.map_entries("distances"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return distances.select("id", F.array_join(F.array_sort(entries), ",").alias("distances"))


@query("map_get", f"""
WITH RECURSIVE marks AS ({LANDMARK}), {DISTANCES}
SELECT hops, count(*) AS n_vertices FROM (SELECT id, min(hops) AS hops FROM dist GROUP BY id) x WHERE hops > 0 GROUP BY hops""")
def map_get(t):
    mark = P.landmarks(t.citations, k=1).select("id")
    landmark = mark.first()["id"]
    return distance_histogram(shortest(t.citations, mark), landmark)


@query("six_degrees", f"""
WITH RECURSIVE marks AS (SELECT id FROM cited JOIN paper_vertices USING (id) WHERE primary_field = '{FIELD}' ORDER BY n DESC, id LIMIT 1),
{DISTANCES}
SELECT v.id AS from_id, d.landmark AS to_id, min(d.hops) AS hops FROM paper_vertices v JOIN dist d ON d.id = v.id
WHERE v.primary_field = '{OTHER_FIELD}' AND d.hops <= 6 GROUP BY v.id, d.landmark
QUALIFY min(d.hops) = min(min(d.hops)) OVER ()""")
def six_degrees(t):
    g = t.citations
    target = P.landmarks(g, k=1, field=FIELD).select("id")
    return P.six_degrees(g, OTHER_FIELD, target, max_sources=None, write_paths=False).select("from_id", "to_id", "hops")


@query("path_counts", f"""
WITH RECURSIVE target AS ({LANDMARK}),
walk(origin, pos, hops, path) AS (
  SELECT v.id, v.id, 0, v.id FROM paper_vertices v WHERE v.primary_field = '{OTHER_FIELD}'
  UNION ALL
  SELECT w.origin, c.dst, w.hops + 1, w.path || '>' || c.dst FROM walk w JOIN cites c ON w.pos = c.src
  WHERE w.hops < 10 AND NOT EXISTS (SELECT 1 FROM walk d WHERE d.pos IN (SELECT id FROM target)))
SELECT origin AS from_id, pos AS to_id, hops, CAST(count(DISTINCT path) AS BIGINT) AS n_paths FROM walk
WHERE pos IN (SELECT id FROM target) GROUP BY origin, pos, hops""")
def path_counts(t):
    """As ``bfs_paths``, but how many paths each pair has."""
    sources = t.citations.vertices.filter(F.col("primary_field") == OTHER_FIELD).select("id")
    counts = count_paths(t.citations, sources, P.landmarks(t.citations, k=1).select("id"), max_length=10)
    return counts.withColumn("n_paths", F.col("n_paths").cast("bigint"))


@query("many_landmarks", """
WITH marks AS (SELECT id FROM cited ORDER BY n DESC, id LIMIT 70), links AS (SELECT DISTINCT src, dst FROM cites),
one AS (SELECT c.src AS id, m.id AS landmark FROM links c JOIN marks m ON c.dst = m.id),
two AS (SELECT c.src AS id, o.landmark FROM links c JOIN one o ON c.dst = o.id),
every AS (SELECT id, id AS landmark, 0 AS hops FROM marks UNION ALL SELECT id, landmark, 1 FROM one UNION ALL SELECT id, landmark, 2 FROM two)
SELECT id, landmark, min(hops) AS hops FROM every GROUP BY id, landmark""")
def many_landmarks(t):
    """Papers within two hops of 70 landmarks, more than a search word holds, in one search."""
    return landmark_hops(t.citations, P.landmarks(t.citations, k=70).select("id"), max_hops=2)


# Bibliometric queries


@query("most_cited", "SELECT id, name, year, primary_field, n AS in_degree FROM cited JOIN paper_vertices USING (id)")
def most_cited(t):
    return Q.most_cited(t.graph).select("id", "name", "year", "primary_field", "in_degree")


@query("influential_subgraph", """
WITH kept AS (SELECT id, n_citation FROM paper_vertices WHERE n_citation >= 50),
  links AS (SELECT src, dst FROM cites WHERE src IN (SELECT id FROM kept) AND dst IN (SELECT id FROM kept))
SELECT id, n_citation FROM kept WHERE id IN (SELECT src FROM links UNION SELECT dst FROM links)""")
def influential_subgraph(t):
    return Q.influential_subgraph(t.graph, min_citations=50).vertices.select("id", "n_citation")


@query("who_cites_field", f"""
SELECT s.primary_field AS citing_field, count(*) AS citations FROM cites c JOIN paper_vertices s ON c.src = s.id
JOIN paper_vertices d ON c.dst = d.id WHERE d.primary_field = '{FIELD}' AND s.primary_field <> '{FIELD}' GROUP BY s.primary_field""")
def who_cites_field(t):
    return Q.who_cites_field(t.graph, FIELD).orderBy(F.desc("citations"), "citing_field")


GROWTH = f"""
SELECT primary_field, year, count(*) AS n_papers FROM paper_vertices
WHERE primary_field IN ({FIELD_LIST}) AND year <= {FIXTURE_MAX_YEAR} GROUP BY primary_field, year"""


@query("field_growth", GROWTH)
def field_growth(t):
    return Q.field_growth(t.graph, t.fields, max_year=FIXTURE_MAX_YEAR).orderBy("primary_field", "year")


FIRST, LAST = FIXTURE_MIN_YEAR, FIXTURE_MAX_YEAR
CAGR = f"""
SELECT primary_field, first_count, last_count, CASE WHEN first_count > 0 AND last_count > 0 THEN
  round((pow(last_count / first_count, 1.0 / {LAST - FIRST}) - 1) * 100, 6) END AS cagr_pct FROM (
  SELECT primary_field, count(*) FILTER (WHERE year = {FIRST}) AS first_count, count(*) FILTER (WHERE year = {LAST}) AS last_count
  FROM paper_vertices WHERE primary_field IN ({FIELD_LIST}) GROUP BY primary_field) x"""


@query("field_cagr", CAGR)
def field_cagr(t):
    growth = Q.field_growth(t.graph, t.fields, max_year=LAST)
    return Q.field_cagr(growth, first_year=FIRST, last_year=LAST)


@query("cagr", """
SELECT venue_key, first_count, last_count, CASE WHEN first_count > 0 AND last_count > 0 THEN
  round((pow(last_count / first_count, 0.25) - 1) * 100, 6) END AS cagr_pct FROM (
  SELECT venue_key, count(*) FILTER (WHERE year = 1996) AS first_count, count(*) FILTER (WHERE year = 2000) AS last_count
  FROM papers GROUP BY venue_key) x""")
def cagr(t):
    in_year = {n: F.count(F.when(F.col("year") == y, 1)).alias(n) for n, y in (("first_count", FIRST), ("last_count", LAST))}
    ends = t.paper_tables.papers.groupBy("venue_key").agg(*in_year.values())
    rate = growth_rate(F.col("first_count"), F.col("last_count"), years=LAST - FIRST)
    return ends.withColumn("cagr_pct", F.round(rate, 6))


@query("authors_per_year", f"""
SELECT v.year, count(DISTINCT w.src) AS n_authors FROM wrote w JOIN paper_vertices v ON w.dst = v.id
WHERE v.primary_field = '{FIELD}' GROUP BY v.year""")
def authors_per_year(t):
    return Q.authors_per_year(t.graph, FIELD, max_year=FIXTURE_MAX_YEAR).orderBy("year")


AUTHOR_FIELDS = f"""
af AS (SELECT w.src AS author, count(DISTINCT v.primary_field) AS n_fields,
  string_agg(DISTINCT v.primary_field, '|' ORDER BY v.primary_field) AS fields, count(*) AS n_papers
  FROM wrote w JOIN paper_vertices v ON w.dst = v.id WHERE v.primary_field IN ({FIELD_LIST}) GROUP BY w.src)"""


def joined(sets):
    return sets.withColumn("fields", F.array_join("fields", "|"))


@query("collect_distinct_set", f"WITH {AUTHOR_FIELDS} SELECT author, n_fields, fields, n_papers FROM af")
def collect_distinct_set(t):
    return joined(Q.author_field_sets(t.graph, t.fields))


@query("bridge_authors", f"""
WITH {AUTHOR_FIELDS} SELECT author, v.name, n_fields, fields, n_papers FROM af JOIN vertices v ON af.author = v.id WHERE n_fields >= 2""")
def bridge_authors(t):
    return joined(Q.bridge_authors(t.graph, t.fields)).orderBy(F.desc("n_fields"), F.desc("n_papers"), "author")


@query("bridge_distribution", f"WITH {AUTHOR_FIELDS} SELECT n_fields, count(*) AS n_authors FROM af WHERE n_fields >= 2 GROUP BY n_fields")
def bridge_distribution(t):
    return Q.bridge_distribution(Q.author_field_sets(t.graph, t.fields).filter("n_fields >= 2")).orderBy("n_fields")


@query("field_pair_bridges", f"""
WITH d AS (SELECT DISTINCT w.src AS author, v.primary_field AS f FROM wrote w JOIN paper_vertices v ON w.dst = v.id
  WHERE v.primary_field IN ({FIELD_LIST}))
SELECT x.f AS field_a, y.f AS field_b, count(*) AS n_authors FROM d x JOIN d y ON x.author = y.author AND x.f < y.f GROUP BY x.f, y.f""")
def field_pair_bridges(t):
    return Q.field_pair_bridges(Q.author_field_sets(t.graph, t.fields))


@query("array_contains_filter", f"""
WITH {AUTHOR_FIELDS} SELECT author, n_papers FROM af
WHERE '|' || fields || '|' LIKE '%|{FIELD}|%' AND '|' || fields || '|' LIKE '%|{OTHER_FIELD}|%'""")
def array_contains_filter(t):
    sets = Q.author_field_sets(t.graph, t.fields)
    both = F.array_contains("fields", FIELD) & F.array_contains("fields", OTHER_FIELD)
    return sets.filter(both).select("author", "n_papers")


VENUE_FIELDS = f"""
vf AS (SELECT p.dst AS venue, count(DISTINCT v.primary_field) AS n_fields,
  string_agg(DISTINCT v.primary_field, '|' ORDER BY v.primary_field) AS fields, count(*) AS n_papers
  FROM published_in p JOIN paper_vertices v ON p.src = v.id WHERE v.primary_field IN ({FIELD_LIST}) GROUP BY p.dst)"""


@query("venue_diversity", f"""
WITH {VENUE_FIELDS} SELECT venue, v.name, n_fields, fields, n_papers FROM vf JOIN vertices v ON vf.venue = v.id WHERE n_papers >= 10""")
def venue_diversity(t):
    return joined(Q.venue_diversity(t.graph, t.fields)).orderBy(F.desc("n_fields"), F.desc("n_papers"), "venue")


@query("specialised_venues", f"""
WITH {VENUE_FIELDS} SELECT venue, v.name, n_papers FROM vf JOIN vertices v ON vf.venue = v.id
WHERE n_papers >= 10 AND n_fields = 1""")
def specialised_venues(t):
    return Q.specialised_venues(Q.venue_diversity(t.graph, t.fields)).select("venue", "name", "n_papers")


@query("field_venues", f"""
SELECT p.dst AS venue, any_value(x.name) AS name, count(*) AS n_papers FROM published_in p JOIN paper_vertices v ON p.src = v.id
JOIN vertices x ON p.dst = x.id WHERE v.primary_field = '{FIELD}' GROUP BY p.dst""")
def field_venues(t):
    return Q.field_venues(t.graph, FIELD).orderBy(F.desc("n_papers"), "venue")
