"""Graphs derived from a graph: co-author projection, triangles, field scope, co-citation, venue loyalty."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.constants import SOCIAL_FIELDS
from loomstat.graph.model import PropertyGraph
from loomstat.graph.overlap import BLOCK, HEAVY, hubs, pairs_within, shared_pairs, top_shared_pairs
from loomstat.graph.paths import bfs_paths, path_counts
from loomstat.session import durable


def coauthor_pairs(wrote: DataFrame, *, author: str = "src", paper: str = "dst", min_shared: int = 2) -> DataFrame:
    """Unordered author pairs ``a < b`` with at least ``min_shared`` papers in common, and how many."""
    return shared_pairs(wrote.select(author, paper).distinct(), item=author, context=paper, min_shared=min_shared)


def coauthor_projection(pairs: DataFrame) -> PropertyGraph:
    """Author graph with one edge per direction of every pair."""
    edges = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst"), F.col("shared")),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst"), F.col("shared")),
    )))
    vertices = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return PropertyGraph(vertices, edges)


def triangle_count(g: PropertyGraph, *, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """``id, triangles`` of every vertex; direction, parallel edges and self-loops are ignored.

    Each edge points from the end of lower degree to the end of higher degree, so no vertex has more than
    sqrt(2 * edges) out-edges and a hub is never paired up with itself. A vertex sends each of its out-neighbours the list
    of those of higher degree, and what the neighbour points to as well closes a triangle, so lists move instead of pairs.
    A vertex that still has many out-edges has its pairs of them made block by block, in many tasks.
    """
    links = (
        g.edges.select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
        .filter(F.col("u") < F.col("v"))
        .distinct()
    )
    links = durable(links, "triangles")
    degree = links.select(F.explode(F.array("u", "v")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("d"))
    ranked = (
        links.join(degree.select(F.col("id").alias("u"), F.struct("d", "id").alias("ru")), "u")
        .join(degree.select(F.col("id").alias("v"), F.struct("d", "id").alias("rv")), "v")
        .select(F.least("ru", "rv").alias("low"), F.greatest("ru", "rv").alias("high"))
    )
    arcs = durable(ranked.select(F.col("low.id").alias("low"), "high"), "arcs")
    ends = arcs.select(F.col("low").alias("context"), F.col("high.id").alias("item"))
    large = hubs(ends, heavy)
    plain = large.isEmpty()
    light = arcs if plain else arcs.join(large.select(F.col("context").alias("low")), "low", "left_anti")
    lists = light.groupBy("low").agg(F.sort_array(F.collect_list("high"))["id"].alias("highs")).withColumn("last", F.size("highs"))
    first = lists.select("low", "highs", "last", F.posexplode("highs").alias("at", "x")).filter(F.col("at") + 1 < F.col("last"))
    behind = first.select("low", "x", F.slice("highs", F.col("at") + 2, F.col("last")).alias("behind"))
    out = arcs.groupBy(F.col("low").alias("x")).agg(F.collect_list("high.id").alias("near"))
    met = behind.join(out, "x").select("low", "x", F.array_intersect("behind", "near").alias("y")).filter(F.size("y") > 0)
    corners = F.concat(
        F.array(*[F.struct(F.col(c).alias("id"), F.size("y").cast("bigint").alias("n")) for c in ("low", "x")]),
        F.transform("y", lambda y: F.struct(y.alias("id"), F.lit(1).cast("bigint").alias("n"))),
    )
    found = met.select(F.inline(corners))
    if not plain:
        wedges = pairs_within(ends, large, block=block).toDF("low", "x", "y")
        closed = wedges.join(links.select(F.col("u").alias("x"), F.col("v").alias("y")), ["x", "y"], "left_semi")
        found = found.unionByName(closed.select(F.explode(F.array("low", "x", "y")).alias("id"), F.lit(1).cast("bigint").alias("n")))
    per_vertex = found.groupBy("id").agg(F.sum("n").alias("triangles"))
    return g.vertices.select("id").join(per_vertex, "id", "left").fillna(0, ["triangles"])


def edges_touching(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with either end among the distinct ``ids``, as two keyed lookups instead of a nested-loop join."""
    hits = {
        "src": ids.select(F.col("id").alias("src"), F.lit(True).alias("src_hit")),
        "dst": ids.select(F.col("id").alias("dst"), F.lit(True).alias("dst_hit")),
    }
    marked = edges.join(hits["src"], "src", "left").join(hits["dst"], "dst", "left")
    return marked.filter(F.col("src_hit").isNotNull() | F.col("dst_hit").isNotNull()).select(*edges.columns)


def core_papers(g: PropertyGraph, fields=SOCIAL_FIELDS) -> DataFrame:
    papers = g.vertices.filter(F.col("node_type") == "paper")
    return papers.filter(F.col("primary_field").isin(list(fields))).select("id")


def scope_subgraph(g: PropertyGraph, fields=SOCIAL_FIELDS) -> PropertyGraph:
    """Papers of the given fields, every edge that touches one of them, and all ends of these edges.

    ``is_core`` tells the papers of the fields from their neighbours.
    """
    core = core_papers(g, fields)
    edges = durable(edges_touching(g.edges, core), "scope")
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    vertices = g.vertices.join(ends, "id", "left_semi").join(core.withColumn("core", F.lit(True)), "id", "left")
    return PropertyGraph(
        vertices.withColumn("is_core", F.coalesce("core", F.lit(False))).drop("core"), edges
    )


def cocitation_pairs(g: PropertyGraph, *, k: int = 10) -> DataFrame:
    """The k pairs of papers most often cited by the same paper, with names and the number of citing papers."""
    cites = g.edges.filter(F.col("rel_type") == "cites").select("src", "dst").distinct()
    best = top_shared_pairs(durable(cites, "cocitation"), item="dst", context="src", k=k)
    names = g.vertices.select("id", "name")
    for side in ("a", "b"):
        named = names.select(F.col("id").alias(side), F.col("name").alias(f"{side}_name"))
        best = named.join(F.broadcast(best), side)  # best holds k rows
    return best.select("a", "b", "a_name", "b_name", "shared").orderBy(F.desc("shared"), "a", "b")


def venue_loyalty(g: PropertyGraph, *, min_papers: int = 2) -> DataFrame:
    """Authors with two or more papers at one venue: ``papers_total`` there, and ``papers_at_venue``, the papers
    that have a partner with a larger id (one fewer).

    Counting per (author, venue) replaces the pairing of an author's papers.
    """
    wrote = g.edges.filter(F.col("rel_type") == "wrote").select(F.col("src").alias("author"), F.col("dst").alias("p"))
    published = g.edges.filter(F.col("rel_type") == "published_in").select(
        F.col("src").alias("p"), F.col("dst").alias("venue")
    )
    return (
        wrote.distinct()
        .join(published.distinct(), "p")
        .groupBy("author", "venue")
        .agg(F.count(F.lit(1)).alias("papers_total"))
        .filter(F.col("papers_total") >= min_papers)
        .withColumn("papers_at_venue", F.col("papers_total") - 1)
    )


def landmarks(g: PropertyGraph, *, k: int = 1, field: str | None = None) -> DataFrame:
    """The k papers with the most citations inside the graph, optionally of one field."""
    cited = g.in_degrees()
    papers = g.vertices if field is None else g.vertices.filter(F.col("primary_field") == field)
    columns = ["id", "name", "primary_field"]
    return cited.join(papers.select(*columns), "id").orderBy(F.desc("in_degree"), "id").limit(k)


def six_degrees(g: PropertyGraph, source_field: str, target: DataFrame, *, max_sources: int | None = None,
                max_length: int = 6, write_paths: bool = True) -> DataFrame:
    """Shortest paths from papers of a field to the target within ``max_length`` hops.

    ``max_sources`` takes the papers with the smallest ids only; None, the default, takes all of them. Without
    ``write_paths`` there is a row per pair with the number of its paths, however many they are.
    """
    sources = g.vertices.filter((F.col("node_type") == "paper") & (F.col("primary_field") == source_field)).select("id")
    if max_sources is not None:
        sources = sources.orderBy("id").limit(max_sources)
    return (bfs_paths if write_paths else path_counts)(g, sources, target, max_length=max_length)
