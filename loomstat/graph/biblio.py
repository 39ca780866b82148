"""Bibliometric queries over a typed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.constants import SOCIAL_FIELDS, TREND_MAX_YEAR
from loomstat.functions.nested import cagr
from loomstat.graph.model import PropertyGraph


def _papers(g: PropertyGraph) -> DataFrame:
    return g.vertices.filter(F.col("node_type") == "paper")


def _edges(g: PropertyGraph, kind: str) -> DataFrame:
    return g.edges.filter(F.col("rel_type") == kind)


def most_cited(g: PropertyGraph) -> DataFrame:
    """Papers by citations inside the graph."""
    cited = PropertyGraph(g.vertices, _edges(g, "cites")).in_degrees()
    return cited.join(_papers(g).select("id", "name", "year", "primary_field"), "id").orderBy(
        F.desc("in_degree"), "id"
    )


def influential_subgraph(g: PropertyGraph, *, min_citations: int = 50) -> PropertyGraph:
    """Papers cited often in general, and the citations among them."""
    papers = PropertyGraph(_papers(g), _edges(g, "cites"))
    return papers.filter_vertices(F.col("n_citation") >= min_citations).drop_isolated_vertices()


def who_cites_field(g: PropertyGraph, field: str) -> DataFrame:
    """Fields whose papers cite papers of ``field``, by citations; the field itself left out."""
    field_of = _papers(g).select("id", "primary_field").filter(F.col("primary_field").isNotNull())
    cited = field_of.filter(F.col("primary_field") == field).select(F.col("id").alias("dst"))
    citing = field_of.filter(F.col("primary_field") != field).withColumnRenamed("id", "src")
    return (
        _edges(g, "cites")
        .join(cited, "dst", "left_semi")
        .join(citing, "src")
        .groupBy(F.col("primary_field").alias("citing_field"))
        .agg(F.count(F.lit(1)).alias("citations"))
    )


def field_growth(g: PropertyGraph, fields=SOCIAL_FIELDS, *, max_year: int = TREND_MAX_YEAR) -> DataFrame:
    """Papers per field and year."""
    papers = _papers(g).filter(F.col("primary_field").isin(list(fields)) & (F.col("year") <= max_year))
    return papers.groupBy("primary_field", "year").agg(F.count(F.lit(1)).alias("n_papers"))


def field_cagr(growth: DataFrame, *, first_year: int = 2010, last_year: int = TREND_MAX_YEAR) -> DataFrame:
    """First-year and last-year papers per field with the compound annual growth between them."""

    def papers_in(year: int):
        return F.coalesce(F.sum(F.when(F.col("year") == year, F.col("n_papers"))), F.lit(0))

    ends = growth.groupBy("primary_field").agg(
        papers_in(first_year).alias("first_count"), papers_in(last_year).alias("last_count")
    )
    growth_rate = cagr(F.col("first_count"), F.col("last_count"), years=last_year - first_year)
    return ends.withColumn("cagr_pct", F.round(growth_rate, 6))


def authors_per_year(g: PropertyGraph, field: str, *, max_year: int = TREND_MAX_YEAR) -> DataFrame:
    """Distinct authors per year in one field."""
    papers = _papers(g).filter((F.col("primary_field") == field) & (F.col("year") <= max_year))
    return (
        _edges(g, "wrote")
        .join(papers.select(F.col("id").alias("dst"), "year"), "dst")
        .groupBy("year")
        .agg(F.count_distinct("src").alias("n_authors"))
    )


def _author_fields(g: PropertyGraph, fields) -> DataFrame:
    """Distinct (author, field) with the number of papers."""
    papers = _papers(g).filter(F.col("primary_field").isin(list(fields)))
    return (
        _edges(g, "wrote")
        .join(papers.select(F.col("id").alias("dst"), "primary_field"), "dst")
        .groupBy(F.col("src").alias("author"), "primary_field")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _field_sets(counted: DataFrame, key: str) -> DataFrame:
    """Per key the number and sorted set of fields and the papers. Input is one row per (key, field), so a set
    holds each of the given fields once at most."""
    return counted.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_fields"),
        F.array_sort(F.collect_list("primary_field")).alias("fields"),
        F.sum("n").alias("n_papers"),
    )


def author_field_sets(g: PropertyGraph, fields=SOCIAL_FIELDS) -> DataFrame:
    return _field_sets(_author_fields(g, fields), "author")


def bridge_authors(g: PropertyGraph, fields=SOCIAL_FIELDS, *, min_fields: int = 2) -> DataFrame:
    """Authors who published in several of the fields."""
    bridges = author_field_sets(g, fields).filter(F.col("n_fields") >= min_fields)
    names = g.vertices.filter(F.col("node_type") == "author").select(F.col("id").alias("author"), "name")
    return bridges.join(names, "author", "left")


def bridge_distribution(bridges: DataFrame) -> DataFrame:
    return bridges.groupBy("n_fields").agg(F.count(F.lit(1)).alias("n_authors"))


def field_pair_bridges(bridges: DataFrame) -> DataFrame:
    """Bridge authors per unordered pair of fields.

    The pairs come from each author's own set, which holds at most the handful of fields of the scope, in one pass.
    """
    left = bridges.select(F.posexplode("fields").alias("position", "field_a"), "fields")
    pairs = left.select("field_a", F.explode(F.expr("slice(fields, position + 2, size(fields))")).alias("field_b"))
    return pairs.groupBy("field_a", "field_b").agg(F.count(F.lit(1)).alias("n_authors"))


def venue_field_sets(g: PropertyGraph, fields=SOCIAL_FIELDS) -> DataFrame:
    papers = _papers(g).filter(F.col("primary_field").isin(list(fields)))
    counted = (
        _edges(g, "published_in")
        .join(papers.select(F.col("id").alias("src"), "primary_field"), "src")
        .groupBy(F.col("dst").alias("venue"), "primary_field")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = g.vertices.filter(F.col("node_type") == "venue").select(F.col("id").alias("venue"), "name")
    return _field_sets(counted, "venue").join(names, "venue", "left")


def venue_diversity(g: PropertyGraph, fields=SOCIAL_FIELDS, *, min_papers: int = 10) -> DataFrame:
    """Fields per venue, for venues with enough papers."""
    return venue_field_sets(g, fields).filter(F.col("n_papers") >= min_papers)


def specialised_venues(diversity: DataFrame) -> DataFrame:
    return diversity.filter(F.col("n_fields") == 1).orderBy(F.desc("n_papers"), "venue")


def field_venues(g: PropertyGraph, field: str) -> DataFrame:
    """Venues by their papers of one field."""
    papers = _papers(g).filter(F.col("primary_field") == field).select(F.col("id").alias("src"))
    names = g.vertices.filter(F.col("node_type") == "venue").select(F.col("id").alias("venue"), "name")
    return (
        _edges(g, "published_in")
        .join(papers, "src", "left_semi")
        .groupBy(F.col("dst").alias("venue"))
        .agg(F.count(F.lit(1)).alias("n_papers"))
        .join(names, "venue", "left")
    )


def papers_with_field(g: PropertyGraph) -> DataFrame:
    return _papers(g).agg(
        F.count(F.lit(1)).alias("total_papers"), F.count("primary_field").alias("with_field")
    )


def dominant_field(members: DataFrame, g: PropertyGraph, *, group: str = "label", top: int = 5) -> DataFrame:
    """The most frequent field of each of the ``top`` largest groups, from one aggregation over all groups."""
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.orderBy(F.desc("size"), group).limit(top)
    fields = (
        members.join(F.broadcast(largest), group)  # ``top`` rows
        .join(_papers(g).select("id", "primary_field"), "id")
        .filter(F.col("primary_field").isNotNull())
        .groupBy(group, "size", "primary_field")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("n"), "primary_field"))
    return fields.groupBy(group, "size").agg(best.alias("best")).select(
        group, "size", F.col("best.primary_field").alias("dominant_field"), (-F.col("best.n")).alias("field_papers")
    )
