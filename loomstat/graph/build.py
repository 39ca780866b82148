"""From paper records to a typed graph: paper, author and venue vertices; wrote, published_in and cites edges.

Ids carry a prefix per vertex type (``P:``, ``A:``, ``V:``), so an author id that equals a paper id stays a
separate vertex.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomstat.constants import MAX_YEAR, MIN_YEAR, UNKNOWN_VENUE
from loomstat.functions.nested import primary_by_weight
from loomstat.functions.text import name_key
from loomstat.graph.model import PropertyGraph
from loomstat.operators.rows import dedupe_rows
from loomstat.session import durable

PAPER, AUTHOR, VENUE = "P:", "A:", "V:"
FIRST = "__first"


@dataclass(frozen=True)
class PaperTables:
    """Flat paper data: papers (with ``venue_key``), (paper_id, author_id, author_name), (paper_id, ref_id) and
    (paper_id, primary_field). ``scoped`` tells that authors and references are those of the papers only."""

    papers: DataFrame
    authors: DataFrame
    references: DataFrame
    primary_fields: DataFrame
    scoped: bool = False

    def stored(self) -> "PaperTables":
        """The same tables written once, for builds that read each of them several times.

        As all authors of a paper are in one place then, the first row of each author of it is marked there.
        """
        papers = durable(self.papers, "papers")
        pair = Window.partitionBy("paper_id", "author_id").orderBy("author_name")
        authors = in_scope(self.authors, papers).select("paper_id", "author_id", "author_name", (F.row_number().over(pair) == 1).alias(FIRST))
        return PaperTables(
            papers,
            durable(authors, "authors"),
            durable(in_scope(self.references, papers), "references"),
            durable(self.primary_fields, "primary-fields"),
            scoped=True,
        )

    def own_authors(self) -> DataFrame:
        return self.authors if self.scoped else in_scope(self.authors, self.papers)

    def own_references(self) -> DataFrame:
        return self.references if self.scoped else in_scope(self.references, self.papers)


def cast_papers(papers: DataFrame) -> DataFrame:
    """Year and citation count as numbers; unreadable text becomes null."""
    return papers.withColumns(
        {"year": F.col("year").try_cast("int"), "n_citation": F.col("n_citation").try_cast("bigint")}
    )


def scope_filter(papers: DataFrame, *, min_year: int = MIN_YEAR, max_year: int = MAX_YEAR) -> DataFrame:
    """Papers with an id whose year lies in the scope (a null year does not)."""
    return papers.filter(F.col("id").isNotNull() & F.col("year").between(min_year, max_year))


def prepare_papers(papers: DataFrame, *, min_year: int = MIN_YEAR, max_year: int = MAX_YEAR) -> DataFrame:
    """Cast, scope and de-duplicate flat papers (``venue_raw``, ``venue_type``) and add the venue key."""
    scoped = scope_filter(cast_papers(papers), min_year=min_year, max_year=max_year)
    return dedupe_rows(scoped, ["id"]).withColumn("venue_key", name_key(F.col("venue_raw"), UNKNOWN_VENUE))


def flatten_venue(nested: DataFrame) -> DataFrame:
    """Nested records with the venue struct turned into ``venue_raw`` and ``venue_type``."""
    return nested.withColumns({"venue_raw": F.col("venue.raw"), "venue_type": F.col("venue.type")})


def explode_authors(nested: DataFrame) -> DataFrame:
    return nested.select(F.col("id").alias("paper_id"), F.inline("authors")).select(
        "paper_id", F.col("id").alias("author_id"), F.col("name").alias("author_name"), "org"
    )


def explode_references(nested: DataFrame) -> DataFrame:
    return nested.select(F.col("id").alias("paper_id"), F.explode("references").alias("ref_id"))


def tables_from_nested(nested: DataFrame, *, min_year: int = MIN_YEAR, max_year: int = MAX_YEAR) -> PaperTables:
    """Flat tables of nested paper records. A long paper may come as several records with the same id."""
    scoped = scope_filter(cast_papers(nested), min_year=min_year, max_year=max_year)
    flat = flatten_venue(scoped).select("id", "title", "year", "n_citation", "venue_raw", "venue_type")
    papers = dedupe_rows(flat, ["id"]).withColumn("venue_key", name_key(F.col("venue_raw"), UNKNOWN_VENUE))
    fields = scoped.select(F.col("id").alias("paper_id"), F.explode("fos").alias("entry")).select(
        "paper_id", "entry.name", F.col("entry.w").alias("w")
    )
    return PaperTables(papers, explode_authors(scoped), explode_references(scoped), heaviest_field(fields))


def heaviest_field(fields: DataFrame) -> DataFrame:
    """Field of the largest weight per paper; unreadable weights come last, ties go to the smallest name."""
    weight = F.coalesce(-F.col("w").try_cast("double"), F.lit(float("inf")))
    best = F.min(F.struct(weight.alias("order"), F.col("name")))
    return fields.groupBy("paper_id").agg(best["name"].alias("primary_field"))


def with_primary_field(nested: DataFrame) -> DataFrame:
    return nested.withColumn("primary_field", primary_by_weight(F.col("fos")))


def _prefixed(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.trim(F.col(column)))


def build_paper_vertices(tables: PaperTables) -> DataFrame:
    fields = tables.primary_fields.withColumnRenamed("paper_id", "id")
    return tables.papers.join(fields, "id", "left").select(
        _prefixed(PAPER, "id").alias("id"),
        F.col("title").alias("name"),
        F.lit("paper").alias("node_type"),
        "year",
        "n_citation",
        "venue_key",
        "primary_field",
    )


def in_scope(rows: DataFrame, papers: DataFrame, key: str = "paper_id") -> DataFrame:
    """Rows whose ``key`` is a paper. Ids shrink so much on disk that the planner would broadcast millions of them."""
    return rows.join(papers.select(F.col("id").alias(key)).hint("merge"), key, "left_semi")


def most_frequent(rows: DataFrame, key: str, *values: str) -> DataFrame:
    """Per key the most frequent combination of ``values``; ties go to the smallest, nulls last.

    Two partial aggregates instead of a window: no key's rows ever meet in one task unaggregated.
    """
    counted = rows.groupBy(key, *values).agg(F.count(F.lit(1)).alias("n"))
    order = [(-F.col("n")).alias("n")]
    for value in values:
        order += [F.col(value).isNull().alias(f"{value}_missing"), F.col(value)]
    best = F.min(F.struct(*order))
    return counted.groupBy(key).agg(best.alias("best")).select(key, *[F.col(f"best.{value}") for value in values])


def representative_name(authors: DataFrame) -> DataFrame:
    return most_frequent(authors, "author_id", "author_name")


def venue_quality_filter(venues: DataFrame, key: str = "venue_key", *, min_length: int = 4) -> DataFrame:
    """Venue keys that can be real names: long enough, with a Latin letter, not led by a mark, digit or blank."""
    value = F.col(key)
    return venues.filter(
        (F.length(value) >= min_length) & value.rlike(r"^[^(#0-9\s]") & value.rlike("[a-z]")
    )


def known_venues(papers: DataFrame) -> DataFrame:
    return venue_quality_filter(papers.filter(F.col("venue_key") != UNKNOWN_VENUE))


def representative_venue(papers: DataFrame) -> DataFrame:
    return most_frequent(known_venues(papers), "venue_key", "venue_raw", "venue_type")


def build_author_vertices(tables: PaperTables) -> DataFrame:
    names = representative_name(tables.own_authors())
    return names.select(
        _prefixed(AUTHOR, "author_id").alias("id"),
        F.col("author_name").alias("name"),
        F.lit("author").alias("node_type"),
    )


def build_venue_vertices(tables: PaperTables) -> DataFrame:
    return representative_venue(tables.papers).select(
        _prefixed(VENUE, "venue_key").alias("id"),
        F.col("venue_raw").alias("name"),
        F.lit("venue").alias("node_type"),
        "venue_type",
    )


def build_vertices(tables: PaperTables) -> DataFrame:
    """All three kinds, absent attributes null. The builders give one row per id, so no further shuffle."""
    parts = (build_author_vertices(tables), build_venue_vertices(tables))
    vertices = build_paper_vertices(tables)
    for part in parts:
        vertices = vertices.unionByName(part, allowMissingColumns=True)
    return vertices


def build_wrote_edges(tables: PaperTables) -> DataFrame:
    authors = tables.own_authors()
    pairs = ["author_id", "paper_id"]
    written = authors.filter(FIRST).select(*pairs) if FIRST in authors.columns else authors.select(*pairs).distinct()
    return _edge(written, (AUTHOR, "author_id"), (PAPER, "paper_id"), "wrote")


def build_published_in_edges(tables: PaperTables) -> DataFrame:
    """A venue vertex exists for exactly the keys that pass the quality filter, so the filter replaces a join."""
    return _edge(known_venues(tables.papers), (PAPER, "id"), (VENUE, "venue_key"), "published_in")


def build_cites_edges(tables: PaperTables) -> DataFrame:
    cited = in_scope(tables.own_references(), tables.papers, "ref_id")
    return _edge(cited.select("paper_id", "ref_id").distinct(), (PAPER, "paper_id"), (PAPER, "ref_id"), "cites")


def _edge(rows: DataFrame, source: tuple[str, str], target: tuple[str, str], kind: str) -> DataFrame:
    return rows.select(
        _prefixed(*source).alias("src"), _prefixed(*target).alias("dst"), F.lit(kind).alias("rel_type")
    )


def build_edges(tables: PaperTables) -> DataFrame:
    wrote, published, cites = (
        build_wrote_edges(tables), build_published_in_edges(tables), build_cites_edges(tables)
    )
    return wrote.unionByName(published).unionByName(cites)


def build_graph(tables: PaperTables) -> PropertyGraph:
    return PropertyGraph(build_vertices(tables), build_edges(tables))


def quality_report(nested: DataFrame) -> DataFrame:
    """One row on completeness: papers, missing attributes, average list lengths.

    Records that continue a long paper are counted with it: sizes are summed per id first.
    """
    sizes = flatten_venue(nested).select(
        "id",
        "title",
        name_key(F.col("venue_raw"), UNKNOWN_VENUE).alias("venue_key"),
        F.size("authors").alias("authors"),
        F.size("references").alias("references"),
        F.size("fos").alias("fos"),
    )
    papers = sizes.groupBy("id").agg(
        F.max("title").alias("title"),
        F.max("venue_key").alias("venue_key"),
        *[F.sum(name).alias(name) for name in ("authors", "references", "fos")],
    )

    def missing(name: str):
        return F.count(F.when(F.col(name).isNull(), 1))

    def average(name: str):
        return F.round(F.avg(F.coalesce(F.col(name), F.lit(0))), 2)

    return papers.agg(
        F.count(F.lit(1)).alias("total_papers"),
        missing("title").alias("null_title"),
        missing("authors").alias("null_authors"),
        F.count(F.when(F.col("venue_key") == UNKNOWN_VENUE, 1)).alias("unknown_venue"),
        F.count(F.when(F.coalesce("fos", F.lit(0)) == 0, 1)).alias("null_field"),
        missing("references").alias("null_references"),
        average("references").alias("avg_refs"),
        average("authors").alias("avg_authors"),
    )
