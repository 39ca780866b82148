"""Test inputs derived by Spark from the supplied tables, lazily per query."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import StructType

from loomstat.graph.build import PaperTables, build_edges, build_vertices, heaviest_field, prepare_papers
from loomstat.graph.model import PropertyGraph
from loomstat.operators.comments import prepare_comments
from loomstat.operators.skew import HEAVY_ROWS, heavy_keys
from loomstat.plans.views import FIXTURE_FIELDS, FIXTURE_MAX_YEAR, FIXTURE_MIN_YEAR, SHARED_VIEWS
from loomstat.session import new_path, partitions_for
from loomstat.sources.tables import write_partitioned

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

# Views whose rows are worked out here with fewer shuffles, and one line in so many that tells which parts are hot.
DERIVED = {"p_ref": "references", "p_author": "authors", "p_field": "paper_fields"}
SAMPLED = 16

_schemas: dict[str, StructType] = {}
_stores: dict[tuple[str, str], tuple[str, str]] = {}


class Inputs:
    """Everything a registered query may read: supplied tables, views over them, the graph built from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        path = f"{self.sf_dir}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def view(self, name: str) -> DataFrame:
        if name in DERIVED:
            return getattr(self, DERIVED[name])
        text = SHARED_VIEWS[name]
        for table in TABLES:
            if f" {table} " in text.replace("\n", " ") + " ":
                self.table(table).createOrReplaceTempView(table)
        return self.spark.sql(text)

    @cached_property
    def raw_comments(self) -> DataFrame:
        return self.view("raw_comments")

    @cached_property
    def comments(self) -> DataFrame:
        return prepare_comments(self.raw_comments)

    @cached_property
    def authors(self) -> DataFrame:
        """``p_author``: who wrote what. Lines are moved once, as numbers, to where their paper is; names come after that."""
        paper = F.col("l_orderkey").cast("string")
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey").repartition(paper).select(paper.alias("paper_id"), "l_suppkey")
        people = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
        named = lines.join(people, "l_suppkey").join(self.table("nation").select("n_nationkey", "n_name"), "n_nationkey")
        short = (F.col("l_suppkey") % 40).cast("string")
        fifth = F.col("paper_id").cast("bigint") % 5 == 0
        return named.select(
            "paper_id", F.col("l_suppkey").cast("string").alias("author_id"),
            F.when(fifth, F.concat(F.lit("S. "), short)).otherwise(F.concat(F.lit("Supplier "), short)).alias("author_name"),
            F.col("n_name").alias("org"),
        ).distinct()

    @cached_property
    def paper_fields(self) -> DataFrame:
        """``p_field``: weights of the fields of each paper, and all of a paper in one place for what follows."""
        paper = F.col("l_orderkey").cast("string")
        parts = self.table("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        lines = self.table("lineitem").select("l_orderkey", "l_partkey", "l_quantity").join(parts, "l_partkey")
        placed = lines.select("l_orderkey", "p_brand", "l_quantity").repartition(paper)
        by_field = placed.select(paper.alias("paper_id"), F.col("p_brand").alias("name"), "l_quantity").groupBy("paper_id", "name")
        return by_field.agg(F.expr("sum(l_quantity) / 1000.0").alias("w"))

    @cached_property
    def references(self) -> DataFrame:
        """Each order cites the order before it that contained the same part.

        A part may sit in a third of all orders. For such parts the order before is looked up within (part, month), and
        only the first order of a month needs the last one of an earlier month, found among one row per part and month.
        All others are looked up per part. A sample tells the two apart, which changes where rows go, not what is found.
        """
        orders = self.table("orders").select("o_orderkey", "o_orderdate")
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
        hot = heavy_keys(lines.sample(1 / SAMPLED, seed=1), "l_partkey", min_rows=HEAVY_ROWS // (2 * SAMPLED)) if lines.count() >= HEAVY_ROWS else []
        bought = lines.repartition("o_orderkey").distinct().join(orders, "o_orderkey")
        part = F.col("l_partkey")
        spread = part.isin([key for key in hot if key is not None]) | (part.isNull() if None in hot else F.lit(False))
        by = ["l_partkey"]
        if hot:
            bought = bought.withColumn("month", F.when(spread, F.trunc("o_orderdate", "month")))
            by = ["l_partkey", "month"]
        near = Window.partitionBy(*by).orderBy("o_orderdate", "o_orderkey")
        before = F.lag("o_orderkey").over(near).alias("before")
        pairs = bought.select("o_orderkey", before).filter(F.col("before").isNotNull())
        if hot:
            whole = near.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            months = bought.filter(spread).select("l_partkey", "month", "o_orderkey", before, F.last("o_orderkey").over(whole).alias("last"))
            earlier = F.lag("last").over(Window.partitionBy("l_partkey").orderBy("month")).alias("before")
            first = months.filter(F.col("before").isNull()).select("o_orderkey", earlier)
            pairs = pairs.union(first.filter(F.col("before").isNotNull()))
        paper = F.col("o_orderkey").cast("string")
        return pairs.repartition(paper).select(paper.alias("paper_id"), F.col("before").cast("string").alias("ref_id")).distinct()

    @cached_property
    def paper_tables(self) -> PaperTables:
        return PaperTables(
            papers=prepare_papers(self.view("p_paper"), min_year=FIXTURE_MIN_YEAR, max_year=FIXTURE_MAX_YEAR),
            authors=self.authors,
            references=self.references,
            primary_fields=heaviest_field(self.paper_fields),
        )

    @cached_property
    def graph(self) -> PropertyGraph:
        """The graph as stored: built once per application and data folder, partitioned by type, read pruned."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _stores:
            vertices, edges = new_path(self.spark, "vertices"), new_path(self.spark, "edges")
            with partitions_for(self.spark, self.table("lineitem").count()):
                flat = self.paper_tables.stored()
                write_partitioned(build_vertices(flat), vertices, "node_type")
                write_partitioned(build_edges(flat), edges, "rel_type")
            _stores[key] = (vertices, edges)
        vertices, edges = _stores[key]
        return PropertyGraph(self.spark.read.parquet(vertices), self.spark.read.parquet(edges))

    @cached_property
    def citations(self) -> PropertyGraph:
        """Papers and the citations among them."""
        g = self.graph
        return PropertyGraph(
            g.vertices.filter(F.col("node_type") == "paper"), g.edges.filter(F.col("rel_type") == "cites")
        )

    fields = FIXTURE_FIELDS

    @cached_property
    def nested_papers(self) -> DataFrame:
        """One nested record per paper, lists in a fixed order."""

        def listed(rows: DataFrame, entry, name: str) -> DataFrame:
            return rows.groupBy(F.col("paper_id").alias("id")).agg(F.array_sort(F.collect_list(entry)).alias(name))

        authors = listed(
            self.view("p_author"), F.struct(F.col("author_id").alias("id"), F.col("author_name").alias("name"), "org"), "authors"
        )
        references = listed(self.references, F.col("ref_id"), "references")
        fields = listed(self.view("p_field"), F.struct("name", F.col("w").cast("string").alias("w")), "fos")
        papers = self.view("p_paper")
        # Each list lies by its paper already; joined to the papers one by one, none of them moves again.
        for lists in (authors, references, fields):
            papers = papers.join(lists, "id", "left")
        return papers.select(
            "id", "title", "year", "n_citation",
            F.lit("fixture").alias("doc_type"),
            "authors",
            F.struct(F.lit(None).cast("string").alias("id"), F.col("venue_raw").alias("raw"),
                     F.col("venue_type").alias("type")).alias("venue"),
            "references", "fos",
        )
