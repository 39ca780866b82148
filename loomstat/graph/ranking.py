"""PageRank and label propagation: a fixed number of synchronous rounds over a bucketed edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.graph.model import PropertyGraph
from loomstat.operators.skew import Salting
from loomstat.session import bucketed, durable, partitions_for, place

# Rounds between two cuts of the lineage: a lost executor costs at most this many rounds again, or one more at the end.
CUT_EVERY = 4


def _rank(reset: float) -> Column:
    """Rank of a vertex from its ``inflow``, which is null where it has no in-edges."""
    return F.lit(reset) + F.lit(1 - reset) * F.coalesce(F.col("inflow"), F.lit(0.0))


def pagerank(g: PropertyGraph, *, reset: float = 0.15, max_iter: int = 5) -> DataFrame:
    """``id, pagerank`` of every vertex.

    All start at 1; a round gives ``reset + (1 - reset) * sum(rank(u) / out_degree(u))`` over the edges u -> v, each
    parallel edge counted; at the end ranks are scaled so that they sum to the number of vertices (what flowed into
    vertices without out-edges is lost before).

    A round is one join and one aggregate: the edges carry their share 1/out_degree and lie bucketed by source, the
    incoming sums arrive hashed the same way, and a vertex without in-edges needs no row in between.
    """
    if max_iter < 1:
        raise ValueError("max_iter must be at least 1")
    out = durable(g.edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree")), "out-degree")
    hubs = Salting.measure_counts(out, "src", "out_degree")
    rows = out.agg(F.coalesce(F.sum("out_degree"), F.lit(0))).first()[0]
    with partitions_for(out.sparkSession, rows):
        by_source = hubs.join_keys("src")
        # moved once: counted, joined and written where their source is
        parallel = place(hubs.big(g.edges.select("src", "dst"), "src", "dst"), *by_source).groupBy(*by_source, "dst").agg(F.count(F.lit(1)).alias("n"))
        edges = parallel.join(hubs.lookup(out, "src"), by_source).select(*by_source, "dst", (F.col("n") / F.col("out_degree")).alias("share"))
        with bucketed(edges, *by_source, label="shares", placed=True) as shares:
            incoming = shares.groupBy("dst").agg(F.sum("share").alias("inflow"))
            for step in range(2, max_iter + 1):
                lookup = hubs.lookup(incoming.withColumnRenamed("dst", "src"), "src")
                incoming = (
                    shares.join(lookup, by_source, "left")
                    .groupBy("dst")
                    .agg(F.sum(F.col("share") * _rank(reset)).alias("inflow"))
                )
                if step % CUT_EVERY == 0 and step + 1 < max_iter:
                    incoming = durable(incoming, "inflow")
            raw = g.vertices.select("id").join(incoming.withColumnRenamed("dst", "id"), "id", "left")
            raw = durable(raw.select("id", _rank(reset).alias("raw")), "ranks")
    scale = raw.agg((F.count(F.lit(1)) / F.sum("raw")).alias("scale"))
    return raw.crossJoin(F.broadcast(scale)).select("id", (F.col("raw") * F.col("scale")).alias("pagerank"))


def label_propagation(g: PropertyGraph, *, max_iter: int = 5) -> DataFrame:
    """``id, label`` after ``max_iter`` synchronous rounds.

    A vertex takes the most frequent label among its neighbours, edges used both ways and parallel edges counted,
    its own label not counted; a tie goes to the smallest label. Vertices without neighbours keep their own id.
    """
    both = g.edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("at"), F.col("dst").alias("to")),
        F.struct(F.col("dst").alias("at"), F.col("src").alias("to")),
    )))
    labels = None
    with partitions_for(both.sparkSession, 2 * g.edges.count()):
        hubs = Salting.measure_counts(both.groupBy("at").agg(F.count(F.lit(1)).alias("rows")), "at", "rows")
        by_vertex = hubs.join_keys("at")
        # moved once: counted and written where the vertex is that they are looked up by
        links = place(hubs.big(both, "at", "to"), *by_vertex).groupBy(*by_vertex, "to").agg(F.count(F.lit(1)).alias("n"))
        with bucketed(links, *by_vertex, label="links", placed=True) as near:
            for step in range(1, max_iter + 1):
                if labels is None:
                    votes = near.select("to", F.col("at").alias("label"), "n")
                else:
                    lookup = hubs.lookup(labels.withColumnRenamed("id", "at"), "at")
                    # a bucket's labels are few and fit a hash table, so its links need no sorting
                    votes = near.join(lookup.hint("shuffle_hash"), by_vertex, "inner").select("to", "label", "n")
                # Votes move once, to their vertex; those of hot vertices are added up by label before they meet.
                votes = votes if hubs.keys else place(votes, "to")
                tally = votes.groupBy("to", "label").agg(F.sum("n").alias("n"))
                best = F.min(F.struct((-F.col("n")).alias("n"), "label"))["label"]
                labels = tally.groupBy(F.col("to").alias("id")).agg(best.alias("label"))
                if step == max_iter or step % CUT_EVERY == 0 and step + 1 < max_iter:
                    labels = durable(labels, "labels")
    if labels is None:
        return g.vertices.select("id", F.col("id").alias("label"))
    own = F.coalesce("label", F.col("id")).alias("label")
    return g.vertices.select("id").join(labels, "id", "left").select("id", own)
