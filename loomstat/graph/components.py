"""Weakly connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.graph.model import PropertyGraph
from loomstat.operators.skew import HEAVY_ROWS, Salting, salted_lookup
from loomstat.session import durable


def _star(links: DataFrame, size: int, *, centre: str, other: str) -> DataFrame:
    """Links (``centre``, ``other``) with ``lowest``, the smallest id next to ``centre``; hot centres are spread."""
    if centre == "lo":
        # Towards larger neighbours the centre's own neighbourhood on both sides counts.
        near = links.select(F.inline(F.array(
            F.struct(F.col("lo").alias("c"), F.col("lo").alias("v")),
            F.struct(F.col("hi").alias("c"), F.col("lo").alias("v")),
        )))
    else:
        near = links.select(F.col("hi").alias("c"), F.col("lo").alias("v"))
    lowest = near.groupBy(F.col("c").alias(centre)).agg(F.min("v").alias("lowest"))
    salting = Salting.measure(links, centre) if size >= HEAVY_ROWS else Salting()
    return salted_lookup(links, lowest, centre, spread=other, how="inner", salting=salting)


def _links(pairs: DataFrame) -> DataFrame:
    return pairs.filter(F.col("hi") > F.col("lo")).distinct()


def connected_components(g: PropertyGraph) -> DataFrame:
    """``id, component`` of every vertex; the component is named by its smallest id, edge direction is ignored.

    A large-star round links each vertex's larger neighbours to the smallest id it knows, a small-star round the
    smaller ones; after about log(n) rounds every component is a star around its smallest id, and the loop ends.
    Each round is cut into a written table. The centre of a giant star is spread over many tasks; the minimum per
    centre is combined before any shuffle.
    """
    ends = g.edges.select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
    links, settled = durable(_links(ends), "links"), False
    while not settled:  # edges are hardly ever stars, so the first look comes after a round
        size = links.count()
        large = _links(_star(links, size, centre="lo", other="hi").select("hi", F.col("lowest").alias("lo")))
        large = durable(large, "large-star")
        near = _star(large, size, centre="hi", other="lo")
        small = _links(near.select(F.inline(F.array(
            F.struct(F.col("lo").alias("hi"), F.col("lowest").alias("lo")),
            F.struct(F.col("hi"), F.col("lowest").alias("lo")),
        ))))
        links = durable(small, "small-star")
        settled = _settled(links)
    roots = links.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    return g.vertices.select("id").join(roots, "id", "left").select(
        "id", F.coalesce("component", F.col("id")).alias("component")
    )


def _settled(links: DataFrame) -> bool:
    """Whether every link leads to a centre that has no link on: then the stars are the components."""
    roles = links.select(F.inline(F.array(
        F.struct(F.col("hi").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("lo").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")),
    ))).groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return roles.filter((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def group_sizes(members: DataFrame, group: str) -> DataFrame:
    """Size of every group with its share of all members in percent and the number of groups."""
    sizes = members.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    total = members.agg(F.count(F.lit(1)).alias("members"), F.count_distinct(group).alias("groups"))
    share = F.round(F.col("size") * 100.0 / F.col("members"), 6).cast("double")
    return sizes.crossJoin(F.broadcast(total)).select(group, "size", share.alias("share_pct"), "groups")
