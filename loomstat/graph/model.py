"""A typed property graph: vertices with an ``id``, edges with ``src``, ``dst`` and ``rel_type``."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomstat.operators.skew import HEAVY_ROWS, SALT, Salting

# A leg is reduced by another one if it has more than so many times its edges.
MUCH = 4
LEG = re.compile(r"\((\w+)\)\s*-\s*\[(\w+)\]\s*->\s*\((\w+)\)")


def motif_legs(pattern: str) -> list[tuple[str, str, str]]:
    """The (from, edge, to) names of a pattern whose edges are separated by semicolons."""
    parts = [part.strip() for part in pattern.split(";") if part.strip()]
    found = [LEG.fullmatch(part) for part in parts]
    if not parts or None in found:
        raise ValueError(f"not a motif of named edges: {pattern!r}")
    return [match.groups() for match in found]


def _names(legs: list[tuple[str, str, str]], edge: str) -> tuple[str, ...]:
    """The distinct vertex names of a leg."""
    return next(tuple(dict.fromkeys((start, end))) for start, name, end in legs if name == edge)


def leg_order(legs: list[tuple[str, str, str]], counts: dict[str, int]) -> list[tuple[str, str | None, list[str]]]:
    """Legs from the smallest on, each next one the smallest that shares a vertex with those before.

    Per leg its name, the earlier leg that it is tied to and the vertices that both have. Equal counts go by name.
    """
    left = sorted((counts[edge], edge) for _, edge, _ in legs)
    done: list[tuple[str, str | None, list[str]]] = [(left.pop(0)[1], None, [])]
    while left:
        for place, (_, edge) in enumerate(left):
            names = _names(legs, edge)
            tied = [(other, shared) for other, _, _ in done if (shared := [n for n in names if n in _names(legs, other)])]
            if tied:
                other, shared = max(tied, key=lambda t: len(t[1]))
                done.append((edge, other, shared))
                left.pop(place)
                break
        else:
            raise ValueError(f"edge {left[0][1]} shares no vertex with the other edges")
    return done


@dataclass(frozen=True)
class PropertyGraph:
    """Two DataFrames. Nothing is cached: filters reach the files, so partition and column pruning apply."""

    vertices: DataFrame
    edges: DataFrame

    def filter_edges(self, condition: Column | str) -> "PropertyGraph":
        return PropertyGraph(self.vertices, self.edges.filter(condition))

    def filter_vertices(self, condition: Column | str) -> "PropertyGraph":
        """Keep matching vertices and the edges with both ends among them."""
        kept = self.vertices.filter(condition)
        ids = kept.select("id")
        edges = self.edges
        for end in ("src", "dst"):
            edges = edges.join(ids.withColumnRenamed("id", end), end, "left_semi")
        return PropertyGraph(kept, edges.select(*self.edges.columns))

    def drop_isolated_vertices(self) -> "PropertyGraph":
        return PropertyGraph(self.vertices.join(self.endpoints(), "id", "left_semi"), self.edges)

    def endpoints(self) -> DataFrame:
        """Distinct ids that occur on any edge, from one pass over the edges."""
        return self.edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()

    def degree_counts(self) -> DataFrame:
        """``id, degree, in_degree, out_degree`` of vertices that have edges; one pass, one shuffle."""
        ends = F.array(
            F.struct(F.col("src").alias("id"), F.lit(0).alias("i"), F.lit(1).alias("o")),
            F.struct(F.col("dst").alias("id"), F.lit(1).alias("i"), F.lit(0).alias("o")),
        )
        return (
            self.edges.select(F.inline(ends))
            .groupBy("id")
            .agg(
                F.count(F.lit(1)).alias("degree"),
                F.sum("i").alias("in_degree"),
                F.sum("o").alias("out_degree"),
            )
        )

    def degrees(self) -> DataFrame:
        """All vertices with their three degrees, 0 where a vertex has no edges."""
        return self.vertices.join(self.degree_counts(), "id", "left").fillna(
            0, ["degree", "in_degree", "out_degree"]
        )

    def in_degrees(self) -> DataFrame:
        return self.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))

    def coherence(self) -> DataFrame:
        """One row: edges and how many of their ends are no vertex. A sound graph has none."""
        ids = self.vertices.select("id")
        ends = self.edges.select(F.inline(F.array(
            F.struct(F.col("src").alias("id"), F.lit("src").alias("side")),
            F.struct(F.col("dst").alias("id"), F.lit("dst").alias("side")),
        ))).groupBy("id", "side").agg(F.count(F.lit(1)).alias("n"))
        dangling = ends.join(ids.withColumn("known", F.lit(True)), "id", "left")
        lost = F.col("known").isNull()
        return dangling.agg(
            F.coalesce(F.sum(F.when(F.col("side") == "src", F.col("n"))), F.lit(0)).alias("edges"),
            F.coalesce(F.sum(F.when(lost & (F.col("side") == "src"), F.col("n"))), F.lit(0)).alias("dangling_src"),
            F.coalesce(F.sum(F.when(lost & (F.col("side") == "dst"), F.col("n"))), F.lit(0)).alias("dangling_dst"),
        )

    def density(self) -> DataFrame:
        """Edges over possible directed edges, 0 for fewer than two vertices."""
        nodes = self.vertices.agg(F.count(F.lit(1)).alias("n_vertices"))
        links = self.edges.agg(F.count(F.lit(1)).alias("n_edges"))
        possible = F.col("n_vertices").cast("double") * (F.col("n_vertices") - 1)
        value = F.when(F.col("n_vertices") > 1, F.col("n_edges") / possible).otherwise(F.lit(0.0))
        return nodes.crossJoin(F.broadcast(links)).withColumn("density", value)

    def leg_counts(self, legs: list[tuple[str, str, str]], where: dict[str, Column | str]) -> list[int]:
        """How many edges each leg of a motif has, all from one pass."""
        kinds = [F.expr(c) if isinstance(c := where.get(edge, "true"), str) else c for _, edge, _ in legs]
        return list(self.edges.agg(*[F.count_if(kind).alias(f"n{i}") for i, kind in enumerate(kinds)]).first())

    def find(
        self, legs: str | list[tuple[str, str, str]], where: dict[str, Column | str] | None = None, *,
        vertices: tuple[str, ...] | None = None, hub_rows: int = HEAVY_ROWS,
    ) -> DataFrame:
        """Rows that match a pattern of edges, one struct column per named vertex and edge.

        ``legs`` is a pattern such as ``(c)-[e1]->(a); (c)-[e2]->(b)`` or lists (from, edge, to) names, ``where`` a
        condition on the edge columns per edge name; conditions are applied to each edge scan before any join.
        ``vertices`` are the names whose vertex columns are wanted, all if None; the others are not looked up, so they
        have their ``id`` only and need not be vertices.

        The order in which legs are written has no influence: they are counted and joined from the smallest on, each
        next one sharing a vertex with those before. A leg much larger than the one it is joined to keeps only edges
        that meet it before either is widened, and is then reduced the other way round too. Vertices with ``hub_rows``
        edges or more of a leg are split over several tasks.
        """
        legs = motif_legs(legs) if isinstance(legs, str) else legs
        where = where or {}
        counts = dict(zip([edge for _, edge, _ in legs], self.leg_counts(legs, where), strict=True))
        steps = leg_order(legs, counts)
        scans: dict[str, DataFrame] = {}
        for start, edge, end in legs:
            scan = self.edges.filter(where[edge]) if edge in where else self.edges
            scans[edge] = scan.select(F.col("src").alias(f"{start}.id"), F.col("dst").alias(f"{end}.id"), F.struct(*scan.columns).alias(edge))
            if start == end:
                scans[edge] = scan.filter("src = dst").select(F.col("src").alias(f"{start}.id"), F.struct(*scan.columns).alias(edge))
        # Reduced leaf by leaf towards the smallest leg, then back.
        ties = [(edge, other, shared) for edge, other, shared in steps if other is not None]
        for edge, other, shared in [*ties, *[(other, edge, shared) for edge, other, shared in reversed(ties)]]:
            if counts[edge] > MUCH * counts[other]:
                keys = [f"`{name}.id`" for name in shared]
                scans[edge] = scans[edge].join(scans[other].select(*keys).distinct(), [f"{name}.id" for name in shared], "left_semi")
                counts[edge] = min(counts[edge], MUCH * counts[other])
        found, seen = scans[steps[0][0]], set(_names(legs, steps[0][0]))
        for edge, _, _ in steps[1:]:
            names = _names(legs, edge)
            shared = [f"{name}.id" for name in names if name in seen]
            key = shared[0]
            hubs = Salting.measure(scans[edge].withColumnRenamed(key, "key"), "key", min_rows=hub_rows) if counts[edge] >= hub_rows else Salting()
            left = hubs.lookup(found.withColumnRenamed(key, "key"), "key")
            right = hubs.big(scans[edge].withColumnRenamed(key, "key"), "key", edge)
            found = left.join(right, [*hubs.join_keys("key"), *shared[1:]], "inner").withColumnRenamed("key", key).drop(SALT)
            seen |= set(names)
        names = list(dict.fromkeys(name for start, _, end in legs for name in (start, end)))
        attributes = self.vertices.select("id", F.struct(*self.vertices.columns).alias("vertex"))

        def attach(rows: DataFrame, name: str) -> DataFrame:
            if vertices is not None and name not in vertices:
                return rows.withColumn(name, F.struct(F.col(f"`{name}.id`").alias("id"))).drop(f"{name}.id")
            side = attributes.select(F.col("id").alias(f"{name}.id"), F.col("vertex").alias(name))
            return rows.join(side, f"{name}.id", "inner").drop(f"{name}.id")

        return reduce(attach, names, found).select(*names, *[edge for _, edge, _ in legs])
