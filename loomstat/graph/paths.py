"""Breadth-first paths and hop distances, level by level; only the frontier moves.

Edges lie bucketed by the end that the search looks them up by, so they are shuffled once, before the first level.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loomstat.graph.model import PropertyGraph
from loomstat.operators.skew import SALT, Salting
from loomstat.session import bucketed, durable, partitions_for, place

# Levels after which the tables of visited vertices are merged into one, and landmarks of one search word.
MERGE_EVERY = 4
WORD = 64


def _merged(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, tables)


def _with_level(visited: list[DataFrame], level: DataFrame) -> list[DataFrame]:
    """Tables that hold all visited rows, never more than ``MERGE_EVERY`` of them."""
    visited = [*visited, level]
    return [durable(_merged(visited), "visited")] if len(visited) >= MERGE_EVERY else visited


@dataclass(frozen=True)
class _Links:
    """Distinct edges bucketed by one end; a hub's edges are spread over several buckets."""

    table: DataFrame
    key: str
    hubs: Salting

    def at(self, frontier: DataFrame, how: str = "inner") -> DataFrame:
        """Edges joined with the frontier's rows at the bucketed end; only the frontier is moved."""
        side = self.hubs.lookup(frontier.withColumnRenamed("id", self.key), self.key)
        return self.table.join(side, self.hubs.join_keys(self.key), how).drop(SALT)


@contextmanager
def _links(g: PropertyGraph, key: str) -> Iterator[_Links]:
    other = {"src": "dst", "dst": "src"}[key]
    with partitions_for(g.edges.sparkSession, g.edges.count()):
        edges = g.edges.select("src", "dst")
        hubs = Salting.measure(edges, key)
        placed = place(hubs.big(edges, key, other), *hubs.join_keys(key)).distinct()
        with bucketed(placed, *hubs.join_keys(key), label="links", placed=True) as table:
            yield _Links(table, key, hubs)


@dataclass(frozen=True)
class PathGraph:
    """All shortest paths between two sets of vertices, as the edges they use on each level.

    ``ends`` are the sources with such a path, ``steps`` the edges ``src, dst`` of each level, from the sources on. Its
    size is bounded by the graph's, however many paths there are.
    """

    ends: DataFrame
    steps: tuple[DataFrame, ...]

    def paths(self) -> DataFrame:
        """``from_id, to_id, hops, path``: every path written out."""
        paths = self.ends.select(F.col("id").alias("at"), F.array("id").alias("path"))
        for step in self.steps:
            paths = paths.join(step.withColumnRenamed("src", "at"), "at").select(
                F.col("dst").alias("at"), F.concat("path", F.array("dst")).alias("path")
            )
        return paths.select(
            F.col("path")[0].alias("from_id"), F.col("at").alias("to_id"), F.lit(len(self.steps)).alias("hops"), "path"
        )

    def counts(self) -> DataFrame:
        """``from_id, to_id, hops, n_paths``: how many paths each pair has, none written out.

        Counts go from the targets back, a row per vertex and target that it reaches; the targets are the fewer as a rule.
        """
        if not self.steps:
            return self.ends.select(
                F.col("id").alias("from_id"), F.col("id").alias("to_id"), F.lit(0).alias("hops"), F.lit(1).cast("decimal(38,0)").alias("n_paths")
            )
        one = F.lit(1).cast("decimal(38,0)")
        ways = self.steps[-1].select(F.col("dst").alias("id"), F.col("dst").alias("to_id")).distinct().withColumn("n_paths", one)
        for step in reversed(self.steps):
            met = step.join(ways.withColumnRenamed("id", "dst"), "dst")
            summed = met.groupBy(F.col("src").alias("id"), "to_id").agg(F.sum("n_paths").cast("decimal(38,0)").alias("n_paths"))
            ways = durable(summed, "path-counts")
        return ways.select(F.col("id").alias("from_id"), "to_id", F.lit(len(self.steps)).alias("hops"), "n_paths")


def path_graph(g: PropertyGraph, sources: DataFrame, targets: DataFrame, *, max_length: int = 10) -> PathGraph | None:
    """The shortest paths of the globally smallest length that lead from a source to a target; None without any.

    ``sources`` and ``targets`` are DataFrames of ``id`` of any size. The search goes forward level by level and
    stops at the first level with a target; the way back then keeps only edges on a shortest path.
    """
    start = durable(sources.select("id").distinct(), "bfs")
    goal = targets.select("id").distinct()
    hit = start.join(goal, "id", "left_semi")
    levels, visited = [start], [start]
    with _links(g, "src") as links:
        while hit.isEmpty():
            if len(levels) > max_length:
                return None
            reached = links.at(levels[-1], "left_semi").select(F.col("dst").alias("id")).distinct()
            level = durable(reached.join(_merged(visited), "id", "left_anti"), "bfs")
            if level.isEmpty():
                return None
            levels.append(level)
            visited = _with_level(visited, level)
            hit = level.join(goal, "id", "left_semi")
        steps: list[DataFrame] = []
        alive = hit
        for level in reversed(levels[:-1]):
            step = links.at(level, "left_semi").join(alive.withColumnRenamed("id", "dst"), "dst", "left_semi")
            step = durable(step.select("src", "dst"), "bfs-step")
            alive = step.select(F.col("src").alias("id")).distinct()
            steps.insert(0, step)
        return PathGraph(durable(alive, "bfs-ends"), tuple(steps))


def bfs_paths(g: PropertyGraph, sources: DataFrame, targets: DataFrame, *, max_length: int = 10) -> DataFrame:
    """``from_id, to_id, hops, path``: every path of the smallest length that leads from a source to a target."""
    found = path_graph(g, sources, targets, max_length=max_length)
    if found is None:
        return g.edges.sparkSession.createDataFrame([], "from_id string, to_id string, hops int, path array<string>")
    return found.paths()


def path_counts(g: PropertyGraph, sources: DataFrame, targets: DataFrame, *, max_length: int = 10) -> DataFrame:
    """``from_id, to_id, hops, n_paths`` of the same paths, counted without writing any of them out."""
    found = path_graph(g, sources, targets, max_length=max_length)
    if found is None:
        return g.edges.sparkSession.createDataFrame([], "from_id string, to_id string, hops int, n_paths decimal(38,0)")
    return found.counts()


def _numbered(landmarks: DataFrame) -> DataFrame:
    """``id, word, bit`` of the landmarks, as many rows as the caller names."""
    place = F.row_number().over(Window.orderBy("id")) - 1
    rows = landmarks.select("id").distinct().withColumn("place", place)
    return durable(rows.select("id", F.floor(F.col("place") / WORD).cast("int").alias("word"), (F.col("place") % WORD).cast("int").alias("bit")), "landmarks")


def _reached(g: PropertyGraph, marks: DataFrame, max_hops: int | None = None) -> DataFrame:
    """``id, word, bits, hops``: the landmarks of a word that are first reached from ``id`` in that many hops.

    All landmarks are searched for at once, one bit each: a vertex has one row per word and level, and the frontier
    carries the bits that are new to it.
    """
    bit = F.expr("shiftleft(1L, bit)")
    frontier = durable(marks.groupBy("id", "word").agg(F.bit_or(bit).alias("bits")).withColumn("hops", F.lit(0)), "distance")
    found, hops = [frontier], 0
    with _links(g, "dst") as links:
        while hops != max_hops and not frontier.isEmpty():
            hops += 1
            arrived = links.at(frontier.select("id", "word", "bits")).groupBy(F.col("src").alias("id"), "word").agg(F.bit_or("bits").alias("bits"))
            seen = _merged(found).groupBy("id", "word").agg(F.bit_or("bits").alias("seen"))
            new = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("seen", F.lit(0).cast("bigint"))))
            step = arrived.join(seen, ["id", "word"], "left").select("id", "word", new.alias("bits"), F.lit(hops).alias("hops"))
            frontier = durable(step.filter(F.col("bits") != 0), "distance")
            found = _with_level(found, frontier)
        return durable(_merged(found), "distances")


def _entries(reached: DataFrame, marks: DataFrame) -> DataFrame:
    """``id, entries``: the landmarks of each row of ``reached`` as structs ``landmark, hops``."""
    names = marks.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("bit", "id"))).alias("names"))
    # a row for every 64 landmarks that the caller named
    named = reached.join(F.broadcast(names), "word")
    places = F.expr(f"filter(sequence(0, {WORD - 1}), i -> (bits & shiftleft(1L, i)) != 0)")
    return named.select("id", F.transform(places, lambda i: F.struct(F.col("names")[i].alias("landmark"), F.col("hops").alias("hops"))).alias("entries"))


def landmark_distances(g: PropertyGraph, landmarks: DataFrame, *, max_hops: int | None = None) -> DataFrame:
    """``id, landmark, hops`` for all pairs with a path from ``id`` to the landmark along the edges, of any length or of
    ``max_hops`` at most."""
    with partitions_for(g.edges.sparkSession, g.edges.count()):
        marks = _numbered(landmarks)
    return _entries(_reached(g, marks, max_hops), marks).select("id", F.inline("entries"))


def shortest_paths(g: PropertyGraph, landmarks: DataFrame) -> DataFrame:
    """Every vertex with ``distances``, a map landmark -> hops along the edges; empty where none is reachable.

    The map has one entry per landmark reached; 64 landmarks cost a search what one does.
    """
    with partitions_for(g.edges.sparkSession, g.edges.count()):
        marks = _numbered(landmarks)
    lists = _entries(_reached(g, marks), marks).groupBy("id").agg(F.flatten(F.collect_list("entries")).alias("entries"))
    reached = lists.select("id", F.map_from_entries(F.array_sort("entries")).alias("distances"))
    empty = F.expr("cast(map() as map<string,int>)")
    return g.vertices.join(reached, "id", "left").withColumn("distances", F.coalesce("distances", empty))


def distance_histogram(distances: DataFrame, landmark: str, column: str = "distances") -> DataFrame:
    """Vertices per number of hops to one landmark, itself left out."""
    hops = F.col(column).getItem(landmark)
    return distances.select(hops.alias("hops")).filter("hops > 0").groupBy("hops").agg(
        F.count(F.lit(1)).alias("n_vertices")
    )
