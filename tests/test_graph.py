"""Graph algorithms on small graphs with known answers, and with every hot-key path switched on."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter, defaultdict
from contextlib import contextmanager
from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from loomstat.graph import build as B
from loomstat import session as sessions
from loomstat.graph import overlap, paths, ranking
from loomstat.graph import projection as P
from loomstat.graph.components import connected_components, group_sizes
from loomstat.graph.model import PropertyGraph, leg_order, motif_legs
from loomstat.graph.paths import bfs_paths, landmark_distances, path_counts, shortest_paths
from loomstat.graph.ranking import label_propagation, pagerank
from loomstat.operators import skew
from loomstat.plans import graph_queries
from loomstat.plans import inputs as inputs_module
from loomstat.plans.views import FIXTURE_FIELDS, SHARED_VIEWS
from loomstat.session import bounded_tasks, bucketed, durable, partitions_for

GOLDEN = [("1", "2"), ("1", "3"), ("2", "3"), ("4", "3"), ("5", "4"), ("5", "4"), ("6", "5"), ("3", "7")]


@pytest.fixture
def hot(monkeypatch):
    """Treat every key with two rows or more as hot."""
    for method in ("measure", "measure_counts"):
        function = getattr(skew.Salting, method).__func__

        def eager(cls, *args, _function=function, **options):
            return _function(cls, *args, **{**options, "min_rows": 2, "salts": 4})

        monkeypatch.setattr(skew.Salting, method, classmethod(eager))
    monkeypatch.setattr("loomstat.graph.components.HEAVY_ROWS", 0)


def values(df, key, value):
    return {row[key]: row[value] for row in df.collect()}


def random_edges(seed, n=40, m=70, hub=True):
    rng = random.Random(seed)
    edges = [(f"v{rng.randrange(n):02d}", f"v{rng.randrange(n):02d}") for _ in range(m)]
    return edges + [("v00", f"v{i:02d}") for i in range(1, n, 3)] if hub else edges


def python_pagerank(ids, edges, rounds=5):
    out = Counter(a for a, _ in edges)
    rank = {v: 1.0 for v in ids}
    for _ in range(rounds):
        flow = defaultdict(float)
        for a, b in edges:
            flow[b] += rank[a] / out[a]
        rank = {v: 0.15 + 0.85 * flow[v] for v in ids}
    scale = len(ids) / sum(rank.values())
    return {v: r * scale for v, r in rank.items()}


def python_labels(ids, edges, rounds=5):
    near = defaultdict(list)
    for a, b in edges:
        near[a].append(b)
        near[b].append(a)
    labels = {v: v for v in ids}
    for _ in range(rounds):
        votes = {v: Counter(labels[u] for u in near[v]) for v in ids}
        labels = {v: min(votes[v].items(), key=lambda x: (-x[1], x[0]))[0] if votes[v] else labels[v] for v in ids}
    return labels


def python_components(ids, edges):
    root = {v: v for v in ids}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {v: find(v) for v in ids}


def test_pagerank_golden(make_graph):
    got = values(pagerank(make_graph(GOLDEN)), "id", "pagerank")
    want = {"1": 0.393926, "2": 0.561345, "3": 1.899858, "4": 1.013376, "5": 0.728764, "6": 0.393926, "7": 2.008805}
    assert got == pytest.approx(want, abs=1e-6)


@pytest.mark.parametrize("spread", [False, True])
def test_iterative_algorithms_against_plain_python(make_graph, request, spread):
    if spread:
        request.getfixturevalue("hot")
    edges = random_edges(7)
    g = make_graph(edges, ["z1"])
    ids = [r["id"] for r in g.vertices.collect()]
    assert values(pagerank(g), "id", "pagerank") == pytest.approx(python_pagerank(ids, edges))
    assert values(label_propagation(g), "id", "label") == python_labels(ids, edges)
    assert values(connected_components(g), "id", "component") == python_components(ids, edges)


def test_pagerank_sums_to_vertices(make_graph):
    g = make_graph(random_edges(3))
    assert pagerank(g).agg(F.sum("pagerank")).first()[0] == pytest.approx(g.vertices.count())


@pytest.mark.parametrize("edges", [
    [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)],
    [("a", "a"), ("b", "c"), ("c", "b"), ("d", "e"), ("f", "e")],
    [],
])
def test_components_of_chains_and_loops(make_graph, edges):
    g = make_graph(edges, ["q"])
    ids = [r["id"] for r in g.vertices.collect()]
    members = connected_components(g)
    assert values(members, "id", "component") == python_components(ids, edges)
    assert group_sizes(members, "component").agg(F.sum("size")).first()[0] == len(ids)


def test_triangles(make_graph):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d"), ("d", "d")]
    got = values(triangles := P.triangle_count(make_graph(edges, ["e"])), "id", "triangles")
    assert got == {"a": 1, "b": 1, "c": 1, "d": 0, "e": 0}
    assert triangles.agg(F.sum("triangles")).first()[0] % 3 == 0


def test_triangles_against_plain_python(make_graph):
    edges = random_edges(11, n=25, m=120)
    links = {tuple(sorted(e)) for e in edges if e[0] != e[1]}
    want = Counter()
    for three in itertools.combinations(sorted({v for e in edges for v in e}), 3):
        if all(pair in links for pair in itertools.combinations(three, 2)):
            want.update(three)
    got = values(P.triangle_count(make_graph(edges)), "id", "triangles")
    assert {k: v for k, v in got.items() if v} == dict(want)


def ids_of(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "id string")


def test_bfs_finds_all_shortest_paths(spark, make_graph):
    g = make_graph([("a", "b"), ("a", "c"), ("b", "d"), ("c", "d"), ("d", "e"), ("a", "a"), ("e", "f")])
    got = bfs_paths(g, ids_of(spark, "a"), ids_of(spark, "d", "f"))
    assert sorted(r["path"] for r in got.collect()) == [["a", "b", "d"], ["a", "c", "d"]]
    assert {(r["from_id"], r["to_id"], r["hops"]) for r in got.collect()} == {("a", "d", 2)}


def test_bfs_corner_cases(spark, make_graph):
    g = make_graph([("a", "b"), ("b", "c")])
    assert bfs_paths(g, ids_of(spark, "c"), ids_of(spark, "a")).count() == 0
    assert bfs_paths(g, ids_of(spark, "a"), ids_of(spark, "c"), max_length=1).count() == 0
    same = bfs_paths(g, ids_of(spark, "a", "b"), ids_of(spark, "b")).collect()
    assert [(r["from_id"], r["hops"], r["path"]) for r in same] == [("b", 0, ["b"])]


def test_six_degrees_samples_only_when_asked(make_graph, spark):
    g = make_graph([("a", "t"), ("b", "t"), ("c", "t")])
    papers = g.vertices.select("id", F.lit("paper").alias("node_type"), F.lit("x").alias("primary_field"))
    g = PropertyGraph(papers, g.edges)
    target = ids_of(spark, "t")
    assert P.six_degrees(g.filter_vertices("true"), "x", target, max_sources=2).first()["hops"] == 1
    every = P.six_degrees(PropertyGraph(papers.filter("id <> 't'"), g.edges), "x", target, max_sources=None)
    assert every.count() == 3


def test_shortest_paths(spark, make_graph):
    edges = random_edges(5)
    g = make_graph(edges)
    marks = ids_of(spark, "v01", "v02")
    got = values(shortest_paths(g, marks), "id", "distances")
    into = defaultdict(set)
    for a, b in edges:
        into[b].add(a)
    want = {v: {} for v in got}
    for mark in ("v01", "v02"):
        level, hops, seen = {mark}, 0, set()
        while level:
            for v in level:
                want[v][mark] = hops
            seen |= level
            level, hops = {u for v in level for u in into[v]} - seen, hops + 1
    assert got == want
    hops = {(r["id"], r["landmark"]): r["hops"] for r in landmark_distances(g, marks).collect()}
    for a, b in edges:
        for mark in ("v01", "v02"):
            if (b, mark) in hops:
                assert hops[a, mark] <= hops[b, mark] + 1


def test_many_landmarks_in_one_search(spark, make_graph, hot):
    """130 landmarks, three words; hubs on both ends."""
    edges = [(f"v{i:03d}", f"v{(i + 1) % 130:03d}") for i in range(130)] + [("hub", f"v{i:03d}") for i in range(0, 130, 10)]
    g = make_graph(edges, ["alone"])
    marks = ids_of(spark, *[f"v{i:03d}" for i in range(130)])
    got = values(shortest_paths(g, marks), "id", "distances")
    assert got["alone"] == {} and len(got["hub"]) == 130
    assert got["v005"] == {f"v{(5 + h) % 130:03d}": h for h in range(130)}
    assert got["hub"] == {f"v{i:03d}": 1 + i % 10 for i in range(130)}


def test_more_paths_than_anyone_writes_out(spark, make_graph):
    """A chain of 25 diamonds has 2^25 shortest paths: they are counted."""
    edges = [e for i in range(25) for side in "xy" for e in ((f"n{i}", f"n{i}{side}"), (f"n{i}{side}", f"n{i + 1}"))]
    g = make_graph(edges)
    found = path_counts(g, ids_of(spark, "n0", "n25x"), ids_of(spark, "n25"), max_length=60).collect()
    assert [(r.from_id, r.to_id, r.hops, int(r.n_paths)) for r in found] == [("n0", "n25", 50, 2 ** 25)]


def test_path_counts_are_those_of_the_paths(spark, make_graph):
    g = make_graph(random_edges(8, n=30, m=110))
    for sources, targets in ((["v01", "v02", "v03"], ["v20", "v21"]), (["v01"], ["v01"]), (["v05"], ["nowhere"])):
        paths = Counter((r.from_id, r.to_id, r.hops) for r in bfs_paths(g, ids_of(spark, *sources), ids_of(spark, *targets)).collect())
        counts = path_counts(g, ids_of(spark, *sources), ids_of(spark, *targets)).collect()
        assert {(r.from_id, r.to_id, r.hops): int(r.n_paths) for r in counts} == paths


def test_edges_are_shuffled_once(spark, make_graph):
    """The join of a level reads the bucketed edges in place."""
    from loomstat.graph import paths

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with paths._links(make_graph(random_edges(3)), "src") as links:
            plan = links.at(ids_of(spark, "v01"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan


def brute_pairs(rows):
    contexts = defaultdict(set)
    for item, context in rows:
        contexts[item].add(context)
    return {
        (a, b): n for a, b in itertools.combinations(sorted(contexts), 2) if (n := len(contexts[a] & contexts[b]))
    }


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("least,heavy", [(2, 512), (2, 4), (3, 12), (5, 8)])
def test_shared_pairs_are_exact_with_hubs(spark, seed, least, heavy):
    rng = random.Random(seed)
    rows = {(f"i{rng.randrange(30):02d}", f"c{rng.randrange(25):02d}") for _ in range(260)}
    rows |= {(f"i{i:02d}", hub) for i in range(30) for hub in ("hub1", "hub2") if rng.random() < 0.8}
    df = spark.createDataFrame(sorted(rows), "item string, context string")
    found = overlap.shared_pairs(df, item="item", context="context", min_shared=least, heavy=heavy, block=5)
    got = {(r["a"], r["b"]): r["shared"] for r in found.collect()}
    assert got == {pair: n for pair, n in brute_pairs(rows).items() if n >= least}


@pytest.mark.parametrize("size,k", [(260, 10), (25, 10), (6, 50)])
def test_top_shared_pairs(spark, size, k):
    rng = random.Random(size)
    rows = {(f"i{rng.randrange(30):02d}", f"c{rng.randrange(12):02d}") for _ in range(size)}
    df = spark.createDataFrame(sorted(rows), "item string, context string")
    got = [tuple(r) for r in overlap.top_shared_pairs(df, item="item", context="context", k=k).collect()]
    want = sorted(((a, b, n) for (a, b), n in brute_pairs(rows).items()), key=lambda x: (-x[2], x[0], x[1]))[:k]
    assert got == want


def test_hub_context_makes_no_candidates(spark, monkeypatch):
    """A context that all items share, next to one rare context each, yields no pair of its own."""
    tables = {}
    write = overlap.durable
    monkeypatch.setattr(overlap, "durable", lambda df, label: tables.setdefault(label, write(df, label)))
    rows = [(f"i{i:03d}", "hub") for i in range(300)] + [(f"i{i:03d}", f"c{i // 2}") for i in range(300)]
    df = spark.createDataFrame(rows, "item string, context string")
    assert overlap.shared_pairs(df, item="item", context="context", heavy=50).count() == 150
    assert tables["overlap-pairs"].count() == 150


def test_hubs_are_compared_as_sets(spark, monkeypatch):
    """400 items in two of six hubs each: pairs of sets are asked, not pairs of items, and failing ones are not written."""
    made, pairs = [], overlap._block_pairs
    monkeypatch.setattr(overlap, "_block_pairs", lambda *a, **k: made.append(pairs(*a, **k)) or made[-1])
    two = list(itertools.combinations(range(6), 2))
    sets = {i: two[0] if i < 3 else (i % 6,) if i > 6 else two[i] for i in range(400)}
    rows = [(f"i{i:03d}", f"hub{h}") for i, hubs in sets.items() for h in hubs]
    df = spark.createDataFrame(rows, "item string, context string")
    found = {(r.a, r.b): r.shared for r in overlap.shared_pairs(df, item="item", context="context", heavy=20).collect()}
    assert found == {pair: n for pair, n in brute_pairs(rows).items() if n >= 2} and len(found) == 3
    assert sum(m.count() for m in made) <= 10  # of 79,800 pairs, of which a sixth share a hub


def test_top_pairs_are_worked_out_once(spark, monkeypatch):
    """The seed's k-th count is the threshold, and items that occur less often are left out."""
    asked, whole = [], overlap.shared_pairs
    monkeypatch.setattr(overlap, "shared_pairs", lambda *a, **k: asked.append(k["min_shared"]) or whole(*a, **k))
    rng = random.Random(4)
    rows = {(f"i{i:02d}", f"c{c}") for i in range(8) for c in range(40) if rng.random() < 0.7}
    rows |= {(f"j{i:03d}", f"c{rng.randrange(40)}") for i in range(200)}
    df = spark.createDataFrame(sorted(rows), "item string, context string")
    got = [tuple(r) for r in overlap.top_shared_pairs(df, item="item", context="context", k=5, seed=8).collect()]
    want = sorted(((a, b, n) for (a, b), n in brute_pairs(rows).items()), key=lambda x: (-x[2], x[0], x[1]))[:5]
    assert got == want and asked == [want[-1][2]]


@pytest.mark.parametrize("heavy", [1, 3])
def test_triangles_of_vertices_with_many_out_edges(make_graph, heavy):
    edges = random_edges(5, n=20, m=150) + [(f"k{i}", f"k{j}") for i in range(9) for j in range(i)]
    g = make_graph(edges)
    assert values(P.triangle_count(g, heavy=heavy, block=2), "id", "triangles") == values(P.triangle_count(g), "id", "triangles")


def test_degrees_subgraph_motif(make_graph):
    g = make_graph([("a", "b"), ("a", "b"), ("b", "c"), ("c", "c")], ["z"])
    degrees = {r["id"]: (r["degree"], r["in_degree"], r["out_degree"]) for r in g.degrees().collect()}
    assert degrees == {"a": (2, 0, 2), "b": (3, 2, 1), "c": (3, 2, 1), "z": (0, 0, 0)}
    kept = g.filter_vertices("id <> 'c'")
    assert kept.edges.count() == 2 and kept.drop_isolated_vertices().vertices.count() == 2
    chains = g.find([("x", "e1", "y"), ("y", "e2", "z")]).select("x.id", "y.id", "z.id").collect()
    assert Counter(tuple(r) for r in chains) == {("a", "b", "c"): 2, ("b", "c", "c"): 1, ("c", "c", "c"): 1}
    with pytest.raises(ValueError):
        g.find([("x", "e1", "y"), ("v", "e2", "w")])
    assert g.coherence().first()["dangling_dst"] == 0


def brute_motif(edges, legs, where):
    rows = [{}]
    for start, name, end in legs:
        grown = []
        for row in rows:
            for a, b, kind in edges:
                if kind == where[name] and row.get(start, a) == a and row.get(end, b) == b and (start != end or a == b):
                    grown.append({**row, start: a, end: b})
        rows = grown
    return Counter(tuple(sorted(r.items())) for r in rows)


def test_motifs_do_not_depend_on_the_written_order(spark, make_graph):
    """Three legs, a hub in the middle: any order of legs is joined alike and gives the same rows, hubs split or not."""
    rng = random.Random(2)
    edges = [(f"a{i}", "hub" if i % 3 else f"p{i % 7}", "wrote") for i in range(60)]
    edges += [("hub", f"v{i % 4}", "in") for i in range(6)] + [(f"p{i}", f"v{i % 3}", "in") for i in range(7)]
    edges += [("v1", "x", "near"), ("v2", "x", "near"), ("x", "x", "near")]
    rng.shuffle(edges)
    g = PropertyGraph(make_graph([e[:2] for e in edges]).vertices, spark.createDataFrame(edges, "src string, dst string, rel_type string"))
    legs = [("a", "w", "p"), ("p", "i", "v"), ("v", "n", "x")]
    where = {"w": "rel_type = 'wrote'", "i": "rel_type = 'in'", "n": "rel_type = 'near'"}
    want = brute_motif(edges, legs, {"w": "wrote", "i": "in", "n": "near"})
    orders = []
    for written in itertools.permutations(legs):
        counts = dict(zip([e for _, e, _ in written], g.leg_counts(list(written), where)))
        orders.append(leg_order(list(written), counts))
        for hub_rows in (1_000_000, 5):
            found = g.find(list(written), where, vertices=(), hub_rows=hub_rows).select("a.id", "p.id", "v.id", "x.id")
            assert Counter(tuple(zip("apvx", r)) for r in map(tuple, found.collect())) == want
    assert all(o == orders[0] for o in orders) and [o[0] for o in orders[0]] == ["n", "i", "w"]


def test_motif_of_a_cycle_and_a_loop(spark, make_graph):
    edges = [(a, b, "r") for a, b in random_edges(6, n=8, m=30)]
    g = PropertyGraph(make_graph([e[:2] for e in edges]).vertices, spark.createDataFrame(edges, "src string, dst string, rel_type string"))
    for pattern in ("(a)-[e]->(b); (b)-[f]->(c); (c)-[h]->(a)", "(a)-[e]->(a); (a)-[f]->(b)"):
        legs = motif_legs(pattern)
        names = list(dict.fromkeys(n for s, _, t in legs for n in (s, t)))
        found = g.find(pattern, hub_rows=3).select(*[f"{n}.id" for n in names])
        got = Counter(tuple(sorted(zip(names, r))) for r in map(tuple, found.collect()))
        assert got == brute_motif(edges, legs, defaultdict(lambda: "r"))


def test_salted_lookup_equals_plain_join(spark):
    big = spark.createDataFrame([(i % 3, i) for i in range(200)] + [(9, 1)], "k int, v int")
    lookup = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "k int, name string")
    salting = skew.Salting.measure(big, "k", min_rows=50, salts=8)
    assert sorted(salting.keys) == [0, 1, 2]
    for how in ("left", "inner"):
        salted = skew.salted_lookup(big, lookup, "k", spread="v", how=how, salting=salting)
        assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, big.join(lookup, "k", how).collect()), key=str)


def test_pairs_of_two_hubs_are_made_in_blocks(spark):
    """Items that share two hubs: every pair counts, and no block pairs up more than its size."""
    rows = [(f"i{i:03}", hub) for i in range(60) for hub in ("h1", "h2")] + [("i000", "x"), ("i001", "x")]
    frame = spark.createDataFrame(rows, "item string, context string")
    found = {(r.a, r.b): r.shared for r in overlap.shared_pairs(frame, item="item", context="context", heavy=9, block=7).collect()}
    want = {(f"i{i:03}", f"i{j:03}"): 2 for i in range(60) for j in range(i + 1, 60)}
    want["i000", "i001"] = 3
    assert found == want


def paper_tables(spark):
    """Three papers; an author, a reference and a name that belong to none of them, and rows that come twice."""
    papers = spark.createDataFrame(
        [(str(i), f"T{i}", 2000, 3, " Conf A ", "C", "conf a") for i in range(3)],
        "id string, title string, year int, n_citation bigint, venue_raw string, venue_type string, venue_key string",
    )
    authors = spark.createDataFrame(
        [("0", "a", "Ann"), ("0", "a", "Ann"), ("1", "a", "An"), ("9", "a", "Zed"), ("9", "b", "Bob"), (None, "a", "No")],
        "paper_id string, author_id string, author_name string",
    )
    references = spark.createDataFrame([("0", "1"), ("0", "1"), ("1", "9"), ("9", "0"), (None, "0"), ("2", None)], "paper_id string, ref_id string")
    fields = spark.createDataFrame([("0", "x")], "paper_id string, primary_field string")
    return B.PaperTables(papers, authors, references, fields)


def test_stored_tables_give_the_same_graph(spark):
    tables = paper_tables(spark)
    stored = tables.stored()
    for build in (B.build_vertices, B.build_edges):
        assert sorted(map(str, build(tables).collect())) == sorted(map(str, build(stored).collect()))
    assert {r.src for r in B.build_wrote_edges(stored).collect()} == {"A:a"}
    assert [(r.src, r.dst) for r in B.build_cites_edges(stored).collect()] == [("P:0", "P:1")]


def test_ids_of_papers_are_not_broadcast(spark):
    """They are small on disk and large in memory; what is stored is not looked up once more."""
    stored = paper_tables(spark).stored()
    plans = {build: build(stored)._jdf.queryExecution().executedPlan().toString() for build in (B.build_wrote_edges, B.build_cites_edges)}
    assert not any("Broadcast" in plan for plan in plans.values())
    assert "Join" not in plans[B.build_wrote_edges]
    assert plans[B.build_cites_edges].count("SortMergeJoin") == 1


def test_tasks_read_a_bounded_part(spark):
    files, shuffles = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = [spark.conf.get(key) for key in (files, shuffles)]
    try:
        spark.conf.set(files, "134217728b")
        spark.conf.set(shuffles, "48m")
        durable(spark.range(3))
        assert [spark.conf.get(key) for key in (files, shuffles)] == ["8m", "48m"]  # a caller's value stays
        bounded_tasks(spark)
        assert [spark.conf.get(key) for key in (files, shuffles)] == ["8m", "48m"]
    finally:
        for key, value in zip((files, shuffles), before, strict=True):
            spark.conf.set(key, value)


def test_partitions_and_buckets_grow_with_the_rows(spark, make_graph, monkeypatch):
    """Adaptive execution never cuts a partition, so a fixed number of them would grow with the tables."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with pytest.raises(ZeroDivisionError), partitions_for(spark, 10 * sessions.PARTITION_ROWS):
        assert spark.conf.get(key) == "10"
        1 / 0
    with partitions_for(spark, 1):
        assert spark.conf.get(key) == before
    graph = make_graph(GOLDEN)
    searches = {
        "ranks": lambda: sorted((r["id"], round(r["pagerank"], 9)) for r in pagerank(graph).collect()),
        "labels": lambda: sorted(map(tuple, label_propagation(graph).collect())),
        "hops": lambda: sorted(map(str, landmark_distances(graph, graph.vertices.filter("id = '3'").select("id"), max_hops=2).collect())),
    }
    plain = {name: search() for name, search in searches.items()}
    found = []

    @contextmanager
    def seen(*args, **options):
        with bucketed(*args, **options) as table:
            found.append(int(spark.conf.get(key)))  # as many as there are buckets
            yield table

    monkeypatch.setattr(sessions, "PARTITION_ROWS", 1)
    for module in (ranking, paths):
        monkeypatch.setattr(module, "bucketed", seen)
    assert {name: search() for name, search in searches.items()} == plain
    assert len(found) >= 3 and min(found) >= 7
    assert spark.conf.get(key) == before


def moves(df) -> int:
    """How often rows are moved by hash in the plan."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def sold(spark, folder, orders: int = 60):
    """Orders that nearly all hold part 1, lines without a part, an order or a supplier, and lines and orders that come twice."""
    lines = [(o, part, o % 3) for o in range(orders) for part in {1, 2 + o % 5}]
    lines += [(3, 1, 0), (3, 1, 0), (4, None, 1), (9, None, 2), (None, 1, 1), (None, None, 1), (7, 1, None), (8, 1, 77)]
    dated = [(o, datetime(1996 + o % 3, 1 + o * 7 % 12, 1 + o % 28)) for o in range(orders)] + [(5, datetime(1996 + 5 % 3, 12, 6)), (2, None)]
    tables = {
        "lineitem": ([(o, p, s, 1.0 + (o or 0) % 4) for o, p, s in lines], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double"),
        "orders": (dated, "o_orderkey bigint, o_orderdate timestamp_ntz"),
        "supplier": ([(0, 0), (1, 1), (1, 0), (2, None), (2, 1)], "s_suppkey bigint, s_nationkey int"),
        "nation": ([(0, "FRANCE"), (1, "PERU"), (1, "PERU")], "n_nationkey int, n_name string"),
        "part": ([(1, "x"), (1, "y"), (2, "x"), (3, None), (4, "z"), (None, "x")], "p_partkey bigint, p_brand string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return inputs_module.Inputs(spark, str(folder)), lines, dated


def test_references_look_up_hot_parts_by_month(spark, tmp_path, monkeypatch):
    """The order before that has the same part, whether the part is looked up as a whole or month by month."""
    fresh, lines, dated = sold(spark, tmp_path)
    bought = sorted(
        ((p is not None, p or 0), (d is not None, d or datetime.min), o) for o, p in {(o, p) for o, p, _ in lines if o is not None} for at, d in dated if at == o
    )
    expected = {(str(b[2]), str(a[2])) for a, b in zip(bought, bought[1:]) if a[0] == b[0]}
    found = [tuple(r) for r in fresh.references.collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    monkeypatch.setattr(inputs_module, "HEAVY_ROWS", 4)
    monkeypatch.setattr(inputs_module, "SAMPLED", 1)
    by_month = inputs_module.Inputs(spark, str(tmp_path)).references
    assert "month" in by_month._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, by_month.collect())) == sorted(found)


def test_derived_views_are_those_of_their_sql(spark, tmp_path):
    fresh, _, _ = sold(spark, tmp_path)
    for name in ("p_author", "p_field"):
        for table in ("lineitem", "supplier", "nation", "part"):
            fresh.table(table).createOrReplaceTempView(table)
        plain = spark.sql(SHARED_VIEWS[name])
        assert fresh.view(name).columns == plain.columns
        assert sorted(map(str, fresh.view(name).collect())) == sorted(map(str, plain.collect()))


def test_lines_move_once_to_their_paper(spark, tmp_path):
    """Not once more to be told apart, summed by field or matched with the papers."""
    fresh, _, _ = sold(spark, tmp_path)
    papers = spark.range(9).select(F.col("id").cast("string").alias("id"))
    assert moves(B.heaviest_field(fresh.paper_fields)) == 1
    assert moves(B.in_scope(fresh.authors, papers)) == 2  # one is that of the papers
    # lines by order, by part and by citing paper
    assert moves(B.in_scope(fresh.references, papers)) <= 5
    assert moves(B.build_wrote_edges(paper_tables(spark).stored())) == 0


def test_edges_move_once_into_their_buckets(spark, make_graph, monkeypatch):
    graph, found = make_graph([*GOLDEN, *GOLDEN[:2]]), []

    @contextmanager
    def seen(df, *keys, **options):
        found.append((options.get("placed"), moves(df)))
        with bucketed(df, *keys, **options) as table:
            yield table

    for module in (ranking, paths):
        monkeypatch.setattr(module, "bucketed", seen)
    plain = {r["id"]: r["pagerank"] for r in pagerank(graph).collect()}
    assert len(landmark_distances(graph, graph.vertices.filter("id = '3'").select("id"), max_hops=2).collect())
    assert found[0][0] and found[0][1] <= 2  # the second is that of the counts by source
    assert found[1] == (True, 1)
    # hubs split over salts have the same ranks
    monkeypatch.setattr(ranking.Salting, "measure_counts", classmethod(lambda cls, *a, **k: cls(("1", "3"), 4)))
    salted = {r["id"]: r["pagerank"] for r in pagerank(graph).collect()}
    assert salted.keys() == plain.keys() and all(abs(salted[v] - plain[v]) < 1e-9 for v in plain)


def test_specialised_venues_count_all_fields(spark):
    fields = {"V:one": ["Brand#10"] * 10, "V:few": ["Brand#10"] * 9, "V:two": ["Brand#1"] * 10 + ["Brand#11"]}
    papers = [(f"P:{venue}{i}", f, venue) for venue, each in fields.items() for i, f in enumerate(each)]
    kinds = "id string, node_type string, primary_field string, name string"
    vertices = [(p, "paper", f, None) for p, f, _ in papers] + [(v, "venue", None, v[2:]) for v in fields]
    edges = spark.createDataFrame([(p, v, "published_in") for p, _, v in papers], "src string, dst string, rel_type string")
    t = SimpleNamespace(graph=PropertyGraph(spark.createDataFrame(vertices, kinds), edges), fields=FIXTURE_FIELDS)
    assert [tuple(row) for row in graph_queries.specialised_venues(t).collect()] == [("V:one", "one", 10)]


def exchanges(df):
    """Keys of the plan's hash exchanges, without the columns' numbers."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"hashpartitioning\((.*?), \d+\)", plan)]


@pytest.mark.parametrize("hot_rows", [10**9, 2])
def test_pairs_are_counted_where_their_first_item_is(spark, monkeypatch, hot_rows):
    """Lists of items move, not a row per pair; items of very many contexts are counted before they move."""
    monkeypatch.setattr(overlap, "HEAVY_ROWS", hot_rows)
    monkeypatch.setattr(overlap, "heavy_keys", lambda df, key: ["i03", "i07"])
    rng = random.Random(5)
    rows = {(f"i{rng.randrange(20):02d}", f"c{rng.randrange(30):02d}") for _ in range(200)}
    expected = Counter()
    for context in {c for _, c in rows}:
        expected.update(itertools.combinations(sorted(i for i, c in rows if c == context), 2))
    df = spark.createDataFrame(sorted(rows), "item string, context string")
    found = overlap.shared_pairs(df, item="item", context="context")
    assert {(r["a"], r["b"]): r["shared"] for r in found.collect()} == {k: n for k, n in expected.items() if n > 1}
    assert ("a, b" in exchanges(found)) == (hot_rows == 2) and "a" in exchanges(found)


@pytest.mark.parametrize("heavy", [512, 3])
def test_triangles_close_where_the_middle_vertex_is(spark, make_graph, heavy):
    edges = random_edges(8, n=30, m=140)
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = P.triangle_count(make_graph(edges, ["alone"]), heavy=heavy, block=2)
        moved = exchanges(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = {v: sum(b in near[a] for a, b in itertools.combinations(sorted(near[v]), 2)) for v in [*near, "alone"]}
    assert values(found, "id", "triangles") == expected
    assert ("x, y" in moved) == (heavy == 3)


@pytest.mark.parametrize("hot_rows", [10**6, 2])
def test_votes_move_once(make_graph, monkeypatch, hot_rows):
    """A round shuffles votes by vertex only; where a vertex is hot they are added up by label first."""
    plans, measure = [], skew.Salting.measure_counts.__func__
    monkeypatch.setattr(skew.Salting, "measure_counts", classmethod(lambda cls, *a: measure(cls, *a, min_rows=hot_rows, salts=2)))
    monkeypatch.setattr(ranking, "durable", lambda df, label: plans.append(exchanges(df)) or durable(df, label))
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("c", "d"), ("e", "f")]
    found = label_propagation(make_graph(edges, ["g"]), max_iter=1)
    assert values(found, "id", "label") == {"a": "b", "b": "a", "c": "d", "d": "c", "e": "f", "f": "e", "g": "g"}
    assert plans == [["to", "to, label"] if hot_rows == 2 else ["to"]]


def test_lists_of_nested_papers_move_once(spark, inputs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        moved = exchanges(inputs.nested_papers)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [keys for keys in moved if "coalesce" in keys]
