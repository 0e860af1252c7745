import random

import pytest

from fleetschema.operators.graph import (
    closure_by_recursion,
    cycle_members,
    dependency_closure,
    dependency_edges,
    dependency_paths,
    recreation_order,
    strongly_connected,
)

EDGE, NODE = "db_id int, ref_oid long, view_oid long", "db_id int, oid long"


def closure(spark, edges, seeds, max_depth=None, db=1):
    e = spark.createDataFrame([(db, a, b) for a, b in edges], EDGE)
    s = spark.createDataFrame([(db, n) for n in seeds], NODE)
    out = dependency_closure(e, s, max_depth).collect()
    assert len({(r["db_id"], r["oid"]) for r in out}) == len(out)
    return {r["oid"]: r["depth"] for r in out}


def order(spark, edges, nodes, db=1):
    e = spark.createDataFrame([(db, a, b) for a, b in edges], EDGE)
    out = recreation_order(e, spark.createDataFrame([(db, n) for n in nodes], NODE)).collect()
    return {r["oid"]: (r["level"], r["in_cycle"]) for r in out}


def test_chain(spark):
    chain = [(i, i + 1) for i in range(1, 6)]
    assert closure(spark, chain, [1]) == {i: i for i in range(1, 7)}
    assert closure(spark, chain, [1], max_depth=3) == {1: 1, 2: 2, 3: 3}
    assert order(spark, chain, range(1, 7)) == {i: (i, False) for i in range(1, 7)}


def test_diamond_takes_shallow_depth_and_deep_level(spark):
    edges = [(1, 2), (2, 3), (3, 4), (1, 4)]
    assert closure(spark, edges, [1]) == {1: 1, 2: 2, 3: 3, 4: 2}
    assert order(spark, edges, [1, 2, 3, 4]) == {1: (1, False), 2: (2, False), 3: (3, False), 4: (4, False)}


def test_cycle_ends_and_comes_last(spark):
    edges = [(1, 2), (2, 3), (3, 2), (3, 4), (5, 6), (7, 7)]
    assert closure(spark, edges, [1]) == {1: 1, 2: 2, 3: 3, 4: 4}
    got = order(spark, edges, range(1, 8))
    assert {n for n, (_, c) in got.items() if c} == {2, 3, 4}
    assert {n: l for n, (l, c) in got.items() if not c} == {1: 1, 5: 1, 6: 2, 7: 1}
    assert {l for l, c in got.values() if c} == {3}


def test_only_a_cycle(spark):
    assert order(spark, [(1, 2), (2, 1)], [1, 2]) == {1: (1, True), 2: (1, True)}


def test_empty(spark):
    assert closure(spark, [(1, 2)], []) == {}
    assert order(spark, [(1, 2)], []) == {}
    assert order(spark, [], [1]) == {1: (1, False)}


def test_edges_outside_the_nodes_do_not_count(spark):
    assert order(spark, [(1, 2), (2, 3)], [1, 3]) == {1: (1, False), 3: (1, False)}


def test_databases_stay_apart(spark):
    e = spark.createDataFrame([(1, 1, 2), (2, 2, 3)], EDGE)
    out = dependency_closure(e, spark.createDataFrame([(1, 1)], NODE)).collect()
    assert {(r["db_id"], r["oid"]) for r in out} == {(1, 1), (1, 2)}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graph_against_python(spark, seed):
    r = random.Random(seed)
    n = 60
    edges = [(a, b) for a in range(n) for b in range(n) if a < b and r.random() < 0.05]
    edges += [(0, i) for i in range(20, n)]  # one node that most others read
    longest = {}
    for b in range(n):
        longest[b] = 1 + max((longest[a] for a, x in edges if x == b), default=0)
    assert order(spark, edges, range(n)) == {k: (v, False) for k, v in longest.items()}
    depth, frontier = {0: 1}, {0}
    while frontier:
        frontier = {b for a, b in edges if a in frontier and b not in depth}
        depth.update({b: max(depth.values()) + 1 for b in frontier})
    assert closure(spark, edges, [0]) == depth


def test_edges_from_raw_dependencies(spark):
    depends = spark.createDataFrame(
        [(1, 50, 10, "n"), (1, 50, 10, "n"), (1, 50, 20, "i"), (1, 50, 20, "n"), (2, 50, 11, "n")],
        "db_id int, objid long, refobjid long, deptype string",
    )
    rewrite = spark.createDataFrame([(1, 50, 20), (2, 50, 21)], "db_id int, oid long, ev_class long")
    out = dependency_edges(depends, rewrite).collect()
    assert sorted(tuple(r) for r in out) == [(1, 10, 20), (2, 11, 21)]


# ---- cycles and paths -------------------------------------------------------


def components(spark, edges):
    e = spark.createDataFrame([(1, a, b) for a, b in edges], EDGE)
    out = strongly_connected(e).collect()
    assert len({(r["db_id"], r["oid"]) for r in out}) == len(out)
    return {r["oid"]: r["component"] for r in out}


def reaches(edges):
    """(a, b): b can be reached from a by one edge or more."""
    out = set(edges)
    while True:
        more = out | {(a, d) for a, b in out for c, d in edges if b == c}
        if more == out:
            return out
        out = more


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 9)]
    assert components(spark, chain) == {} and components(spark, []) == {}
    # two cycles joined by an edge, what leads to them and what lies behind, a self edge alone and one on a cycle
    edges = [(1, 2), (2, 3), (3, 4), (4, 2), (4, 5), (5, 6), (6, 7), (7, 6), (7, 8), (9, 9), (3, 3)]
    assert components(spark, edges) == {2: 2, 3: 2, 4: 2, 6: 6, 7: 6, 9: 9}
    two = spark.createDataFrame([(1, 1, 2), (2, 2, 1), (3, 1, 2), (3, 2, 1)], EDGE)
    assert {tuple(r) for r in strongly_connected(two).collect()} == {(3, 1, 1), (3, 2, 1)}


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_components_of_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = {(r.randrange(40), r.randrange(40)) for _ in range(55)}
    reach = reaches(edges)
    want = {a: min(b for b in range(40) if (a, b) in reach and (b, a) in reach) for a in range(40) if (a, a) in reach}
    assert components(spark, edges) == want


@pytest.mark.parametrize("seed", [6, 7])
def test_paths_of_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = sorted({(r.randrange(30), r.randrange(30)) for _ in range(60)})
    e = spark.createDataFrame([(1, a, b) for a, b in edges], EDGE)
    seeds = spark.createDataFrame([(1, 0), (1, 1)], NODE)
    best, level = {0: [0], 1: [1]}, {0: [0], 1: [1]}
    while level:
        following = {}
        for a, b in edges:
            if a in level and b not in best:
                following[b] = min(following.get(b, [99]), level[a] + [b])
        best |= following
        level = following
    reach = reaches(edges)
    got = {x["oid"]: (x["depth"], x["path"], x["is_cycle"]) for x in dependency_paths(e, seeds).collect()}
    assert got == {n: (len(p), p, (n, n) in reach) for n, p in best.items()}
    some = {x["oid"]: x["depth"] for x in dependency_paths(e, seeds, max_depth=2).collect()}
    assert some == {n: len(p) for n, p in best.items() if len(p) <= 2}
    assert {x["oid"]: x["depth"] for x in closure_by_recursion(e, seeds).collect()} == {n: len(p) for n, p in best.items()}


def test_recursion_says_when_it_is_too_deep(spark):
    chain = spark.createDataFrame([(1, i, i + 1) for i in range(1, 140)], EDGE)
    seed = spark.createDataFrame([(1, 1)], NODE)
    assert closure_by_recursion(chain, seed, max_depth=50).count() == 50
    with pytest.raises(ValueError, match="use dependency_closure"):
        closure_by_recursion(chain, seed, max_depth=1000).count()


def test_members_of_a_cycle_and_what_lies_behind(spark):
    edges = [(1, 2), (2, 3), (3, 2), (3, 4), (4, 5), (6, 5), (7, 7), (8, 9), (9, 8), (5, 8), (9, 10)]
    e = spark.createDataFrame([(1, a, b) for a, b in edges], EDGE)
    nodes = spark.createDataFrame([(1, n) for n in range(1, 11)], NODE)
    got = {r["oid"]: tuple(r)[3:] for r in cycle_members(recreation_order(e, nodes), e).collect()}
    free = {n: (False, False, None) for n in (1, 6, 7)}
    assert got == free | {2: (True, False, 2), 3: (True, False, 2), 8: (True, False, 8), 9: (True, False, 8)} | {
        n: (False, True, None) for n in (4, 5, 10)
    }
