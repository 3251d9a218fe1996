"""Reachability by doubling paths against a plain search."""

import random
from collections import deque

from fleetlake.operators import paths
from fleetlake.warehouse import load


def search(edges, start):
    out, queue = {s: 0 for s in start}, deque(start)
    while queue:
        a = queue.popleft()
        for x, y in edges:
            if x == a and y is not None and y not in out:
                out[y] = out[a] + 1
                queue.append(y)
    return out


def run(spark, edges, start, **options):
    found, rounds = paths.reach(spark.createDataFrame(edges, "source string, target string"), spark.createDataFrame([(s,) for s in start], "node string"), **options)
    return {r.node: r.depth for r in found.collect()}, rounds


def test_a_chain_of_a_thousand_levels(spark):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(1000)]
    got, rounds = run(spark, edges, ["n0"])
    assert got == {f"n{i}": i for i in range(1001)}
    assert rounds <= 12


def test_random_graphs_with_cycles(spark):
    rng = random.Random(5)
    for n, m in ((30, 40), (40, 200)):
        edges = [(f"v{rng.randrange(n)}", f"v{rng.randrange(n)}") for _ in range(m)]
        edges += [(f"c{i}", f"c{(i + 1) % 23}") for i in range(23)] + [("v1", "c0"), ("c5", "v2"), ("v3", None), (None, "v4"), ("v1", "c0")]
        for start in (["v1"], ["v2", "c7", "nowhere"]):
            got, _ = run(spark, edges, start)
            assert got == search(edges, start)


def test_without_room_to_double_the_result_is_the_same(spark):
    edges = [(f"n{i}", f"n{i + 1}") for i in range(40)] + [(f"n{i}", f"leaf{i}-{j}") for i in range(0, 40, 4) for j in range(5)]
    want = search(edges, ["n0"])
    full, fast = run(spark, edges, ["n0"])
    short, slow = run(spark, edges, ["n0"], most_paths=200, per_edge=1)
    assert full == short == want
    assert fast < slow < 41


def test_the_size_of_doubling_is_known_before(spark):
    own = spark.createDataFrame([("a", "b", 1), ("c", "b", 1), ("b", "d", 1), ("b", "e", 1), ("e", "a", 1)], "a string, b string, d long")
    assert paths.doubled_size(own, 1) == 4 + 1 + 1
    assert {(r.a, r.b): r.d for r in paths.double(own, 1).collect()}[("c", "e")] == 2


def test_nothing_to_reach(spark):
    assert run(spark, [("a", "b")], ["z"]) == ({"z": 0}, 1)
    edges = spark.createDataFrame([], "source string, target string")
    assert load.lineage(edges, spark.createDataFrame([("a",)], "node string")).count() == 0


def test_only_paths_that_lead_on_are_doubled(spark):
    paths_ = spark.createDataFrame([(f"n{i}", f"n{i + 1}", 1) for i in range(10)] + [("n9", "n2", 1), ("m", "n1", 1), ("m", "n9", 1)], "a string, b string, d long")
    reached = spark.createDataFrame([(f"n{i}", i) for i in range(5)], "node string, depth long")
    got = {(r.a, r.b) for r in paths.ahead(paths_, reached, 4).collect()}
    assert got == {(f"n{i}", f"n{i + 1}") for i in range(4, 10)} | {("m", "n9")}
