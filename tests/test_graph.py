"""Connected components against union-find: random graphs, a long chain
(many hops, few rounds) and a hub holding a third of all edges."""

import random

from tidewater.operators import graph
from tidewater.operators.graph import connected_components


def _union_find(edges):
    parent = {}

    def find(a):
        parent.setdefault(a, a)
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        return a

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    comp = {}
    for n in list(parent):
        r = find(n)
        comp[r] = min(comp.get(r, n), n)
    return {n: comp[find(n)] for n in parent}


def _run(spark, edges):
    df = spark.createDataFrame(edges, "src long, dst long")
    return {r.node: r.component for r in connected_components(df).collect()}


def test_random_graphs(spark):
    rng = random.Random(5)
    for n, m in [(30, 20), (200, 150), (500, 900)]:
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        edges = [(a, b) for a, b in edges if a != b]
        assert _run(spark, edges) == _union_find(edges)


def test_long_chain_converges_in_few_rounds(spark, monkeypatch):
    # ids shuffled along the chain, so the minimum sits in the middle
    ids = list(range(2000))
    random.Random(1).shuffle(ids)
    edges = list(zip(ids[:-1], ids[1:]))
    monkeypatch.setattr(graph, "SAFETY_ROUNDS", 40)
    got = _run(spark, edges)
    assert set(got.values()) == {0} and len(got) == 2000


def test_hub_and_self_loops(spark):
    hub = [(7, i) for i in range(100, 400)]  # a third of the edges at one node
    other = [(i, i + 1) for i in range(1000, 1600)] + [(5, 5)]
    edges = hub + other
    want = _union_find([e for e in edges if e[0] != e[1]])
    assert _run(spark, edges) == want
