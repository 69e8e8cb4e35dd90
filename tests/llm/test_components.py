import random

from pathweave.llm.components import components


def test_chains_stars_and_loops(spark):
    random.seed(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(500, 500 + i) for i in range(1, 300)] + [(900, 900), (None, 3)]
    edges += [(random.randrange(1000, 1200), random.randrange(1000, 1200)) for _ in range(150)]
    random.shuffle(edges)
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in parent}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
