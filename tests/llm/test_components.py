import random

from pricetide.llm.components import connected_components


def brute(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def test_components_of_chains_stars_and_random_graphs(spark):
    rng = random.Random(1)
    chain = [(i, i + 1) for i in range(1000, 1060)]
    star = [(2000, 2000 + i) for i in range(1, 200)]
    other = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges = chain + star + other + [(5, None), (None, 5), (7, 7), (1000, 1001)]
    rng.shuffle(edges)
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.component for r in got} == brute(edges)


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
