import random

from weavemine.operators.components import connected_components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


def test_components_match_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges = [e for e in edges if e[0] != e[1]]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == brute(edges)


def test_components_of_nothing_and_nulls(spark):
    df = spark.createDataFrame([(None, 1), (2, 2), (3, None)], "src long, dst long")
    assert connected_components(df).count() == 0
