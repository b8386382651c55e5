import random

from caretlake.operators.components import hash_to_min


def union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in parent}


def test_components_equal_union_find(spark):
    rnd = random.Random(4)
    edges = [(f"n{rnd.randrange(150)}", f"n{rnd.randrange(150)}") for _ in range(110)]
    edges += [(f"c{i}", f"c{i + 1}") for i in range(60)]  # a long chain
    edges += [("hub", f"s{i}") for i in range(200)]  # a hot component
    edges += [("alone", "alone"), (None, "x"), ("y", None), edges[0]]
    df = spark.createDataFrame(edges, "a string, b string")
    for hot in (1 << 18, 50):
        assert {r["node"]: r["component"] for r in hash_to_min(df, hot=hot).collect()} == union_find(edges)
    assert hash_to_min(spark.createDataFrame([], "a string, b string")).count() == 0
