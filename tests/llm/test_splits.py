import random

from pyspark.sql import functions as F

from caretlake.operators.components import hash_to_min
from caretlake.llm.splits import assign_splits, broken_ties, grouped_splits


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
    got = {r["node"]: r["component"] for r in hash_to_min(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == union_find(edges)
    assert hash_to_min(spark.createDataFrame([], "a string, b string")).count() == 0


JOBS = "repo_id string, grp string, split string, component string"
SAMPLES = "repository_id string, split_group string, split string, node string"


def test_broken_ties(spark):
    jobs = spark.createDataFrame([("a", " G1 ", "test", "x"), ("b", "g1", None, "x"), ("c", None, "train", "x"), ("d", "", "train", "x"), (None, "g1", "t", "x"), ("e", "g3", "t", "x"), ("a", "g1", "t", "y")], JOBS)
    samples = spark.createDataFrame(
        [("a", "g2", "train", "n"), ("b", None, None, "n"), ("f", "G2", " EVAL", "n"), ("c", None, "train", "n"), ("c", None, "Test", "n"), ("d", " ", "train", "n"), ("e", "g3", "val", "n"), ("e", "g3", "eval", "n"), (None, "g2", "test", "n"), ("a", "g2", "train", "n")],
        SAMPLES,
    )
    got = {r["repository_id"]: r["splits"] for r in broken_ties(jobs, samples).collect()}
    assert got == {"a": ["train", "validation"], "f": ["train", "validation"], "c": ["test", "train"]}
    assert broken_ties(jobs.limit(0), samples.limit(0)).count() == 0


def test_assignment_keeps_groups_together_near_the_shares(spark):
    n = 3000
    jobs = spark.createDataFrame([(f"r{i}", f"g{i // 3}" if i % 4 else None, None, None) for i in range(n)] + [(f"r{i}", "HUGE", None, None) for i in range(0, n, 90)], JOBS)
    samples = spark.createDataFrame([(f"r{i}", None, "train", None) for i in range(n) for _ in range(1 + i % 3)], SAMPLES)
    rows = grouped_splits(jobs, samples, {"train": 0.8, "validation": 0.1, "test": 0.1}).collect()
    assert len(rows) == n and len({r["repository_id"] for r in rows}) == n
    by = {}
    for r in rows:
        assert by.setdefault(r["component"], r["split"]) == r["split"]
    total = sum(r["samples"] for r in rows)
    for split, share in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
        assert abs(sum(r["samples"] for r in rows if r["split"] == split) / total - share) < 0.03


def test_assignment_is_stable_and_places_large_ones(spark):
    sized = spark.createDataFrame([(f"c{i}", 1) for i in range(500)] + [("big", 400), (None, 5), ("none", None)], "component string, size bigint")
    one = {r["component"]: r["split"] for r in assign_splits(sized).collect()}
    two = {r["component"]: r["split"] for r in assign_splits(sized.where("component <> 'c7'")).collect()}
    assert one["big"] == "train" and set(one) - set(two) == {"c7"} and len(one) == 502
    assert assign_splits(sized.limit(0)).count() == 0
    shares = spark.createDataFrame([(k, v) for k, v in one.items()], "c string, s string").groupBy("s").agg(F.count("*")).collect()
    assert len(shares) == 3
