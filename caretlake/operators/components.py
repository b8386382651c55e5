"""Connected components by hash-to-min.

Each node holds a cluster of nodes, at first itself and its neighbours. In a round it sends its cluster to the
cluster's smallest node, and that smallest node to every member; received parts are united. When nothing changes,
the smallest node of a component holds the whole component and every other node holds just the smallest one. The
number of rounds is about the logarithm of the longest path. Clusters are rows (node, member), never arrays, so that
a component of a third of all nodes is no row and no group that must fit into memory; smallest members are found with
partial aggregation, and rows of the few clusters of more than ``HOT`` members meet their minimum through a broadcast of
at most ``rows / HOT`` rows, so that no cluster is one task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caretlake.session import discard, materialise

MAX_ROUNDS = 64
HOT = 1 << 18


def _with_minimum(cluster: DataFrame, rows: int, hot: int) -> DataFrame:
    """(v, u, m): the rows of ``cluster`` with the smallest member of each cluster."""
    low = cluster.groupBy("v").agg(F.min("u").alias("m"), F.count("*").alias("n"))
    if rows <= hot:
        return cluster.join(low.select("v", "m"), "v")
    low = materialise(low, "minima")
    few = F.broadcast(low.where(F.col("n") > hot).select("v", "m"))  # at most rows / hot of them
    return cluster.join(few, "v", "left_anti").join(low.where(F.col("n") <= hot).select("v", "m"), "v").unionByName(cluster.join(few, "v"))


def hash_to_min(edges: DataFrame, a: str = "a", b: str = "b", hot: int = HOT) -> DataFrame:
    """(node, component): the component of each node, named by its smallest node.

    Rows with a null end are dropped; an edge of a node to itself states that the node exists. Repeated edges and
    both directions make no difference. No edges give no rows.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    cluster = e.select(F.explode(F.expr("array(struct(a AS v, a AS u), struct(a AS v, b AS u), struct(b AS v, a AS u), struct(b AS v, b AS u))")).alias("x"))
    cluster = materialise(cluster.select("x.v", "x.u").distinct(), "cluster")
    state = None
    for _ in range(MAX_ROUNDS):
        now = cluster.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        sent = _with_minimum(cluster, now[0], hot).select(F.explode(F.expr("array(struct(m AS v, u AS u), struct(u AS v, m AS u))")).alias("x"))
        old, cluster = cluster, materialise(sent.select("x.v", "x.u").distinct(), "cluster")
        discard(old)
    else:
        raise RuntimeError(f"no stable state after {MAX_ROUNDS} rounds")
    return cluster.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
