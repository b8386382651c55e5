"""Splits that keep related records together: hash-to-min components, then weighted rendezvous hashing."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretlake.functions.labels import clean_name, clean_split
from caretlake.operators.components import hash_to_min

DEFAULT_SHARES = {"train": 0.9, "validation": 0.05, "test": 0.05}


def related_sets(jobs: DataFrame, samples: DataFrame) -> DataFrame:
    """(repository_id, component) of every repository that jobs or samples name; a repository without ties is alone."""
    ties = jobs.select(F.col("repo_id").alias("repo"), clean_name(F.col("grp")).alias("g")).union(
        samples.select(F.col("repository_id").alias("repo"), clean_name(F.col("split_group")).alias("g"))
    )
    ties = ties.where("repo IS NOT NULL").distinct()
    repo = F.concat(F.lit("r|"), "repo")
    edges = ties.select(repo.alias("a"), F.coalesce(F.concat(F.lit("g|"), "g"), repo).alias("b"))
    found = hash_to_min(edges).where(F.col("node").startswith("r|"))
    return found.select(F.expr("substring(node, 3)").alias("repository_id"), "component")


def broken_ties(jobs: DataFrame, samples: DataFrame) -> DataFrame:
    """(repository_id, component, splits): repositories with a split whose related set carries several splits today."""
    carried = samples.select("repository_id", clean_split(F.col("split")).alias("split")).where("split IS NOT NULL AND repository_id IS NOT NULL").distinct()
    at = carried.join(related_sets(jobs, samples), "repository_id")
    torn = at.groupBy("component").agg(F.array_sort(F.collect_set("split")).alias("splits")).where(F.size("splits") > 1)
    return at.select("repository_id", "component").distinct().join(torn, "component").select("repository_id", "component", "splits")


def uniform(*parts: Column) -> Column:
    """A uniform number in (0, 1) from the SHA-256 of the joined parts."""
    bits = F.conv(F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 13), 16, 10).cast("bigint")
    return (bits.cast("double") + 0.5) / F.lit(2.0**52)


def assign_splits(sized: DataFrame, shares: Mapping[str, float] = DEFAULT_SHARES, seed: str = "20261009") -> DataFrame:
    """(component, size, split) for ``sized`` (component, size), with shares of the total size near ``shares``.

    Weighted rendezvous hashing: a component goes to the split of the largest ``-weight / ln(uniform)``; adding or
    removing a component moves no other, and a changed share moves only what it must. A component larger than a tenth
    of the smallest share would upset the proportions wherever chance put it: such large ones, of which there are at
    most ``10 / smallest share`` by arithmetic, are placed first, largest first, each where most is missing, and the
    weights of the others are what is left of the shares. Null components are dropped; sizes that are null count 0.
    """
    total_share = sum(shares.values())
    want = {k: v / total_share for k, v in shares.items() if v > 0}
    sized = sized.where("component IS NOT NULL").select("component", F.coalesce(F.col("size").cast("bigint"), F.lit(0)).alias("size"))
    total = sized.agg(F.sum("size")).first()[0] or 0
    limit = total * min(want.values()) / 10
    large = sized.where(F.col("size") > limit).orderBy(F.desc("size"), "component").collect() if total else []  # at most 10 / min share rows
    left = {k: v * total for k, v in want.items()}
    placed = []
    for r in large:
        k = max(left, key=lambda s: (left[s], s))
        left[k] -= r["size"]
        placed.append((r["component"], r["size"], k))
    weights = {k: max(v, 0.0) for k, v in left.items()}
    if sum(weights.values()) <= 0:
        weights = dict(want)
    score = F.array(*[
        F.struct((F.lit(-w) / F.log(uniform(F.lit(seed), F.lit("split"), F.lit(k), F.col("component")))).alias("score"), F.lit(k).alias("split"))
        for k, w in weights.items() if w > 0
    ])
    small = sized.where(F.col("size") <= limit).select("component", "size", F.array_max(score)["split"].alias("split"))
    if not placed:
        return small
    return small.unionByName(sized.sparkSession.createDataFrame(placed, "component string, size bigint, split string"))


def grouped_splits(jobs: DataFrame, samples: DataFrame, shares: Mapping[str, float] = DEFAULT_SHARES, seed: str = "20261009") -> DataFrame:
    """(repository_id, component, samples, split): one row per repository; the split of all its samples."""
    sets = related_sets(jobs, samples)
    counts = samples.groupBy("repository_id").agg(F.count("*").alias("samples"))
    repos = sets.join(counts, "repository_id", "left").select("repository_id", "component", F.coalesce("samples", F.lit(0)).alias("samples"))
    sizes = repos.groupBy("component").agg(F.sum("samples").alias("size"))
    return repos.join(assign_splits(sizes, shares, seed).drop("size"), "component").select("repository_id", "component", "samples", "split")
