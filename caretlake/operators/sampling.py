"""Deterministic sampling, caps and first-wins removal of duplicates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caretlake.functions.hashing import uniform

SEED = 20261009


def weight_of(kind: Column, weights: Mapping[str, float]) -> Column:
    """The weight of a kind; kinds without one have 0."""
    return F.coalesce(F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))])[kind], F.lit(0.0))


def keep_weighted(df: DataFrame, u: Column, weight: Column) -> DataFrame:
    """Rows whose number lies under their weight, with ``score = u / weight``; lower scores are kept first by caps."""
    return df.withColumn("u_", u).withColumn("w_", weight).where("w_ > 0 AND u_ < w_").withColumn("score", F.col("u_") / F.col("w_")).drop("u_", "w_")


def cap(df: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """At most ``n`` rows per group, the first in ``order``, which must be total; 0 means no cap."""
    if n <= 0:
        return df
    return df.withColumn("rank_", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank_") <= n).drop("rank_")


def first_wins(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; a row that is thinned out later still stands for its duplicates."""
    return cap(df, key, order, 1)


def split_of(group: Column, evaluation: float, test: float, seed: str = str(SEED)) -> Column:
    """validation, test or train by a hash of the group."""
    u = uniform(F.lit(seed), F.lit("repo_split"), group)
    return F.when(u < evaluation, "validation").when(u < evaluation + test, "test").otherwise("train")


def thinning_fractions(counts: DataFrame, most: int, test_share: float) -> DataFrame:
    """Adds keep and test_keep to rows of (total, tests): at most ``most`` rows, at most a share of them tests."""
    keep = F.least(F.lit(1.0), F.lit(float(most)) / F.col("total"))
    rest = F.col("total") - F.col("tests")
    over = (F.col("tests") > 0) & (keep * F.col("tests") > F.lit(test_share) * keep * F.col("total"))
    test_keep = F.when(over, F.when(rest > 0, F.least(F.lit(1.0), F.lit(test_share / (1 - test_share)) * rest / F.col("tests"))).otherwise(1.0)).otherwise(1.0)
    d = counts.withColumn("test_keep", test_keep)
    again = F.least(F.lit(1.0), F.lit(float(most)) / (rest + F.col("tests") * F.col("test_keep")))
    return d.withColumn("keep", F.when(over, again).otherwise(keep))


def thin(df: DataFrame, sample_id: str, is_test: str, keep: Column, test_keep: Column, seed: str = str(SEED)) -> DataFrame:
    u = uniform(F.lit(seed), F.lit("keep"), F.col(sample_id))
    return df.where(u < keep * F.when(F.col(is_test), test_keep).otherwise(1.0))


def repo_cap(df: DataFrame, repo: str, sample_id: str, n: int, seed: str = str(SEED)) -> DataFrame:
    """The ``n`` rows of each repository with the smallest hash, ties by position."""
    u = uniform(F.lit(seed), F.lit("repo_cap"), F.col(sample_id))
    return cap(df.withColumn("u_", u), [repo], [F.col("u_"), F.col("relative_path"), F.col("caret_byte_offset"), F.col(sample_id)], n).drop("u_")


def first_owner(claims: DataFrame, key: str, owner: str, order: list[str]) -> DataFrame:
    """(key, owner): the owner of each key is the first in ``order``, then by name, whatever order jobs ended in."""
    return claims.groupBy(key).agg(F.min_by(owner, F.struct(*order, owner)).alias(owner))


def batches(repos: DataFrame, target: int, order: str = "repo_id", size: str = "samples") -> DataFrame:
    """The repositories taken in order until twice the target is reached; the one that crosses it is still taken.

    The running sum is taken in two steps: rows are put into ranges of the order, sums per range are taken first, and
    rows are summed only within their range, so that no task orders everything. Null sizes count 0.
    """
    spark = repos.sparkSession
    d = repos.withColumn("size_", F.coalesce(F.col(size), F.lit(0)))
    named = d.select(order).where(F.col(order).isNotNull())
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    edges = [r[0] for r in named.repartitionByRange(n, order).groupBy(F.spark_partition_id().alias("p")).agg(F.min(order).alias("lo")).orderBy("lo").select("lo").collect()]  # one a partition
    part = F.size(F.filter(F.array(*map(F.lit, edges[1:])), lambda e: e <= F.col(order))) if len(edges) > 1 else F.lit(0)
    d = d.withColumn("part_", F.when(F.col(order).isNull(), 0).otherwise(part))
    sums = sorted((r["part_"], r["s"]) for r in d.groupBy("part_").agg(F.sum("size_").alias("s")).collect())
    ahead, total = [], 0
    for k, s in sums:
        ahead.append((k, total))
        total += s
    base = F.broadcast(spark.createDataFrame(ahead or [(0, 0)], "part_ int, ahead_ bigint"))
    w = Window.partitionBy("part_").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    d = d.join(base, "part_").withColumn("before", F.col("ahead_") + F.coalesce(F.sum("size_").over(w), F.lit(0)))
    return d.where(F.col("before") < 2 * target).drop("part_", "size_", "ahead_")
