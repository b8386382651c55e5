"""Counters, percentiles by rank, comparison of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_counters(samples: DataFrame) -> DataFrame:
    """(counter, value): totals, per kind, tests, per flag; one pass, summed partially before the shuffle."""
    one = lambda name: F.array(name)
    names = F.concat(
        one(F.lit("samples.total")), one(F.concat(F.lit("samples.kind."), "caret_kind")), F.when(F.col("is_test"), one(F.lit("samples.test_code"))).otherwise(F.array().cast("array<string>")),
        F.coalesce(F.transform("quality_flags", lambda x: F.concat(F.lit("samples.flag."), x)), F.array().cast("array<string>")),
    )
    return samples.select(F.explode(names).alias("counter")).where("counter IS NOT NULL").groupBy("counter").agg(F.count("*").alias("value"))


def rank_percentiles(df: DataFrame, by: list[str], value: str, points: dict[str, float], ranges: int = 64) -> DataFrame:
    """(*by, rows, each point): the value at place ``int(p * (n - 1) + 0.5)`` of the sorted values, no interpolation.

    Equal values are counted first. Distinct values are cut into ``ranges`` per group at sketched quantiles; rows ahead of
    a range are summed over ranges, and running counts are taken within a range only, so that no task orders a whole group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("c"))
    edges = counts.groupBy(*by).agg(F.percentile_approx(value, [k / ranges for k in range(1, ranges)], 10 * ranges).alias("edges"), F.sum("c").alias("rows"))
    cut = counts.join(edges, by)
    cut = cut.withColumn("part", F.size(F.filter("edges", lambda x: x < F.col(value)))).drop("edges")
    w = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = cut.groupBy(*by, "part").agg(F.sum("c").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(w), F.lit(0))).drop("n")  # at most ``ranges`` rows a group
    inner = Window.partitionBy(*by, "part").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    run = cut.join(ahead, [*by, "part"]).withColumn("upto", F.col("ahead") + F.sum("c").over(inner))
    at = {k: F.floor(F.lit(p) * (F.col("rows") - 1) + 0.5) for k, p in points.items()}
    hit = lambda k: F.max(F.when((at[k] < F.col("upto")) & (at[k] >= F.col("upto") - F.col("c")), F.col(value)))
    return run.groupBy(*by).agg(F.max("rows").alias("rows"), *[hit(k).alias(k) for k in points])


def throughput(samples: int, files: DataFrame, seconds: float) -> dict[str, float]:
    """Samples, files and MiB of source a second, over ``files`` with content."""
    n, size = files.agg(F.count("content"), F.coalesce(F.sum(F.octet_length("content").cast("bigint")), F.lit(0))).first()
    per = lambda v: round(v / seconds, 3) if seconds > 0 else 0.0
    return {"samples_per_sec": per(samples), "files_per_sec": per(n), "source_mib_per_sec": per(size / (1 << 20))}


def compare_records(a: DataFrame, b: DataFrame, key: list[str], scalars: list[str], lists: list[str]) -> DataFrame:
    """(outcome, records): full outer match on ``key``; identical, subset, superset, different, only_left, only_right.

    Lists are compared without order; subset means that every list of the left lies in the right one and scalars agree.
    """
    left, right = a.select(*key, *scalars, *lists).withColumn("in_a", F.lit(1)), b.select(*key, *scalars, *lists).withColumn("in_b", F.lit(1))
    for c in scalars + lists:
        right = right.withColumnRenamed(c, c + "_b")
    j = left.join(right, key, "full")
    same = F.lit(True)
    for c in scalars:
        same = same & F.col(c).eqNullSafe(F.col(c + "_b"))
    nn = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    sub, sup = F.lit(True), F.lit(True)
    for c in lists:
        sub = sub & (F.size(F.array_except(nn(c), nn(c + "_b"))) == 0)
        sup = sup & (F.size(F.array_except(nn(c + "_b"), nn(c))) == 0)
    outcome = (
        F.when(F.col("in_b").isNull(), "only_left").when(F.col("in_a").isNull(), "only_right").when(same & sub & sup, "identical")
        .when(same & sub, "subset").when(same & sup, "superset").otherwise("different")
    )
    return j.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("records"))


def count_by(df: DataFrame, *cols: Column | str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("rows"))
