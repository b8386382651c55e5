"""Near-duplicate texts across a collection too large for pairwise comparison.

``near_duplicates`` proposes pairs by covering locality-sensitive hashing (covering.py) and verifies each by the
exact similarity of the two whole shingle sets. Equal sets are one class, represented by its smallest id, so that
copies are compared once. A text without shingles (null, empty, under five tokens) is similar to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretlake.llm import shingles as S
from caretlake.llm.bloom import build
from caretlake.llm.covering import Covering, bucket_pairs, covering_keys, passes_for
from caretlake.llm.rarity import rarity_of
from caretlake.session import discard, materialise


def sets_of(df: DataFrame, id_col: str, text: str, wanted: DataFrame, count: int) -> DataFrame:
    """(id, shingles) of the rows whose id is in ``wanted`` (one bigint column); others are mostly dropped unread.

    A few rows that are not wanted may pass; the joins that follow are exact.
    """
    held = df.sparkSession.sparkContext.broadcast(build(wanted, wanted.columns[0], count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom = held.value
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            keep = bloom.might_hold(ids.view(np.uint64))
            if not keep.any():
                continue
            b = b.filter(pa.array(keep))
            for lo, hi, values, bounds in S.shingle_sets(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), S.list_column(values, bounds)], names=["id", "shingles"])

    return df.select(F.col(id_col).cast("bigint").alias("i"), F.col(text)).where("i IS NOT NULL").mapInArrow(run, "id bigint, shingles array<bigint>")


def sizes_fit(a: str, b: str, threshold: float) -> Column:
    """Whether sets of two sizes can be similar enough at all."""
    return F.least(a, b).cast("bigint") * 1_000_000 >= F.greatest(a, b).cast("bigint") * int(round(threshold * 1_000_000))


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets have a similarity of at least ``threshold``, with ``similarity``."""
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    joined = pairs.join(a, "a").join(b, "b").withColumn("m", both)
    union = F.size("sa") + F.size("sb") - F.col("m")
    # In whole numbers: a threshold of 0.6 must hold for 3 of 5 exactly.
    ok = F.col("m").cast("bigint") * 1_000_000 >= union.cast("bigint") * int(round(threshold * 1_000_000))
    return joined.where(ok & (F.col("m") > 0)).select("a", "b", (F.col("m") / union).alias("similarity"))


@dataclass
class NearDuplicates:
    """members: (id, rep, n), one row per text with shingles; links: (a, b, similarity) between representatives."""

    members: DataFrame
    links: DataFrame

    def documents(self) -> DataFrame:
        """One row per text: its representative, its copies and its number of links to other texts' classes."""
        ends = self.links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
        size = self.members.groupBy("rep").agg(F.count("*").alias("copies"))
        return (
            self.members.join(size, "rep").join(ends, "rep", "left")
            .select("id", F.col("rep").alias("class_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
        )

    def pairs(self) -> DataFrame:
        """All pairs of texts, copies expanded, as (id_a, id_b) with the smaller id first."""
        m = self.members.select("id", "rep")
        within = m.alias("x").join(m.alias("y"), F.expr("x.rep = y.rep AND x.id < y.id")).select(F.col("x.id").alias("p"), F.col("y.id").alias("q"))
        a = m.select(F.col("rep").alias("a"), F.col("id").alias("p"))
        b = m.select(F.col("rep").alias("b"), F.col("id").alias("q"))
        across = self.links.join(a, "a").join(b, "b").select("p", "q")
        return within.union(across).select(F.least("p", "q").alias("id_a"), F.greatest("p", "q").alias("id_b"))


def near_duplicates(df: DataFrame, id_col: str, text: str, threshold: float = 0.8, covering: Covering = Covering()) -> NearDuplicates:
    """Group the texts of ``df`` whose similarity is at least ``threshold``.

    ``id_col`` is a bigint that names a row; rows of equal id count once, rows without id not at all. Other columns
    are not read. An empty table gives empty results.
    """
    docs = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    keys = materialise(covering_keys(docs, "text", covering, rarity_of(docs, "text"), threshold, ["id"]).where("n > 0"), "covering-keys")
    reps = keys.groupBy("cls").agg(F.min("id").alias("rep"))
    members = materialise(keys.select("id", "cls", "n").join(reps, "cls").groupBy("id").agg(F.first("rep").alias("rep"), F.first("n").alias("n"), F.first("cls").alias("cls")), "members")
    rows = keys.where("tables IS NOT NULL").select("cls", "n", F.explode("tables").alias("key"))
    sketches = keys.where("sketch IS NOT NULL").groupBy("cls").agg(F.first("sketch").alias("sketch"))
    pairs = bucket_pairs(rows, "key", "cls", size="n", threshold=threshold, sketches=sketches, passes=passes_for(keys.count() * covering.tables))
    rep = members.where("id = rep").select(F.col("cls").alias("c"), "rep")
    ra, rb = rep.toDF("a", "ra"), rep.toDF("b", "rb")
    cand = materialise(pairs.join(ra, "a").join(rb, "b").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")), "candidates")
    discard(keys)
    ids = cand.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = sets_of(docs, "id", "text", ids, ids.count())
    links = materialise(verified(cand, sets, threshold), "links")
    discard(cand)
    return NearDuplicates(members.select("id", "rep", "n"), links)
