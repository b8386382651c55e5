"""New batches against all history, without working through the history again.

State lies in Parquet under one folder and is opened again from there, by this process or another:

* ``settings``: threshold, covering and rarity levels, written once; keys of all runs must be made alike.
* ``texts``: every accepted text with its batch, its fields, the shingle set it belongs to, and, once a set and task, the
  blocking keys, sketch and packed shingles of that set; ``reps``: the text that stands for each set, with the sketch;
  ``keys``: the blocking keys.
  These lie in ``buckets`` folders by hash, so that a batch reads only the folders that its own keys and candidates touch.
* ``links``: similar pairs of representatives, scored. ``cells``: counts from which the weights of the fields are learned.
  ``clusters``: moved representatives only.
* ``commits``: a run counts only if it has one; what a run left that ended before is deleted by the next.

``ingest`` makes keys of the new texts, probes the history's keys through a bounded Bloom filter, scores candidates by
weights that are learned from all candidates so far (log-ratios of agreement), verifies them exactly on stored
shingles, and moves the representatives of the clusters that the new links touch. No text of the history is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caretlake.llm import shingles as S
from caretlake.llm.bloom import build
from caretlake.llm.covering import SKETCH_TYPE, Covering, bucket_pairs, covering_keys, passes_for
from caretlake.llm.rarity import Rarity, rarity_of
from caretlake.operators.components import hash_to_min
from caretlake.operators.hashes import clean_hash, file_hashes
from caretlake.session import delete, discard, fresh_dir, materialise, own_shuffles

LINK_FIELDS = ("tables", "length", "name", "package")
_TEXT = f"id bigint, batch int, length bigint, name string, package string, cls bigint, n int, tables array<bigint>, sketch {SKETCH_TYPE}, shingles binary"
_SCHEMAS = {
    "texts": _TEXT + ", bucket int",
    "reps": f"cls bigint, rep bigint, length bigint, name string, package string, sketch {SKETCH_TYPE}, bucket int",
    "keys": "key bigint, cls bigint, n int, bucket int",
    "links": "a bigint, b bigint, similarity double, score double",
    "cells": "field string, agrees boolean, links bigint, all bigint",
    "clusters": "node bigint, to bigint",
}


def similar(pairs: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (a, b, sa, sb with packed shingles) as (a, b, similarity) of those that are similar enough, in whole numbers."""
    need = int(round(threshold * 1_000_000))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            left = {k: S.unpacked(v) for k, v in zip(f["a"], f["sa"])}  # a text is unpacked once a batch
            right = {k: left[k] if k in left else S.unpacked(v) for k, v in zip(f["b"], f["sb"])}
            both = np.array([S.shared(left[a], right[b]) for a, b in zip(f["a"], f["b"])], np.int64)
            union = np.array([len(left[a]) + len(right[b]) for a, b in zip(f["a"], f["b"])], np.int64) - both
            ok = (both > 0) & (both * 1_000_000 >= union * need)
            yield pd.DataFrame({"a": f["a"][ok], "b": f["b"][ok], "similarity": both[ok] / union[ok]})

    return pairs.select("a", "b", "sa", "sb").mapInPandas(run, "a bigint, b bigint, similarity double")


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


@dataclass
class IncrementalDedup:
    """The state under ``root``, opened if it exists; ``buckets`` and the settings of an existing state are what it was made with."""

    spark: SparkSession
    threshold: float = 0.6
    covering: Covering = field(default_factory=Covering)
    root: str | None = None
    buckets: int = 0  # 0: by the number of texts of the first call, one for about 50,000
    runs: int = 0
    rarity: Rarity | None = None

    def __post_init__(self):
        self.root = self.root or fresh_dir(self.spark, "dedup-state")
        if _exists(self.spark, f"{self.root}/settings/_SUCCESS"):
            r = self.spark.read.parquet(f"{self.root}/settings").first()
            self.threshold, self.buckets, self.covering = r["threshold"], r["buckets"], Covering(r["parts"], r["width"], r["seed"])
            self.rarity = Rarity(np.frombuffer(r["levels"], np.uint8), r["common"])
            while _exists(self.spark, f"{self.root}/commits/run={self.runs}/_SUCCESS"):
                self.runs += 1

    def _start(self, new: DataFrame) -> None:
        if self.rarity is None:
            self.rarity = rarity_of(new, "text")
            if self.buckets <= 0:
                texts, self.buckets = new.count(), 8
                while self.buckets < 4096 and self.buckets * 50_000 < texts:
                    self.buckets *= 2
            c = self.covering
            row = [(float(self.threshold), self.buckets, c.parts, c.width, c.seed, self.rarity.common, bytearray(self.rarity.levels.tobytes()))]
            self.spark.createDataFrame(row, "threshold double, buckets int, parts int, width int, seed int, common int, levels binary").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/settings")
        for name in _SCHEMAS:
            if _exists(self.spark, f"{self.root}/{name}/run={self.runs}"):
                delete(self.spark, f"{self.root}/{name}/run={self.runs}")

    def _read(self, name: str, runs: int | None = None) -> DataFrame:
        n = self.runs if runs is None else runs
        return self._runs_of(name, list(range(n)))

    def _runs_of(self, name: str, runs: list[int]) -> DataFrame:
        return self.spark.read.schema(_SCHEMAS[name] + ", run int").option("basePath", f"{self.root}/{name}").parquet(*[f"{self.root}/{name}/run={k}" for k in runs]).drop("run")

    def _write(self, df: DataFrame, name: str, by: str | None = None) -> None:
        """Append a run of a table, in buckets of ``by``, sorted within."""
        path = f"{self.root}/{name}/run={self.runs}"
        with own_shuffles(self.spark):
            if by is None:
                df.write.parquet(path)
                return
            # One set may hold a third of all texts, and one key of all sets: partitions far above the wanted size are split, small ones joined.
            df.withColumn("bucket", self._bucket(by)).hint("rebalance", "bucket").sortWithinPartitions("bucket", by).write.partitionBy("bucket").parquet(path)

    def _bucket(self, c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(self.buckets)).cast("int")

    def _touched(self, name: str, wanted: DataFrame, c: str, runs: int) -> DataFrame:
        """The rows of a table in the folders that hold column ``c`` of ``wanted`` (at most ``buckets`` numbers are collected)."""
        at = [r[0] for r in wanted.select(self._bucket(c)).distinct().collect()]
        df = self._read(name, runs)
        return df.where(F.col("bucket").isin(at)) if len(at) < self.buckets else df

    def ingest(self, new: DataFrame) -> DataFrame:
        """Add ``new`` (id bigint, batch int, text); return scored links (a, b, similarity, score) between representatives.

        ``length``, ``name`` and ``package`` are the fields that are scored beside the shared tables; missing ones count as null.
        Each link has at least one representative of the new texts. Rows of null id are dropped, a null batch counts
        as the latest. Rows may belong to several batches: who came first is decided by batch, not by call.
        """
        self._start(new)
        run = self.runs
        has = lambda c, t: F.col(c).cast(t).alias(c) if c in new.columns else F.lit(None).cast(t).alias(c)
        named = new.where("id IS NOT NULL").select("id", F.coalesce("batch", F.lit(2**31 - 1)).alias("batch"), has("length", "bigint"), has("name", "string"), has("package", "string"), "text")
        made = covering_keys(named, "text", self.covering, self.rarity, self.threshold, ["id", "batch", "length", "name", "package"], with_sets=True)
        self._write(made.where("n > 0"), "texts", "cls")
        made = self._runs_of("texts", [run])
        sets = made.groupBy("cls").agg(F.min("id").alias("rep"), F.min_by(F.struct("length", "name", "package"), "id").alias("fields"), F.first("sketch", ignorenulls=True).alias("sketch")).select("cls", "rep", "fields.*", "sketch")
        once = made.where("tables IS NOT NULL").select("cls", "n", "tables")
        if run:  # sets that history holds have their links already
            known = materialise(self._touched("reps", made, "cls", run).select("cls").join(made.select("cls").distinct(), "cls", "left_semi"), "known")
            sets, once = sets.join(known, "cls", "left_anti"), once.join(known, "cls", "left_anti")
        self._write(sets, "reps", "cls")
        self._write(once.groupBy("cls").agg(F.first("n").alias("n"), F.first("tables").alias("tables")).select(F.explode("tables").alias("key"), "cls", "n"), "keys", "key")
        keys = self._runs_of("keys", [run]).select("key", "cls", "n")
        count = keys.count()
        pairs = bucket_pairs(keys, "key", "cls", size="n", threshold=self.threshold, sketches=self._runs_of("reps", [run]).select("cls", "sketch"), passes=passes_for(count))
        if run:
            held = self.spark.sparkContext.broadcast(build(keys, "key", count))

            def probe(frames):
                for f in frames:
                    yield f[held.value.might_hold(f["key"].to_numpy("int64").view("uint64"))]

            history = self._touched("keys", keys, "key", run).select("key", "cls", "n")
            near = materialise(history.mapInPandas(probe, history.schema), "near")
            both = near.withColumn("is_new", F.lit(False)).unionByName(keys.withColumn("is_new", F.lit(True)))
            sketches = self._touched("reps", both, "cls", run + 1).select("cls", "sketch")
            pairs = pairs.unionByName(bucket_pairs(both, "key", "cls", left=F.col("is_new"), size="n", threshold=self.threshold, sketches=sketches, passes=passes_for(count + near.count())))
        pairs = materialise(pairs, "pairs")
        if run:
            discard(near)
        ids = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
        reps = self._touched("reps", ids, "cls", run + 1).join(ids, "cls", "left_semi").select("cls", F.struct("rep", "length", "name", "package").alias("r"))
        cand = materialise(self._compared(pairs.join(reps.toDF("a", "ra"), "a").join(reps.toDF("b", "rb"), "b")), "candidates")
        held_sets = self._touched("texts", ids, "cls", run + 1).where("shingles IS NOT NULL").select("cls", "shingles").join(ids, "cls", "left_semi").groupBy("cls").agg(F.first("shingles").alias("s"))
        held_sets = materialise(held_sets, "candidate-sets")
        checked = similar(cand.select("a", "b").join(held_sets.toDF("a", "sa"), "a").join(held_sets.toDF("b", "sb"), "b"), self.threshold)
        found = materialise(cand.join(checked, ["a", "b"], "left"), "verified")
        for done in (pairs, cand, held_sets):
            discard(done)
        flags = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("agrees")) for f in LINK_FIELDS])).alias("x")
        self._write(found.select("similarity", flags).groupBy("x.field", "x.agrees").agg(F.count("similarity").alias("links"), F.count("*").alias("all")), "cells")
        weights = {(r["field"], r["agrees"]): r["weight"] for r in self.weights(run + 1).collect()}  # two rows a field
        score: Column = F.lit(0.0)
        for f in LINK_FIELDS:
            score = score + F.when(F.col(f), F.lit(weights.get((f, True), 0.0))).otherwise(F.lit(weights.get((f, False), 0.0)))
        links = found.where("similarity IS NOT NULL").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"), "similarity", F.round(score, 6).alias("score"))
        self._write(links, "links")
        links = self._runs_of("links", [run])
        self._move(links)
        self.spark.createDataFrame([(run,)], "run int").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/commits/run={run}")
        for done in (found, *([known] if run else [])):
            discard(done)
        self.runs += 1
        return links

    def _compared(self, pairs: DataFrame) -> DataFrame:
        """(a, b, ra, rb, one flag a field) of pairs with the fields of both sides; a null agrees with nothing."""
        same = lambda x: F.coalesce(F.col(f"ra.{x}") == F.col(f"rb.{x}"), F.lit(False)).alias(x)
        length = F.coalesce(F.least("ra.length", "rb.length") * 10 >= F.greatest("ra.length", "rb.length") * 8, F.lit(False)).alias("length")
        tables = (F.col("tables") * 2 >= self.covering.tables).alias("tables")
        return pairs.select("a", "b", F.col("ra.rep").alias("ra"), F.col("rb.rep").alias("rb"), tables, length, same("name"), same("package"))

    def weights(self, runs: int | None = None) -> DataFrame:
        """(field, agrees, weight): log2 of how much likelier an agreement is among links than among other candidates.

        All candidates of all runs count, each field cell with one added on either side.
        """
        cells = self._read("cells", runs).groupBy("field", "agrees").agg(F.sum("links").alias("links"), F.sum("all").alias("all"))
        total = cells.groupBy("field").agg(F.sum("links").alias("tl"), F.sum("all").alias("ta"))
        m = (F.col("links") + 1) / (F.col("tl") + 2)
        u = (F.col("all") - F.col("links") + 1) / (F.col("ta") - F.col("tl") + 2)
        return cells.join(total, "field").select("field", "agrees", F.log2(m / u).alias("weight"))

    def _roots(self, nodes: DataFrame, runs: int) -> DataFrame:
        """(id, rep): the representative to which union-find has moved each of ``nodes`` (id)."""
        out = nodes.select("id", F.col("id").alias("rep"))
        for k in range(runs):
            out = out.join(self._runs_of("clusters", [k]), F.col("rep") == F.col("node"), "left")
            out = out.select("id", F.coalesce("to", "rep").alias("rep"))
        return out

    def _move(self, links: DataFrame) -> None:
        """Write (node, to) for the representatives that ``links`` move; no other cluster is touched."""
        ends = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        at = materialise(self._roots(ends, self.runs), "roots")
        edges = links.select("a", "b").join(at.toDF("a", "x"), "a").join(at.toDF("b", "y"), "b").select("x", "y").where("x <> y")
        moved = hash_to_min(edges, "x", "y").where("node <> component").select("node", F.col("component").alias("to"))
        self._write(moved, "clusters")
        discard(at)

    def members(self) -> DataFrame:
        """(id, batch, rep): every accepted text and the representative of its set, which stays the one it first had."""
        return self._read("texts").select("id", "batch", "cls").join(self._read("reps").select("cls", "rep"), "cls").select("id", "batch", "rep")

    def not_new(self) -> DataFrame:
        """(id, duplicate_of, score) of the texts that are equal or similar to one of a smaller batch.

        An equal one is named first, without score; else the one of the link with the best learned score, of equal
        scores the smallest id. Who is a duplicate is decided by the exact similarity. Copies of one batch are looked up once.
        """
        m = self.members()
        first = m.groupBy("rep").agg(F.min("batch").alias("f"), F.min_by("id", F.struct("batch", "id")).alias("original"))
        links = self._read("links")
        both = links.select("a", "b", "score").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
        earlier = both.join(first.select(F.col("rep").alias("b"), "f", "original"), "b").select(F.col("a").alias("rep"), "f", "original", "score")
        sought = m.select("rep", "batch").distinct()
        best = sought.join(earlier, "rep").where("f < batch").groupBy("rep", "batch").agg(F.max(F.struct("score", (-F.col("original")).alias("o"))).alias("best"))
        known = sought.join(first, "rep").join(best, ["rep", "batch"], "left").where("f < batch OR best IS NOT NULL")
        known = known.select("rep", "batch", F.when(F.col("f") < F.col("batch"), F.col("original")).otherwise(-F.col("best.o")).alias("duplicate_of"), F.when(F.col("f") >= F.col("batch"), F.col("best.score")).alias("score"))
        return m.join(known, ["rep", "batch"]).select("id", "duplicate_of", "score")

    def documents(self, texts: DataFrame) -> DataFrame:
        """(id, rep, cluster_id, links, best_score): one row per text of ``texts`` (id), with the set and the cluster it belongs to and the links of its set.

        A set without links is a cluster of its own, and so is a text without shingles.
        """
        links = self._read("links")
        ends = links.select(F.explode(F.array("a", "b")).alias("rep"), "score").groupBy("rep").agg(F.count("*").alias("links"), F.max("score").alias("best_score"))
        linked = self._roots(ends.select(F.col("rep").alias("id")), self.runs).toDF("rep", "cluster_id").join(ends, "rep")
        ids = texts.select(F.col("id").cast("bigint").alias("id")).where("id IS NOT NULL").distinct()
        own = ids.join(self.members().groupBy("id").agg(F.min("rep").alias("rep")), "id", "left").select("id", F.coalesce("rep", "id").alias("rep"))
        return own.join(linked, "rep", "left").select("id", "rep", F.coalesce("cluster_id", "rep").alias("cluster_id"), F.coalesce("links", F.lit(0)).alias("links"), "best_score")


def as_texts(files: DataFrame) -> DataFrame:
    """Corpus files as ``ingest`` takes them."""
    name = F.element_at(F.split("relative_path", "/"), -1)
    package = F.col("package_name") if "package_name" in files.columns else F.lit(None).cast("string")
    return files.select(F.col("file_id").cast("bigint").alias("id"), "batch", F.length("content").alias("length"), name.alias("name"), package.alias("package"), F.col("content").alias("text"))


def nothing_new(files: DataFrame, owners: DataFrame, discovery: DataFrame, threshold: float = 0.6) -> DataFrame:
    """(file_id) of the corpus files that bring nothing new.

    These are the files whose hash a smaller batch gave to another repository, that are similar to a file of a smaller
    batch, or whose accepted discovery row names an original. History is loaded first, then the latest batch is held
    against it.
    """
    last = files.agg(F.max("batch")).first()[0]
    state = IncrementalDedup(files.sparkSession, threshold)
    texts = as_texts(files)
    state.ingest(texts.where(F.col("batch") < F.lit(last)))
    state.ingest(texts.where((F.col("batch") >= F.lit(last)) | F.col("batch").isNull()))
    similar = state.not_new().select(F.col("id").alias("file_id"))

    claims = owners.select(clean_hash(F.col("sha256")).alias("hash"), "repo_id", "batch").where("hash IS NOT NULL AND repo_id IS NOT NULL")
    first = claims.groupBy("hash", "repo_id").agg(F.min("batch").alias("owned"))
    mine = file_hashes(files, discovery).join(files.select("file_id", "repository_id", "batch"), "file_id")
    owned = mine.join(first, "hash").where("repo_id <> repository_id AND owned < batch").select("file_id")

    copies = discovery.where("accepted AND duplicate_of IS NOT NULL").select("repository_id", "relative_path").distinct()
    copied = files.select("file_id", "repository_id", "relative_path").join(copies, ["repository_id", "relative_path"], "left_semi").select("file_id")
    return similar.union(owned).union(copied).distinct()
