"""Covering locality-sensitive hashing over minimum sketches.

Each text is a sketch of ``parts * width`` components; component k is the minimum of its shingles under
hash order k, so two texts of similarity s agree in each component with chance s. The components of a part
are the positions of structured bit masks: mask i keeps all positions of its part but the i-th. Two sketches
that differ in at most one position of some part therefore share the key of some mask, whatever the
positions; by the pigeonhole principle this holds for every pair of sketches within the Hamming radius
``2 * parts - 1``. With 12 parts of 3, 36 tables, a pair of similarity 0.6 is missed with a chance of 4e-6
(``miss_chance``). Candidates are verified exactly afterwards (see neardup.py).

Texts that merely share common phrases must not meet, or candidates grow with the square of the collection. So the
minima are taken over a text's rare shingles (rarity.py), of which unrelated texts share none. A text whose rare part is
under ``FULL_BELOW`` is sketched by all its shingles too, or by them alone where it is under ``rare_from``. That bound
follows from the similarity that is looked for: no partner of a text that sends rare keys only can lie below it, so any
two similar texts send keys of one kind both. What remains is chance (``worst_miss``).

Texts that send full keys share common phrases, and more of them the larger the collection is. So each text also has a
sketch of 128 minima of all its shingles, two bits each, that tells pairs far below the threshold apart where they meet:
they are never written. A pair that reaches the threshold is taken for such with a chance of ``SKETCH_MISS`` at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretlake.llm import shingles as S
from caretlake.llm.rarity import Rarity
from caretlake.session import discard, materialise, spread

FULL_BELOW = 0.85
SKETCH = 128  # minima
SKETCH_MISS = 1e-6
KEYS_A_PASS = 1 << 26
SKETCH_TYPE = "struct<l0:bigint,l1:bigint,h0:bigint,h1:bigint>"  # the low and the high bits of the minima


@dataclass(frozen=True)
class Covering:
    parts: int = 12
    width: int = 3
    seed: int = 5

    @property
    def tables(self) -> int:
        return self.parts * self.width

    @property
    def radius(self) -> int:
        return 2 * self.parts - 1

    def masks(self) -> list[int]:
        """The bit masks of one part: all positions but one."""
        return [((1 << self.width) - 1) ^ (1 << i) for i in range(self.width)]

    def miss_chance(self, similarity: float) -> float:
        s, w = similarity, self.width
        return (1 - s**w - w * s ** (w - 1) * (1 - s)) ** self.parts

    def worst_miss(self, threshold: float) -> float:
        """The chance to miss a pair of just this similarity that meets in rare keys only, all its common shingles being shared."""
        c = 1 - FULL_BELOW
        return self.miss_chance(max(0.0, (threshold - c) / (1 - c)))

    def keys(self, values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Rows x tables matrix of 64-bit keys, for the non-empty sets."""
        minima = S.component_minima(values, bounds, self.parts * self.width, self.seed)
        out = np.empty((len(minima), self.tables), np.uint64)
        with np.errstate(over="ignore"):
            factor = S._splitmix(self.width, self.seed + 2) | np.uint64(1)
            t = 0
            for p in range(self.parts):
                part = minima[:, p * self.width : (p + 1) * self.width]
                for mask in self.masks():
                    h = np.full(len(part), (t + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
                    for i in range(self.width):
                        if mask >> i & 1:
                            h = S.mix(h + part[:, i] * factor[i])
                    out[:, t] = h
                    t += 1
        return out


def rare_from(threshold: float) -> float:
    """The lowest rare part of a text that has a similarity of ``threshold`` to one whose rare part is ``FULL_BELOW`` or more.

    If all common shingles of the first lie in both, the second holds either all of the first and common ones beside, or
    what is left of the first when only rare ones are taken away; what lies between is between.
    """
    return min(threshold * FULL_BELOW, (FULL_BELOW - (1 - threshold)) / threshold) - 1e-9


def sketch_keys(values: np.ndarray, bounds: np.ndarray, covering: Covering, rarity: Rarity, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row of each key, key): keys of the rare sketch, of the full one, or of both."""
    sizes = np.diff(bounds)
    row = np.repeat(np.arange(len(sizes)), sizes)
    rare = rarity.rare(values)
    share = np.bincount(row[rare], minlength=len(sizes)) / np.maximum(sizes, 1)
    rows, keys = [], []
    for chosen, salt in ((rare & (share >= rare_from(threshold))[row], 0), ((share < FULL_BELOW)[row], 0x5BD1E995)):
        sub = np.append(0, np.cumsum(np.bincount(row[chosen], minlength=len(sizes))))
        k = covering.keys(values[chosen], sub) ^ np.uint64(salt)
        rows.append(np.repeat(np.flatnonzero(np.diff(sub)), covering.tables))
        keys.append(k.ravel())
    return np.concatenate(rows), np.concatenate(keys)


def sketch_column(values: np.ndarray, bounds: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Two bits of each of ``SKETCH`` minima of each set; rows that are not ``valid`` are null."""
    bits = S.mix(S.component_minima(values, bounds, SKETCH, 17))
    out = np.zeros((4, len(bounds) - 1), np.int64)
    for k in range(2):
        plane = np.packbits((bits >> np.uint64(k) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little")
        out[2 * k : 2 * k + 2, np.diff(bounds) > 0] = plane.view("<i8").T
    return pa.StructArray.from_arrays([pa.array(w) for w in out], names=["l0", "l1", "h0", "h1"], mask=pa.array(~valid))


def most_different(threshold: float) -> int:
    """In how many minima of their sketches two texts of this similarity may differ; more with a chance of at most ``SKETCH_MISS``."""
    p, beyond, d = (1 - threshold) * 3 / 4, 0.0, SKETCH
    while d > 0 and (beyond := beyond + math.comb(SKETCH, d) * p**d * (1 - p) ** (SKETCH - d)) <= SKETCH_MISS:
        d -= 1
    return d


def covering_keys(df: DataFrame, text: str, covering: Covering, rarity: Rarity, threshold: float, carry: list[str] = (), with_sets: bool = False) -> DataFrame:
    """One row per text: ``cls`` (fingerprint of its shingle set, 0 if empty), ``n`` (its size), ``tables`` (keys), ``sketch``.

    Equal sets within one task send their keys and sketch once (others have null): a hot group of copies costs a row per task and
    table. ``with_sets`` adds the packed ``shingles`` where there are keys.
    """
    fields = [df.schema[c] for c in carry]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["cls bigint", "n int", "tables array<bigint>", f"sketch {SKETCH_TYPE}"] + ["shingles binary"] * with_sets)
    carry = list(carry)
    held = df.sparkSession.sparkContext.broadcast(rarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            for lo, hi, values, bounds in S.shingle_sets(b.column(len(carry))):
                cls = S.set_hashes(values, bounds)
                new = np.zeros(hi - lo, bool)
                for i, c in enumerate(cls.tolist()):
                    if c and c not in seen:
                        new[i] = True
                        if len(seen) < 500_000:
                            seen.add(c)
                row, keys = sketch_keys(values, bounds, covering, held.value, threshold)
                ok = new[row]
                row, keys = row[ok], keys[ok]
                order = np.argsort(row, kind="stable")
                cols = [S.list_column(keys[order].view(np.int64), np.append(0, np.cumsum(np.bincount(row, minlength=hi - lo))), new), sketch_column(values, bounds, new)]
                if with_sets:
                    cols.append(S.packed_column(values, bounds, new))
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(lo, hi - lo) for k in range(len(carry))] + [pa.array(cls.astype(np.int64)), pa.array(np.diff(bounds).astype(np.int32)), *cols],
                    names=[*carry, "cls", "n", "tables", "sketch"] + ["shingles"] * with_sets,
                )

    return spread(df.select(*carry, F.col(text))).mapInArrow(run, schema)


def passes_for(keys: int) -> int:
    return max(1, math.ceil(keys / KEYS_A_PASS))


def bucket_pairs(rows: DataFrame, key: str, item: str, left: Column | None = None, block: int = 256, size: str | None = None, threshold: float = 0.0, sketches: DataFrame | None = None, passes: int = 1) -> DataFrame:
    """(a, b, tables): pairs of items that share a key, and how many they share; a < b, or, with ``left``, left items against the others.

    Sizes of buckets are counted with partial aggregation, so that no hot key is gathered. A bucket of more than
    ``block`` items is cut into blocks by the items' hash, and each pair of blocks is a group of its own, so that no
    task gathers more than about two blocks at once, however hot the bucket. With ``size``, pairs whose sizes cannot be
    similar enough for ``threshold`` are never formed, and with ``sketches`` (item, sketch; one row an item) neither are
    those whose sketches differ in more than ``most_different`` minima. Sketches meet only the keys that several items
    share; an item without one is left to the sizes. With several ``passes`` each takes its part of the keys and deletes
    its shuffle files, so that disk is needed for one part at a time.
    """
    if passes > 1:
        parts = [materialise(bucket_pairs(rows.where(F.pmod(F.col(key), F.lit(passes)) == k), key, item, left, block, size, threshold, sketches), "pass") for k in range(passes)]
        whole = materialise(reduce(DataFrame.unionByName, parts).groupBy("a", "b").agg(F.sum("tables").alias("tables")), "passes")
        for part in parts:
            discard(part)
        return whole
    sided = left is not None
    n = F.col(size).cast("bigint") if size else F.lit(1).cast("bigint")
    rows = rows.select(F.col(key).alias("k"), F.col(item).alias("i"), n.alias("n"), (left if sided else F.lit(True)).alias("l"))
    sizes = rows.groupBy("k").agg(F.count("*").alias("size"), *([F.sum(F.col("l").cast("long")).alias("nl")] if sided else []))
    many = (F.col("nl") > 0) & (F.col("nl") < F.col("size")) if sided else F.col("size") > 1
    sizes = sizes.where(many).select("k", F.ceil(F.col("size") / block).alias("blocks"))
    live = rows.join(sizes, "k").withColumn("b", F.pmod(F.xxhash64("i"), F.col("blocks")))
    fields = ["i", "n", "b", "l"]
    if sketches is not None:
        live, fields = live.join(sketches.toDF("i", "s"), "i", "left"), [*fields, "s"]
    if sided:
        others = F.expr("transform(sequence(0, blocks - 1), x -> IF(l, struct(b AS p, x AS q), struct(x AS p, b AS q)))")
    else:
        others = F.expr("transform(sequence(0, blocks - 1), x -> struct(least(b, x) AS p, greatest(b, x) AS q))")
    grouped = (
        live.select("k", *fields, F.explode(others).alias("o"))
        .groupBy("k", "o")
        .agg(F.collect_set(F.struct(*fields)).alias("s"))
    )
    t = int(round(threshold * 1_000_000))
    fit = f"least(u.n, v.n) * 1000000 >= greatest(u.n, v.n) * {t}L"
    if sketches is not None:
        differ = " + ".join(f"bit_count((u.s.l{k} ^ v.s.l{k}) | (u.s.h{k} ^ v.s.h{k}))" for k in range(2))
        fit += f" AND coalesce({differ} <= {most_different(threshold)}, true)"
    if sided:
        pairs = grouped.select(F.expr("filter(s, x -> x.l)").alias("x"), F.expr("filter(s, x -> NOT x.l)").alias("y")).select(
            F.explode(F.expr(f"flatten(transform(x, u -> transform(filter(y, v -> {fit} AND u.i <> v.i), v -> struct(u.i AS a, v.i AS b))))")).alias("p")
        )
    else:
        pairs = grouped.select("o", F.array_sort("s").alias("s")).select(
            F.explode(F.expr(f"flatten(transform(s, (u, m) -> transform(filter(slice(s, m + 2, size(s)), v -> {fit} AND (o.p = o.q OR u.b <> v.b)), v -> struct(u.i AS a, v.i AS b))))")).alias("p")
        )
    return pairs.groupBy("p.a", "p.b").agg(F.count("*").alias("tables"))
