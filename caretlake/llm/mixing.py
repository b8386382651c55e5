"""Mixing sources to target weights by size in tokens.

Weights are tempered: between the natural token shares p and the targets t lies the family ``p**(1 - a) * t**a``, scaled to
the share that is free. The exponent is raised from 0 to 1; by bisection the exponent is found at which the next source
meets its repetition limit; from there on that source is held at its limit and the others share what is left. Without
targets ``p**a`` is bisected to a target entropy. The weights are realised as budgeted block permutations: a source is
used in whole passes and the head of one more, and every pass goes through its blocks, and through the documents of a
block, in an order of its own.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_source(c):
    t = F.lower(F.trim(c))
    return F.when(t != "", t)


def entropy(weights: dict[str, float]) -> float:
    return -sum(w * math.log(w) for w in weights.values() if w > 0)


def scaled(weights: dict[str, float]) -> dict[str, float]:
    total = sum(weights.values())
    return {k: v / total for k, v in weights.items()} if total > 0 else weights


def temper_to_entropy(tokens: dict[str, int], target: float) -> tuple[float, dict[str, float]]:
    """The exponent a and the weights ``tokens**a`` of the wanted entropy (clipped to what exponents from 0 to 8 reach)."""
    p = scaled({k: float(v) for k, v in tokens.items() if v > 0})
    at = lambda a: scaled({k: v**a for k, v in p.items()})
    lo, hi = 0.0, 8.0  # the entropy falls as the exponent grows
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if entropy(at(mid)) > target else (lo, mid)
    return lo, at(lo)


@dataclass
class Mix:
    """``weights`` of the budget, and for each source held at its limit the exponent at which it met it."""

    weights: dict[str, float]
    held: dict[str, float]


def temper_to_limits(tokens: dict[str, int], targets: dict[str, float], limits: dict[str, float], budget: float) -> Mix:
    """Weights towards the targets of which ``budget * weight <= limit * tokens`` holds for every source.

    A source is held only if its target breaks its limit even when all that are held already have given up their share.
    If all sources end at their limits, the weights sum to less than 1 and the budget is not filled. A source without
    target, or without tokens, has no weight.
    """
    p = scaled({k: float(tokens[k]) for k in targets if tokens.get(k, 0) > 0 and targets[k] > 0})
    t, most = scaled({k: targets[k] for k in p}), {k: limits.get(k, math.inf) * tokens[k] / budget if budget > 0 else math.inf for k in p}
    held: dict[str, float] = {}
    low, free = 0.0, dict(p)
    while free:
        rest = 1.0 - sum(most[k] for k in held)
        at = lambda a: {k: w * rest for k, w in scaled({k: p[k] ** (1 - a) * t[k] ** a for k in free}).items()}
        breaks = lambda a, ks: [k for k in ks if at(a)[k] > most[k] * (1 + 1e-9)]
        ends = breaks(1.0, free)
        if not ends:
            return Mix(at(1.0) | {k: most[k] for k in held}, held)
        lo, hi = low, 1.0
        if breaks(lo, ends):
            hi = lo
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if breaks(mid, ends) else (mid, hi)
        for k in breaks(hi, ends):
            held[k] = hi
            del free[k]
        low = hi
    return Mix({k: most[k] for k in held}, held)


def capacity(tokens: dict[str, int], targets: dict[str, float], limits: dict[str, float]) -> float:
    """The largest budget that the sources with a target can fill."""
    return sum(limits.get(k, math.inf) * tokens[k] for k, t in targets.items() if t > 0 and tokens.get(k, 0) > 0)


def blocks_of(rows: int) -> int:
    """How many blocks the documents are put into: about 2,048 documents a block and source, at most 16,384 blocks."""
    n = 64
    while n < 1 << 14 and n * 2048 < rows:
        n *= 2
    return n


def _order(seed: int, *parts) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, (seed, *parts))).encode(), digest_size=8).digest(), "big")


def realise(sized: DataFrame, budgets: dict[str, float], limits: dict[str, float], seed: int = 20261009, id_col: str = "doc_id") -> DataFrame:
    """(id, source, tokens, block, uses) of every row of ``sized`` (id, source, tokens).

    The head of a source's last pass takes whole blocks in the order of that pass while they fit; of the one block in
    which it ends, documents in their order as far as each fits what is left, and one more, the smallest, if that comes
    nearer to the budget. A document of a source without budget has 0 uses; so has one without tokens. Sums are taken
    per source and block first; only the block in which a pass ends is gathered, one a source.
    """
    spark, sized = sized.sparkSession, sized.select(id_col, "source", F.coalesce(F.col("tokens").cast("bigint"), F.lit(0)).alias("tokens"))
    blocks = blocks_of(sized.count())
    s = sized.withColumn("block", F.pmod(F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col), 20), F.lit(blocks)).cast("int"))
    by: dict = {}
    for r in s.where("source IS NOT NULL").groupBy("source", "block").agg(F.sum("tokens").alias("tokens")).collect():  # sources * blocks rows
        by.setdefault(r["source"], {})[r["block"]] = r["tokens"] or 0
    rows, heads = [], []
    for source, cells in by.items():
        total = sum(cells.values())
        budget = min(budgets.get(source, 0.0), limits.get(source, math.inf) * total) if total else 0.0
        passes = int((budget + 1e-6) // total) if total else 0
        rest, cut, head = budget - passes * total, -1, []
        if passes + 1 <= limits.get(source, math.inf):
            for b in sorted(cells, key=lambda b: _order(seed, source, passes, b)):
                if cells[b] > rest + 1e-6:
                    cut = b
                    break
                head.append(b)
                rest -= cells[b]
        rows.append((source, passes, cut, float(max(rest, 0.0))))
        heads += [(source, b) for b in head]
    if not rows:
        return s.select(id_col, "source", "tokens", "block", F.lit(0).alias("uses"))
    marks = F.broadcast(spark.createDataFrame(pd.DataFrame(rows, columns=["source", "passes", "cut", "rest"]), "source string, passes int, cut int, rest double"))  # one row a source
    whole = F.broadcast(spark.createDataFrame(pd.DataFrame(heads, columns=["source", "block"]), "source string, block int").withColumn("in_head", F.lit(1)))  # at most sources * blocks rows
    j = s.join(marks, "source", "left").join(whole, ["source", "block"], "left")
    inside = j.where("cut IS NULL OR block <> cut").select(id_col, "source", "tokens", "block", F.coalesce("passes", F.lit(0)).alias("passes"), F.coalesce("in_head", F.lit(0)).alias("extra"))
    edge = j.where("block = cut").select(id_col, "source", "tokens", "block", "passes", "rest", F.xxhash64(F.lit(seed), F.col("passes"), F.col(id_col)).alias("place"))
    kind = sized.schema[id_col].dataType.simpleString()

    def fill(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["place", id_col], kind="stable")
        rest, size = float(frame["rest"].iloc[0]), frame["tokens"].to_numpy()
        take = np.zeros(len(frame), np.int32)
        for k, n in enumerate(size):
            if 0 < n <= rest:
                take[k], rest = 1, rest - n
        left = np.flatnonzero((take == 0) & (size > 0))
        if len(left) and size[left].min() - rest < rest:
            take[left[np.argmin(size[left])]] = 1
        return frame[[id_col, "source", "tokens", "block", "passes"]].assign(extra=take)

    edge = edge.groupBy("source", "block").applyInPandas(fill, f"`{id_col}` {kind}, source string, tokens bigint, block int, passes int, extra int")
    used = F.when(F.col("tokens") > 0, F.col("passes") + F.col("extra")).otherwise(0)
    return inside.unionByName(edge).select(id_col, "source", "tokens", "block", used.alias("uses"))


def passes(used: DataFrame, seed: int = 20261009, id_col: str = "doc_id") -> DataFrame:
    """(id, source, pass, block_place, place): one row a use. Sorted by pass, block_place, block and place the rows of a
    source are its stream; every pass has its own order of blocks and of documents within."""
    u = used.where("uses > 0").select(id_col, "source", "block", F.explode(F.sequence(F.lit(0), F.col("uses") - 1)).alias("pass"))
    return u.select(id_col, "source", "pass", F.xxhash64(F.lit(seed), "source", "pass", "block").alias("block_place"), "block", F.xxhash64(F.lit(seed), F.col("pass"), F.col(id_col)).alias("place"))


def source_tokens(sized: DataFrame) -> dict[str, int]:
    """Tokens of each named source (there are as many rows as sources)."""
    return {r["source"]: int(r["t"] or 0) for r in sized.where("source IS NOT NULL").groupBy("source").agg(F.sum("tokens").alias("t")).collect()}


def reached(used: DataFrame, wanted: dict[str, float], held: dict[str, float] | None = None) -> DataFrame:
    """(source, documents, tokens, used_tokens, wanted_share, share, error, repeats, held_at): the shares actually reached.

    ``held_at`` is the exponent at which a source met its repetition limit; null where no limit binds.
    """
    spark = used.sparkSession
    rows = [(k, float(v), (held or {}).get(k)) for k, v in wanted.items()]
    want = spark.createDataFrame(rows or [("", 0.0, None)], "source_ string, wanted_share double, held_at double")
    g = used.groupBy("source").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("uses")).alias("used_tokens"), F.max("uses").alias("repeats"))
    total = g.agg(F.sum("used_tokens").alias("all"))  # one row
    j = g.join(F.broadcast(want), F.col("source") == F.col("source_"), "left").drop("source_").crossJoin(F.broadcast(total))
    share = F.when(F.col("all") > 0, F.col("used_tokens") / F.col("all")).otherwise(0.0)
    wish = F.coalesce("wanted_share", F.lit(0.0))
    return j.select("source", "documents", "tokens", "used_tokens", wish.alias("wanted_share"), share.alias("share"), (share - wish).alias("error"), "repeats", "held_at")
