"""Filling containers of fixed capacity with documents, planned on the histogram of lengths.

The histogram has at most ``capacity`` entries, whatever the number of documents. Shallow combinations of lengths that
fill a window below the capacity are enumerated; non-negative least squares gives how often to use each; counts are
rounded down; what remains of the histogram is packed greedily, by count, not by document. Documents then look up
their place by their rank among the documents of their length, in parallel.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caretlake.session import materialise

MAX_COMBINATIONS = 12_000
SALTS = 64


def combinations(lengths: list[int], counts: dict[int, int], capacity: int, window: float = 0.01, limit: int = MAX_COMBINATIONS) -> list[tuple[int, ...]]:
    """Multisets of one to four lengths whose sum lies in [capacity - window * capacity, capacity].

    Among more than ``limit`` the fullest of the commonest lengths are kept. The limit is on kinds of combination, not
    on documents: lengths that no combination holds go to the greedy step.
    """
    low = capacity - max(int(capacity * window), 0)
    present = sorted(lengths)
    arr = np.array(present)
    out: set[tuple[int, ...]] = {(x,) for x in present if low <= x <= capacity}

    def best_at_most(x: int) -> int | None:
        k = np.searchsorted(arr, x, side="right") - 1
        return int(arr[k]) if k >= 0 else None

    for a in present:
        if (b := best_at_most(capacity - a)) and a >= b and a + b >= low:
            out.add((a, b))
    common = [x for x, _ in sorted(counts.items(), key=lambda z: (-z[1] * z[0], z[0]))]
    for depth_limit, pool in ((limit // 2, common), (limit, common[:60])):
        for i, a in enumerate(pool):
            for b in pool[: i + 1]:
                if len(out) >= depth_limit:
                    break
                rest = capacity - a - b
                if rest <= 0:
                    continue
                if (c := best_at_most(rest)) and a + b + c >= low:
                    out.add(tuple(sorted((a, b, c), reverse=True)))
                elif c and rest - c > 0 and (d := best_at_most(rest - c)) and a + b + c + d >= low:
                    out.add(tuple(sorted((a, b, c, d), reverse=True)))
    for a in common[:200]:  # many equal short ones
        k = capacity // a
        if k > 4 and capacity - k * a <= capacity - low:
            out.add((a,) * k)
    return sorted(out, reverse=True)


def solve_counts(combos: list[tuple[int, ...]], counts: dict[int, int], rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 with small |Ax - h|, in tokens: accelerated projected gradient of the non-negative least squares problem.

    Columns are scaled to length 1. The matrix has at most four entries a column and is never made whole.
    """
    order = np.array(sorted(counts), np.int64)
    cells = [(j, y, k) for j, c in enumerate(combos) for y, k in Counter(c).items()]
    col, y, num = (np.array(v, np.int64) for v in zip(*cells))
    row, n, m = np.searchsorted(order, y), len(combos), len(order)
    value = (num * y).astype(float)  # a left-over token costs the same wherever it lies
    size = np.sqrt(np.bincount(col, value**2, n))
    value /= size[col]
    h = np.array([counts[x] * x for x in order.tolist()], float)
    forward = lambda x: np.bincount(row, value * x[col], m)
    back = lambda r: np.bincount(col, value * r[row], n)
    v = np.ones(n)
    for _ in range(30):  # the largest curvature, by power iteration
        v = back(forward(v))
        v /= np.linalg.norm(v)
    step = 1 / (1.05 * np.linalg.norm(back(forward(v))))
    x = ahead = np.zeros(n)
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(ahead - step * back(forward(ahead) - h), 0.0)
        if (ahead - new) @ (new - x) > 0:  # overshot: start the acceleration anew
            t = 1.0
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, moved = new + (last - 1) / t * (new - x), np.abs((new - x) / size).max()
        x = new
        if moved < 1e-3:
            break
    return x / size


def greedy(counts: dict[int, int], capacity: int, open_packs: Counter | None = None) -> Counter:
    """Best fit decreasing on counts: {(lengths, ...): how many containers}."""
    packs: Counter = Counter()
    space: dict[int, Counter] = {}
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left > 0:
            fit = [s for s in space if s >= length]
            if fit:
                s = min(fit)
                shape = next(iter(space[s]))
                n = min(left, space[s][shape])
                space[s][shape] -= n
                if not space[s][shape]:
                    del space[s][shape]
                if not space[s]:
                    del space[s]
                new, rest = (*shape, length), s - length
            else:
                per = capacity // length
                n, new, rest = left // per, (length,) * per, capacity - per * length
                if not n:
                    n, new, rest, left = 1, (length,) * left, capacity - left * length, 1
                left -= n * (len(new) - 1)
            left -= n
            if rest > 0:
                space.setdefault(rest, Counter())[new] += n
            else:
                packs[new] += n
    for by in space.values():
        packs.update(by)
    return packs


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Shapes of containers and how many of each; together they hold every length exactly as often as counted."""
    counts = {x: n for x, n in counts.items() if n > 0}
    if not counts:
        return []
    combos = combinations(list(counts), counts, capacity)
    left, packs = dict(counts), Counter()
    if combos:
        times = np.floor(solve_counts(combos, counts) + 1e-6).astype(np.int64)
        for j in np.argsort(-times, kind="stable"):
            need = Counter(combos[j])
            n = min(int(times[j]), *(left[x] // k for x, k in need.items()))
            if n > 0:
                packs[combos[j]] += n
                for x, k in need.items():
                    left[x] -= n * k
    packs.update(greedy({x: n for x, n in left.items() if n}, capacity))
    return sorted(packs.items(), reverse=True)


def places(shapes: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: first ranks of its stretches, their first containers, and how many of the length a container takes."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    rank: Counter = Counter()
    first = 0
    for shape, n in shapes:
        for length, k in Counter(shape).items():
            out.setdefault(length, []).append((rank[length], first, k))
            rank[length] += n * k
        first += n
    return {x: tuple(np.array(c, np.int64) for c in zip(*v)) for x, v in out.items()}


def pieces(sizes: DataFrame, capacity: int | str, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """(*keep, id, piece, start, length): a document is split only if it is larger than the capacity (a number or a column), into full pieces and a rest."""
    most = F.col(capacity) if isinstance(capacity, str) else F.lit(capacity)
    n = F.ceil(F.col("tokens") / most).cast("int")
    cut = sizes.where("tokens > 0").select(*keep, id_col, "tokens", most.alias("most_"), F.explode(F.sequence(F.lit(0), n - 1)).alias("piece"))
    start = F.col("piece").cast("bigint") * F.col("most_")
    return cut.select(*keep, id_col, "piece", start.alias("start"), F.least(F.col("most_"), F.col("tokens") - start).cast("int").alias("length"))


def pack_kinds(sizes: DataFrame, kinds: dict[str, int], id_col: str = "doc_id") -> DataFrame:
    """(kind, capacity, id, piece, start, length, container_id, unused) for (id, tokens) rows and each kind of container.

    Every token lies in exactly one container of a kind. Rows without tokens (null, 0) get no container. Repeated ids are
    packed each. Only the number of pieces of each length goes to the driver (at most the sum of the capacities); ranks
    within a length are counted in ``SALTS`` parts by hash, so that no length is one task's work. No kinds give no rows.
    """
    spark = sizes.sparkSession
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(int(c)).alias("capacity")) for k, c in kinds.items()]).cast("array<struct<kind: string, capacity: int>>")).alias("k")
    each = sizes.select(id_col, "tokens", named).select(id_col, "tokens", "k.kind", "k.capacity")
    p = pieces(each, "capacity", id_col, ("kind", "capacity")).withColumn("salt", F.pmod(F.xxhash64(id_col, "piece"), F.lit(SALTS)).cast("int"))
    p = materialise(p, "pieces")
    ahead = Window.partitionBy("kind", "length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialise(p.groupBy("kind", "length", "salt").agg(F.count("*").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0))), "cells")
    counts: dict[str, Counter] = {k: Counter() for k in kinds}
    for r in cells.groupBy("kind", "length").agg(F.sum("n").alias("n")).collect():
        counts[r["kind"]][r["length"]] = r["n"]
    held = spark.sparkContext.broadcast({k: places(plan(counts[k], c)) for k, c in kinds.items()})
    rank = F.row_number().over(Window.partitionBy("kind", "length", "salt").orderBy(id_col, "piece"))
    ranked = p.withColumn("rank", rank).join(cells.drop("n"), ["kind", "length", "salt"])  # partitioned as the ranks are
    ranked = ranked.select("kind", "capacity", id_col, "piece", "start", "length", (F.col("rank") - 1 + F.col("ahead")).alias("rank"))

    def look_up(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        where = held.value
        for f in frames:
            out, rank = np.zeros(len(f), np.int64), f["rank"].to_numpy()
            for (kind, length), g in f.groupby(["kind", "length"], sort=False).indices.items():
                first, container, per = where[kind][length]
                k = np.searchsorted(first, rank[g], side="right") - 1
                out[g] = container[k] + (rank[g] - first[k]) // per[k]
            yield f.drop(columns=["rank"]).assign(container_id=out)

    kind = sizes.schema[id_col].dataType.simpleString()
    packed = ranked.mapInPandas(look_up, f"kind string, capacity int, `{id_col}` {kind}, piece int, start bigint, length int, container_id bigint")
    filled = F.sum("length").over(Window.partitionBy("kind", "container_id"))  # a container holds at most as many pieces as tokens
    return packed.withColumn("unused", F.col("capacity") - filled)


def pack(sizes: DataFrame, capacity: int, id_col: str = "doc_id") -> DataFrame:
    """``pack_kinds`` for one capacity: (id, piece, start, length, container_id)."""
    return pack_kinds(sizes, {"": capacity}, id_col).select(id_col, "piece", "start", "length", "container_id")


def containers(packed: DataFrame, capacity: int) -> DataFrame:
    """(container_id, pieces, used, unused)."""
    g = packed.groupBy("container_id").agg(F.count("*").alias("pieces"), F.sum("length").alias("used"))
    return g.select("container_id", "pieces", "used", (F.lit(capacity) - F.col("used")).alias("unused"))


def checks(packed: DataFrame, sizes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(kind, check, failed): documents whose tokens do not all lie in containers once, containers over their capacity, and documents split without need.

    Ids are taken as unique.
    """
    of = packed.groupBy("kind", id_col).agg(F.sum("length").alias("held"), F.count("*").alias("n"), F.first("capacity").alias("capacity"), F.count_distinct("start").alias("starts"), F.max(F.col("start") + F.col("length")).alias("last"))
    every = packed.select("kind").distinct().crossJoin(sizes.where("tokens > 0").select(id_col, "tokens"))  # one row a kind and document
    j = every.join(of, ["kind", id_col], "left")
    whole = F.coalesce((F.col("held") == F.col("tokens")) & (F.col("last") == F.col("tokens")) & (F.col("starts") == F.col("n")), F.lit(False))
    split = F.coalesce((F.col("n") > 1) & (F.col("tokens") <= F.col("capacity")), F.lit(False))
    bad = lambda c: F.sum(c.cast("bigint"))
    docs = j.groupBy("kind").agg(bad(~whole).alias("a"), bad(split).alias("b"))
    full = packed.groupBy("kind", "container_id").agg(F.sum("length").alias("used"), F.first("capacity").alias("capacity"), F.max("unused").alias("unused")).groupBy("kind").agg(bad((F.col("used") > F.col("capacity")) | (F.col("used") + F.col("unused") != F.col("capacity"))).alias("c"))
    cells = F.array(*[F.struct(F.lit(name).alias("check"), F.col(c).alias("failed")) for name, c in (("every_token_once", "a"), ("split_without_need", "b"), ("over_capacity", "c"))])
    return docs.join(full, "kind").select("kind", F.explode(cells).alias("x")).select("kind", "x.check", "x.failed")
