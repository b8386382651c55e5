"""How common shingles are, from a count sketch of bounded size.

The sketch has about as many counters as an eighth of all shingles, between 2**18 and 2**24. A shingle's level is the
logarithm of its slot's count, eight steps an octave; shingles of unknown exact count are thereby put in one order that
is the same for all texts, about the rarest first. No result depends on exact counts. Beyond some 700,000 texts the
sketch grows no more and twice the mean load of a slot is added to ``COMMON_FROM``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from caretlake.llm import shingles as S
from caretlake.session import own_shuffles, spread

LEAST, MOST = 1 << 18, 1 << 24
PIECE = 1 << 16
COMMON_FROM = 256  # texts, whatever the size of the collection, so that buckets of rare shingles do not grow with it
SHINGLES_A_TEXT = 200  # only to choose the size of the sketch


@dataclass(frozen=True)
class Rarity:
    """``levels`` of the slots (uint8); shingles above ``common`` stand in more than about ``COMMON_FROM`` texts."""

    levels: np.ndarray
    common: int

    def level(self, values: np.ndarray) -> np.ndarray:
        return self.levels[slot(values, len(self.levels))]

    def rare(self, values: np.ndarray) -> np.ndarray:
        return self.level(values) <= self.common


def slot(values: np.ndarray, slots: int) -> np.ndarray:
    return (S.mix(values + np.uint64(991)) & np.uint64(slots - 1)).astype(np.int64)


def slots_for(texts: int) -> int:
    n = LEAST
    while n < MOST and n * 8 < texts * SHINGLES_A_TEXT:
        n *= 2
    return n


def rarity_of(docs: DataFrame, text: str) -> Rarity:
    """Counted over all distinct shingles of all texts."""
    texts = docs.count()
    slots = slots_for(texts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.uint32)
        for b in batches:
            for _, _, values, _ in S.shingle_sets(b.column(0)):
                at, n = np.unique(slot(values, slots), return_counts=True)
                total[at] += n.astype(np.uint32)
        task = TaskContext.get()
        salt = task.partitionId() % 32 if task else 0
        pieces = total.reshape(-1, PIECE)
        live = [k for k in range(len(pieces)) if pieces[k].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(live, pa.int64()), pa.array([salt] * len(live), pa.int64()), pa.array([pieces[k].tobytes() for k in live], pa.binary())], names=["piece", "salt", "counts"]
        )

    def merge(key: tuple, frames: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(PIECE, np.uint64)
        for c in frames["counts"]:
            total += np.frombuffer(c, np.uint32)
        return pd.DataFrame({"piece": [key[0]], "counts": [np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()]})

    def levels(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            counts = [np.frombuffer(c, np.uint32) for c in f["counts"]]
            yield pd.DataFrame({"piece": f["piece"], "sum": [int(c.sum(dtype=np.uint64)) for c in counts], "levels": [levels_of(c).tobytes() for c in counts]})

    with own_shuffles(docs.sparkSession):
        parts = spread(docs.select(text)).mapInArrow(count, "piece bigint, salt bigint, counts binary")
        merged = parts.groupBy("piece", "salt").applyInPandas(merge, "piece bigint, counts binary").groupBy("piece").applyInPandas(merge, "piece bigint, counts binary")
        rows = merged.mapInPandas(levels, "piece bigint, sum bigint, levels binary").collect()  # at most 16 MB in all
    out, total = np.zeros(slots, np.uint8), 0
    for r in rows:
        out[r["piece"] * PIECE : (r["piece"] + 1) * PIECE] = np.frombuffer(r["levels"], np.uint8)
        total += r["sum"]
    return Rarity(out, int(8 * math.log2(2 * total / slots + COMMON_FROM)))


def levels_of(counts: np.ndarray) -> np.ndarray:
    return (8 * np.log2(np.maximum(counts, 1))).astype(np.uint8)
