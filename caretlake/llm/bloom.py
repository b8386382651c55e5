"""Bloom filters over 64-bit ids, of bounded size, to keep rows that cannot join from being read or moved.

The filter has about 16 bits per id and at most ``2**28`` bits (32 MB); beyond that it lets more rows pass, which
costs time but changes no result, since an exact join follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame

from caretlake.session import own_shuffles

MAX_BITS = 1 << 28
_PIECE = 1 << 19  # bits of one piece, so that pieces of many tasks are merged in parallel


def _slots(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    from caretlake.llm.shingles import mix

    h = mix(ids.astype(np.uint64) + np.uint64(0x51ED270B))
    with np.errstate(over="ignore"):
        return [((h >> np.uint64(s)) + np.uint64(s) * (h >> np.uint64(40))) & np.uint64(bits - 1) for s in (0, 17, 31)]


class Bloom:
    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.bits = words, bits

    def might_hold(self, ids: np.ndarray) -> np.ndarray:
        ok = np.ones(len(ids), bool)
        for s in _slots(ids, self.bits):
            ok &= (self.words[(s >> np.uint64(3)).astype(np.int64)] >> (s & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return ok


def build(df: DataFrame, column: str, count: int, max_bits: int = MAX_BITS) -> Bloom:
    """A filter of the (non-null) bigint column; ``count`` is about its number of rows."""
    bits = _PIECE
    while bits < 16 * max(count, 1) and bits < max_bits:
        bits *= 2

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = np.zeros(bits // 8, np.uint8)
        for f in frames:
            for s in _slots(f.iloc[:, 0].to_numpy(np.int64).view(np.uint64), bits):
                np.bitwise_or.at(words, (s >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (s & np.uint64(7)).astype(np.uint8)))
        pieces = words.reshape(-1, _PIECE // 8)
        live = np.flatnonzero(pieces.any(axis=1))
        if len(live):
            task = TaskContext.get()
            salt = task.partitionId() % 64 if task else 0
            yield pd.DataFrame({"piece": live.astype(np.int64), "salt": np.int64(salt), "words": [pieces[k].tobytes() for k in live]})

    def merge(key: tuple, frames: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros(_PIECE // 8, np.uint8)
        for w in frames["words"]:
            out |= np.frombuffer(w, np.uint8)
        return pd.DataFrame({"piece": [key[0]], "words": [out.tobytes()]})

    with own_shuffles(df.sparkSession):
        parts = df.select(column).where(df[column].isNotNull()).mapInPandas(partial, "piece bigint, salt bigint, words binary")
        merged = parts
        if bits > _PIECE:  # in two steps: no group holds the pieces of more than a 64th of all tasks
            merged = merged.groupBy("piece", "salt").applyInPandas(merge, "piece bigint, words binary")
        merged = merged.groupBy("piece").applyInPandas(merge, "piece bigint, words binary")
        rows = merged.collect()  # at most max_bits in all
    words = np.zeros(bits // 8, np.uint8)
    for r in rows:
        words[r["piece"] * _PIECE // 8 : (r["piece"] + 1) * _PIECE // 8] = np.frombuffer(r["words"], np.uint8)
    return Bloom(words, bits)
