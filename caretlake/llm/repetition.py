"""The repeated share of each document, and filters whose thresholds follow the data.

Words: text in lower case, all characters but letters, digits and white space dropped, cut at white space. A run of
eight consecutive words is repeated if the same run starts earlier in the document; the repeated share is the part of
the words that lie in repeated runs. Shares of repeated lines and blocks (paragraphs) are measured beside it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caretlake.session import spread

RUN = 8
CHUNK_BYTES = 1 << 22
_DROP = re.compile(r"[^\w\s]+|_+")
_U = np.uint64


def words_of(text: str) -> list[str]:
    return _DROP.sub("", text.lower()).split()


def repeated_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """For each text its number of words and of words in repeated runs; computed for all texts of a batch at once."""
    from caretlake.llm.shingles import _splitmix, mix

    codes: dict[str, int] = {}
    flat: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        if t:
            w = words_of(t)
            sizes[k] = len(w)
            flat.extend(codes.setdefault(x, len(codes)) for x in w)
    covered = np.zeros(len(texts), np.int64)
    total = len(flat)
    if total < RUN:
        return sizes, covered
    row = np.repeat(np.arange(len(texts)), sizes)
    n = total - RUN + 1
    whole = row[:n] == row[RUN - 1 :]
    step = _splitmix(RUN, 3) | _U(1)
    with np.errstate(over="ignore"):
        c = mix(np.array(flat, np.uint64) + _U(1))
        h = row[:n].astype(np.uint64) * _U(0x9E3779B97F4A7C15)
        for i in range(RUN):
            h = h + c[i : n + i] * step[i]
    at = np.flatnonzero(whole)
    h = mix(h[at])
    order = np.argsort(h, kind="stable")  # equal runs keep their order in the text, so all but the first are repeated
    again = np.zeros(len(at), bool)
    again[order[1:]] = h[order[1:]] == h[order[:-1]]
    starts = at[again]
    edge = np.zeros(total + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + RUN, -1)
    np.add.at(covered, row[np.cumsum(edge[:total]) > 0], 1)
    return sizes, covered


def _parts(text: str, block: bool) -> tuple[int, int]:
    """Characters in repeated lines (or blocks of lines) and in all of them; blank ones do not count."""
    seen, again, total = set(), 0, 0
    for x in re.split(r"\n[ \t\r]*\n" if block else "\n", text):
        x = " ".join(x.split())
        if x:
            total += len(x)
            again += len(x) if x in seen else 0
            seen.add(x)
    return again, total


def chunks(column: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of runs of texts of at most ``CHUNK_BYTES`` together; a longer text stands alone. Memory follows that bound, not the batch."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_BYTES, side="right")))
        yield at, end
        at = end


def repetition(documents: DataFrame, id_col: str = "doc_id", text: str = "text", keep: list[str] = ()) -> DataFrame:
    """(id, *keep, words, repeated_words, line_share, block_share) of every document.

    Null and empty texts have no words and shares of 0. Repeated rows are measured each; other columns are not read.
    """
    fields = [documents.schema[c] for c in (id_col, *keep)]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", words bigint, repeated_words bigint, line_share double, block_share double"
    k = len(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo, hi in chunks(whole.column(k)):
                b = whole.slice(lo, hi - lo)
                texts = b.column(k).to_pylist()
                size, covered = repeated_words(texts)
                shares = [[a / n if n else 0.0 for a, n in (_parts(t or "", block) for t in texts)] for block in (False, True)]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:k], pa.array(size), pa.array(covered), pa.array(shares[0], pa.float64()), pa.array(shares[1], pa.float64())],
                    names=[*(f.name for f in fields), "words", "repeated_words", "line_share", "block_share"],
                )

    return spread(documents.select(id_col, *keep, text)).mapInArrow(run, schema)


def clean_label(c: Column) -> Column:
    t = F.lower(F.trim(c))
    return F.when(t != "", t)


def share_sketches(measured: DataFrame, by: list[str], size: int = 4096) -> DataFrame:
    """(*by, documents, sketch): a quantile sketch (KLL) of the repeated share of each group; documents without words do not count.

    Sketches are of bounded size and are built from partial ones on every task. A group of up to about ``size`` documents
    is held exactly; beyond that the rank error is under 1/1000.
    """
    share = F.col("repeated_words") / F.col("words")
    return measured.where("words > 0").groupBy(*by).agg(F.count("*").alias("documents"), F.kll_sketch_agg_double(share, size).alias("sketch"))


def merged_sketches(*parts: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of several batches, or of several groups where ``by`` names fewer columns, as those of all their documents."""
    every = parts[0]
    for x in parts[1:]:
        every = every.unionByName(x)
    return every.groupBy(*by).agg(F.sum("documents").alias("documents"), F.kll_merge_agg_double("sketch").alias("sketch"))


def adaptive_thresholds(sketches: DataFrame, by: list[str], quantile: float = 0.9, factor: float = 3.0, prior: int = 500, least: float | None = None, most: float | None = None) -> DataFrame:
    """(*by, documents, threshold) from the sketches of ``share_sketches`` or ``merged_sketches``.

    The threshold is ``factor`` times the group's quantile, taken together with that of all documents, which counts like
    ``prior`` documents: a group of a few documents leans on the whole, a large one stands for itself. ``least`` and
    ``most`` may clamp it; by default nothing does.
    """
    at = lambda c: F.kll_sketch_get_quantile_double(c, F.lit(float(quantile)))
    whole = merged_sketches(sketches, by=[]).select(at("sketch").alias("whole"))  # one row
    n = F.col("documents")
    t = F.lit(float(factor)) * (n * at("sketch") + F.lit(prior) * F.col("whole")) / (n + F.lit(prior))
    if least is not None:
        t = F.greatest(F.lit(float(least)), t)
    if most is not None:
        t = F.least(F.lit(float(most)), t)
    return sketches.crossJoin(F.broadcast(whole)).select(*by, "documents", t.alias("threshold"))


def repetitive(measured: DataFrame, cutoff_percent: int = 30) -> DataFrame:
    """Documents of which at least ``cutoff_percent`` of the words lie in repeated runs, in whole numbers."""
    return measured.where((F.col("words") > 0) & (F.col("repeated_words") * 100 >= F.col("words") * cutoff_percent))


def repetitive_adaptive(measured: DataFrame, thresholds: DataFrame, by: list[str]) -> DataFrame:
    """Documents at or above the threshold of their group, joined null-safely, with ``threshold``."""
    t = thresholds.select(*[F.col(c).alias(f"__{c}") for c in by], "threshold")
    cond = None
    for c in by:
        e = F.col(c).eqNullSafe(F.col(f"__{c}"))
        cond = e if cond is None else cond & e
    j = measured.join(t, cond).drop(*[f"__{c}" for c in by])
    return j.where((F.col("repeated_words") > 0) & (F.col("repeated_words") >= F.col("threshold") * F.col("words")))
