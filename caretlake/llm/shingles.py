"""Word shingles of whole texts as 48-bit numbers, computed batch by batch with numpy.

Tokens are the maximal runs of A-Z, a-z, 0-9 and _, in lower case; a shingle is a run of five
consecutive tokens; a text is the set of its distinct shingles. Two different shingles of one pair of
texts share a number with a chance of about |A|*|B| / 2**48, which is below 1e-7 for texts of 5,000 tokens.

A null or empty text, or one of fewer than five tokens, has no shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
CHUNK_BYTES = 1 << 20
_U = np.uint64


def _splitmix(n: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x9E3779B97F4A7C15) + _U(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, a bijection of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _lower_table() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    for c in b"abcdefghijklmnopqrstuvwxyz0123456789_":
        t[c] = c
    for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        t[c] = c + 32
    return t


_LOWER = _lower_table()
_BYTE = _splitmix(256, 11)
_MASK = 4095
with np.errstate(over="ignore"):
    _POW = np.cumprod(np.full(_MASK + 1, 0x5851F42D4C957F2D, np.uint64))
_STEP = _splitmix(WIDTH, 29) | _U(1)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls become empty texts."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, off, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(off, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offsets


def _tokens_of(cls: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start position of each token; ``cuts`` are positions at which a token ends in any case."""
    is_tok = cls != 0
    if not is_tok.any():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    start = is_tok.copy()
    start[1:] &= ~is_tok[:-1]
    cuts = cuts[cuts < len(cls)]
    start[cuts] |= is_tok[cuts]
    pos = np.flatnonzero(is_tok)
    starts = np.flatnonzero(start)
    first = np.searchsorted(pos, starts)
    within = np.arange(len(pos)) - np.repeat(first, np.diff(np.append(first, len(pos))))
    with np.errstate(over="ignore"):
        h = np.add.reduceat(_BYTE[cls[pos]] * _POW[within & _MASK], first)
    return mix(h), starts


def _long_tokens(data: np.ndarray) -> np.ndarray:
    """Token hashes of one long text, read in pieces that end between tokens."""
    out, at = [], 0
    while at < len(data):
        end = min(at + CHUNK_BYTES, len(data))
        while end < len(data) and _LOWER[data[end]] and _LOWER[data[end - 1]]:
            end += 1
        out.append(_tokens_of(_LOWER[data[at:end]], np.zeros(0, np.int64))[0])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _runs(tokens: np.ndarray) -> np.ndarray:
    """48-bit hashes of all runs of WIDTH tokens, duplicates included."""
    n = len(tokens) - WIDTH + 1
    with np.errstate(over="ignore"):
        h = tokens[:n] * _STEP[0]
        for k in range(1, WIDTH):
            h = h + tokens[k : n + k] * _STEP[k]
    return mix(h) >> _U(16)


def shingle_sets(column: pa.Array):
    """Yield (first row, last row + 1, values, bounds): the sorted distinct shingles of each text, in chunks.

    Row ``first + i`` has ``values[bounds[i]:bounds[i + 1]]``.
    """
    data, offsets = text_buffers(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = at + 1
        while end < n and end - at < 65535 and offsets[end + 1] - offsets[at] <= CHUNK_BYTES:
            end += 1
        lo, hi = offsets[at], offsets[end]
        if end == at + 1 and hi - lo > CHUNK_BYTES:
            t = _long_tokens(data[lo:hi])
            v = np.unique(_runs(t)) if len(t) >= WIDTH else np.zeros(0, np.uint64)
            yield at, end, v, np.array([0, len(v)])
            at = end
            continue
        tokens, starts = _tokens_of(_LOWER[data[lo:hi]], offsets[at:end] - lo)
        if len(tokens) < WIDTH:
            yield at, end, np.zeros(0, np.uint64), np.zeros(end - at + 1, np.int64)
            at = end
            continue
        doc = np.searchsorted(offsets[at : end + 1] - lo, starts, side="right").astype(np.uint64) - _U(1)
        runs = _runs(tokens)
        same = doc[: len(runs)] == doc[WIDTH - 1 :]
        key = np.sort((doc[: len(runs)][same] << _U(48)) | runs[same])
        key = key[np.append(True, key[1:] != key[:-1])] if len(key) else key
        bounds = np.searchsorted(key, np.arange(end - at + 1, dtype=np.uint64) << _U(48))
        yield at, end, key & _U((1 << 48) - 1), bounds
        at = end


def set_hashes(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 63-bit fingerprint of each set: equal for equal sets, 0 for the empty set."""
    sizes = np.diff(bounds)
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        with np.errstate(over="ignore"):
            s = np.add.reduceat(mix(values + _U(77)), bounds[:-1][full])
        out[full] = (mix(s + sizes[full].astype(np.uint64)) >> _U(1)) | _U(1)
    return out


def component_minima(values: np.ndarray, bounds: np.ndarray, components: int, seed: int = 5) -> np.ndarray:
    """For each non-empty set one minimum under each of ``components`` hash orders: a rows x components matrix."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.empty((len(full), components), np.uint64)
    if len(full):
        at = bounds[:-1][full]
        salt, factor = _splitmix(components, seed), _splitmix(components, seed + 1) | _U(1)
        with np.errstate(over="ignore"):
            for k in range(components):
                x = (values ^ salt[k]) * factor[k]
                out[:, k] = np.minimum.reduceat(x ^ (x >> _U(29)), at)
    return out


def list_column(values: np.ndarray, bounds: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Lists of numbers; rows that are not ``valid`` are null."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int64)), mask=None if valid is None else pa.array(~valid))


def packed_column(values: np.ndarray, bounds: np.ndarray, valid: np.ndarray) -> pa.Array:
    """The sets as bytes, six a shingle; rows that are not ``valid`` are null."""
    keep = np.repeat(valid, np.diff(bounds))
    data = values[keep].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    offsets = np.append(0, np.cumsum(np.diff(bounds) * valid * 6)).astype(np.int32)
    whole = pa.Array.from_buffers(pa.binary(), len(valid), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)])
    return pc.if_else(pa.array(valid), whole, pa.scalar(None, pa.binary()))


def unpacked(raw: bytes) -> np.ndarray:
    """The sorted shingles of a packed set."""
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many shingles two sorted sets have in common."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))
