"""Texts, lines and offsets: bytes are authoritative, UTF-16 units are derived."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HSPACE = " \t\x0b\x0c"


def utf16_len(c: Column) -> Column:
    """UTF-16 units of a text."""
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def rtrim_hspace(c: Column) -> Column:
    """Without trailing spaces, tabs, vertical tabs and form feeds."""
    return F.rtrim(c, F.lit(HSPACE))


def newline_style(c: Column) -> Column:
    """none, lf, crlf or mixed."""
    all_lf = F.length(c) - F.length(F.replace(c, F.lit("\n"), F.lit("")))
    crlf = (F.length(c) - F.length(F.replace(c, F.lit("\r\n"), F.lit("")))) / 2
    return F.when(all_lf == 0, "none").when(crlf == 0, "lf").when(crlf == all_lf, "crlf").otherwise("mixed")


def slug(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9_.-]+", "__")


def last_units(c: Column, n: int) -> Column:
    """The last ``n`` UTF-16 units, one less where a surrogate pair would be cut."""
    raw = F.encode(c, "UTF-16BE")
    k = F.octet_length(raw)
    cut = F.when(k > 2 * n, F.substr(raw, k - F.lit(2 * n - 1))).otherwise(raw)
    low = F.hex(F.substr(cut, F.lit(1), F.lit(1))).between("DC", "DF") & (k > 2 * n)
    return F.decode(F.when(low, F.substr(cut, F.lit(3))).otherwise(cut), "UTF-16BE")


def first_units(c: Column, n: int) -> Column:
    """The first ``n`` UTF-16 units, one less where a surrogate pair would be cut."""
    raw = F.encode(c, "UTF-16BE")
    cut = F.substr(raw, F.lit(1), F.lit(2 * n))
    high = F.hex(F.substr(cut, F.octet_length(cut) - 1, F.lit(1))).between("D8", "DB") & (F.octet_length(cut) == 2 * n)
    return F.decode(F.when(high, F.substr(cut, F.lit(1), F.lit(2 * n - 2))).otherwise(cut), "UTF-16BE")


def line_table(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, line, start, bytes, u16_start, content, eol): one row per line, without a shuffle.

    Lines end at LF; a CR before it belongs to the line end. A text that ends with LF has an empty last line. ``start``
    and ``bytes`` count UTF-8 bytes, ``u16_start`` UTF-16 units. A null text has no lines, an empty one has one.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, line, starts, sizes, units, content, eol = [], [], [], [], [], [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                if t is None:
                    continue
                parts = t.split("\n")
                wide = not t.isascii()
                pos = u = 0
                for k, p in enumerate(parts):
                    last = k == len(parts) - 1
                    cr = not last and p.endswith("\r")
                    body = p[:-1] if cr else p
                    n = len(p.encode()) if wide else len(p)
                    at.append(i)
                    line.append(k)
                    starts.append(pos)
                    sizes.append(n - cr)
                    units.append(u)
                    content.append(body)
                    eol.append("EOF" if last else "CRLF" if cr else "LF")
                    pos += n + 1
                    u += (len(p.encode("utf-16-le")) // 2 if wide else len(p)) + 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(np.array(at, np.int64))), pa.array(line, pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int32()), pa.array(units, pa.int64()), pa.array(content, pa.string()), pa.array(eol, pa.string())],
                names=[id_col, "line", "start", "bytes", "u16_start", "content", "eol"],
            )

    return df.select(id_col, text).mapInArrow(run, f"`{id_col}` {kind}, line int, start bigint, bytes int, u16_start bigint, content string, eol string")


def byte_of_utf16(text: str, unit: int) -> int | None:
    """Byte offset of a UTF-16 offset; None inside a surrogate pair or outside the text."""
    if unit < 0:
        return None
    pos = u = 0
    for c in text:
        if u == unit:
            return pos
        pos += len(c.encode())
        u += 2 if ord(c) > 0xFFFF else 1
    return pos if u == unit else None
