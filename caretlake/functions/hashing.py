"""Deterministic numbers and ids from content: SHA-256 over parts joined by the unit separator, null parts left out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEP = "\x1f"


def uniform(*parts: Column) -> Column:
    """A number in [0, 1): the first 53 bits of the hash over 2**53, equal in every engine."""
    head = F.conv(F.substring(F.sha2(F.concat_ws(SEP, *parts), 256), 1, 14), 16, 10).cast("bigint")
    return F.shiftrightunsigned(head, 3).cast("double") / F.lit(2.0**53)


def stable_id(*parts: Column) -> Column:
    """The first 32 hex digits of the hash."""
    return F.substring(F.sha2(F.concat_ws(SEP, *parts), 256), 1, 32)
