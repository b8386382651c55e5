"""Labels and names as they stand in the tables, made comparable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_split(c: Column) -> Column:
    """Split labels: letter case and outer blanks do not matter; eval and val mean validation; blank is null."""
    t = F.lower(F.trim(c))
    return F.when(t.isin("eval", "val"), "validation").when(t == "", None).otherwise(t)


def clean_name(c: Column) -> Column:
    """Group names: letter case and outer blanks do not matter; blank names nothing."""
    t = F.lower(F.trim(c))
    return F.when(t != "", t)
