"""All queries of the core library and their SQL."""

from __future__ import annotations

from caretlake.plans import dataset_queries

MODULES = [dataset_queries]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict:
    return {k: s for m in MODULES for k, s in m.ORACLE.items()}
