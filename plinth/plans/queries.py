"""All queries of the engine."""

from __future__ import annotations

from . import cloud_queries, relational_queries, spatial_queries, view_queries  # noqa: F401  they register their queries
from .registry import ENTRIES, Query


def queries() -> dict[str, Query]:
    return {name: e.run for name, e in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: e.sql for name, e in ENTRIES.items() if e.sql}
