"""All queries over the given tables, and their SQL."""

from __future__ import annotations

from . import graph_queries, ingest_queries, lifecycle_queries, search_queries  # noqa: F401
from .base import ORACLE_SQL, QUERIES

FLAGSHIP = "q1_ingest_batch"

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
