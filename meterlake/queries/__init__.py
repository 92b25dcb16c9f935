"""Registered queries: each name pairs a Spark query over the sample tables with the SQL that must give its result."""

from meterlake.queries import columns, facts, guards, keyed, marts, merges, scans, stored, timeline  # noqa: F401
from meterlake.queries.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
