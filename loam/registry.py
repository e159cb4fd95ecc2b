"""Queries of the library by name, and their SQL for DuckDB where SQL can express them."""

from __future__ import annotations

from loam.plans import evidence, queries, streams

QUERIES = queries.QUERIES | evidence.QUERIES | streams.QUERIES
ORACLE_SQL = queries.SQL | evidence.SQL | streams.SQL
