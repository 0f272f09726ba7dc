"""Registered queries, their DuckDB oracle SQL and the batch job."""

from .oracle import ORACLE_SQL
from .queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
