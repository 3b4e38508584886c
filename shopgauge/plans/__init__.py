"""Registered queries with their default parameters and oracle SQL."""

from .oracle import oracle_sql
from .registry import queries

__all__ = ["queries", "oracle_sql"]
