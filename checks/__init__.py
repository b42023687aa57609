"""Registered queries: every operator on the given tables, next to SQL that computes the same."""

from .registry import ORACLE, QUERIES
from . import consolidation, joins, ledger, sales, store, tables, jobs  # noqa: F401  (they register themselves)

__all__ = ["ORACLE", "QUERIES"]
