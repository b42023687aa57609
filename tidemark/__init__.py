"""Consolidation and summaries of operational data as Spark DataFrame operations."""

from .operators.consolidate import PositionRule, consolidate, rehydrate
from .operators.store import AggregateStore
from .sources.spec import JoinSpec, SourceSpec

__all__ = ["AggregateStore", "JoinSpec", "PositionRule", "SourceSpec", "consolidate", "rehydrate"]
