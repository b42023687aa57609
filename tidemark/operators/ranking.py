"""First row per key under a descending order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_value(columns: Sequence[str | Column]) -> Column:
    """One comparable value; a greater one ranks first and NULL ranks last, as in ``DESC NULLS LAST``."""
    return F.struct(
        *[
            (F.col(c) if isinstance(c, str) else c).alias(f"r{i}")
            for i, c in enumerate(columns)
        ]
    )


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row that ranks first for every key.

    ``max_by`` keeps one row per key and task before the shuffle, so a key holding a large part of the table
    sends at most one row per input split to its reducer.
    """
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), rank_value(order)).alias("__best")
    )
    return best.select(*keys, "__best.*").select(*[F.col(f"`{c}`") for c in df.columns])
