"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """The smallest node that each node of ``edges`` (a, b) can reach: columns node, root.

    Rounds of two steps: each node passes its larger neighbours to its smallest one, then its smaller neighbours. Every
    step is a minimum per node, which Spark reduces before the shuffle, and a join, whose hot keys it can split. The
    graph ends as stars around the roots; each round is written out, so a lost executor costs no earlier round. Loops,
    repeated edges and null ends are left out; an empty table has no rows.
    """
    now = edges.select("a", "b").where(F.col("a") != F.col("b"))
    now = stored(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("k")).where(F.col("b") > F.col("a"))
        now = stored(large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "edges")
        least = now.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        small = now.join(least, F.col("a") == F.col("k"))
        # The edge to the smallest stays; every other end is passed on to it.
        small = small.select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")
        )
        now = stored(small.distinct(), "edges")
        figures = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if before == figures:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = figures
    raise RuntimeError(f"components did not settle within {most_rounds} rounds")
