"""Rows of keys in order, in pieces of a bounded number of rows, however a key is spread over its order column.

Rows are written once by ranges of (key, order), so a key of any size is split along its order by what Spark samples of the
data itself. Rows are numbered within a range and cut every so many; later jobs and retries read the same cuts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import scratch_path

RANGE, PIECE, PLACE, TIE = "__range", "__piece", "__place", "__tie"


def in_ranges(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``df`` with ``__range``, written by ranges of the columns, NULLs first: rows of a lower range come first.

    Spark samples the limits of the ranges, one per shuffle partition, so they fit the data. What is equal in the columns is in one
    range.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    dealt = df.repartitionByRange(ranges, *[F.col(f"`{c}`").asc_nulls_first() for c in order_by])
    dealt = dealt.withColumn(RANGE, F.spark_partition_id())
    dealt.write.parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def in_pieces(df: DataFrame, key: str, order_by: Sequence[str], rows: int) -> DataFrame:
    """``df`` with ``__range``, ``__piece`` and ``__place``: (key, range, piece) names at most ``rows`` neighbours of a key.

    Sorted by range and piece, the pieces of a key are in its order; the place orders the rows of a piece. NULLs come first.
    ``order_by`` must order the rows of a key fully; what is equal in it may be cut anywhere.
    """
    order = [F.col(c).asc_nulls_first() for c in (key, *order_by)]
    dealt = in_ranges(df, [key, *order_by])
    place = F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))
    return dealt.withColumn(PLACE, place).withColumn(PIECE, F.floor((F.col(PLACE) - 1) / rows).cast("bigint"))


def number_rows(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], into: str) -> DataFrame:
    """Number the rows of every key from 1 in ascending order, NULLs first. A row with a NULL key gets a NULL number.

    The table is read once and written by ranges of (keys, order, a row number), so that a key of any size is split, also where all
    its order values are equal; rows that are equal in ``order_by`` come in any order, but always in the same. Rows are
    numbered within a range, and a row per key and range says how many come before.
    """
    dealt = in_ranges(df.withColumn(TIE, F.monotonically_increasing_id()), [*keys, *order_by, TIE])
    ascending = [F.col(f"`{c}`").asc_nulls_first() for c in (*order_by, TIE)]
    part = [*[F.col(f"`{k}`") for k in keys], F.col(RANGE)]
    local = dealt.withColumn(into, F.row_number().over(Window.partitionBy(*part).orderBy(*ascending)))
    before = Window.partitionBy(*part[:-1]).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*part).agg(F.count("*").alias("__size"))
    offsets = counts.select(*part, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    number = (F.col(f"`{into}`") + F.col("__offset")).alias(into)
    return local.join(offsets, on=[*keys, RANGE], how="left").select(*[F.col(f"`{c}`") for c in df.columns], number)
