"""Reading and writing catalog tables and files."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spellings of the predicate option accepted by catalog scans.
PREDICATE_OPTIONS = ("pushdownPredicate", "push_down_predicate", "catalogPartitionPredicate")

# Option names that Spark's readers spell differently.
READER_OPTION_NAMES = {
    "multiline": "multiLine",
    "withHeader": "header",
    "separator": "sep",
    "quoteChar": "quote",
    "escaper": "escape",
}


def scan_catalog(
    spark: SparkSession, database: str, table: str, options: Mapping[str, object] | None = None
) -> DataFrame:
    """Read ``database.table``. A predicate option becomes a filter; the rest goes to the reader."""
    given = dict(options or {})
    predicates = [str(given.pop(name)) for name in PREDICATE_OPTIONS if given.get(name)]
    reader = spark.read.options(**given) if given else spark.read
    df = reader.table(f"`{database}`.`{table}`")
    for predicate in predicates:
        df = df.where(predicate)
    return df


def scan_files(
    spark: SparkSession,
    path: str | Sequence[str],
    format: str = "parquet",
    options: Mapping[str, object] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read a file set in any format Spark knows. Give ``schema`` to avoid an inference pass over text formats."""
    reader = spark.read.format(format).options(
        **{READER_OPTION_NAMES.get(k, k): v for k, v in (options or {}).items()}
    )
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path if isinstance(path, str) else list(path))


def gathered(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Rows of one partition value close together, so that a partitioned write makes few files.

    Adaptive execution splits a partition value that holds much of the table and merges small ones.
    """
    return df.hint("rebalance", *partition_columns) if partition_columns else df


def write_files(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "overwrite",
    partition_columns: Sequence[str] = (),
    options: Mapping[str, object] | None = None,
    gather: bool = True,
    only_touched: bool = False,
) -> None:
    """Write ``df`` as files, one directory per partition value when ``partition_columns`` is given.

    ``mode="overwrite"`` replaces everything, or with ``only_touched`` just the partitions present in ``df``. Turn
    ``gather`` off when the rows already lie together by partition value, to save the shuffle.
    """
    if gather:
        df = gathered(df, partition_columns)
    writer = df.write.format(format).mode(mode).options(**dict(options or {}))
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
        if only_touched and mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def write_table(
    df: DataFrame,
    database: str,
    table: str,
    mode: str = "overwrite",
    format: str = "parquet",
    partition_columns: Sequence[str] = (),
    bucket_columns: Sequence[str] = (),
    buckets: int = 0,
) -> None:
    """Write ``df`` as catalog table. Bucketing lets later joins on the same columns skip that side's shuffle."""
    # One task per bucket, or every task would write a file into every bucket.
    df = df.repartition(buckets, *bucket_columns) if buckets else gathered(df, partition_columns)
    writer = df.write.format(format).mode(mode)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    if buckets:
        first, *others = bucket_columns
        writer = writer.bucketBy(buckets, first, *others).sortBy(first, *others)
    writer.saveAsTable(f"`{database}`.`{table}`")


def target_fields(spark: SparkSession, database: str, table: str) -> tuple[list[T.StructField], list[str]]:
    """Fields of a catalog table, ordinary columns first, and the names of its partition columns."""
    name = f"`{database}`.`{table}`"
    fields = {f.name: f for f in spark.table(name).schema.fields}
    partitions = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    ordinary = [f for n, f in fields.items() if n not in partitions]
    return ordinary + [fields[n] for n in partitions], partitions


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new directory every executor can reach: below ``spark.checkpoint.dir``, or temporary in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return os.path.join(shared, f"{label}-{uuid.uuid4().hex}")


def row_count(df: DataFrame, into: str = "record_count") -> DataFrame:
    """Number of rows; on parquet this reads file footers only."""
    return df.agg(F.count("*").alias(into))
