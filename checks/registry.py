from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if SQL can say the same, its oracle."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query '{name}' is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def published(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The table under a ``db.table`` name without copying it."""
    table(spark, sf_dir, name).createOrReplaceGlobalTempView(name)
    return f"{spark.conf.get('spark.sql.globalTempDatabase', 'global_temp')}.{name}"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text, which every client reads alike."""
    return df.withColumns(
        {
            f.name: F.col(f.name).cast("double" if isinstance(f.dataType, T.DecimalType) else "string")
            for f in df.schema.fields
            if isinstance(f.dataType, (T.DecimalType, T.DateType))
        }
    )


def scratch_database(spark: SparkSession) -> str:
    """A new catalog database whose tables live in the shared scratch folder."""
    name = f"tidemark_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name
