"""Row count and numeric sums of a table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exact import BIN, UNITS, bin_of, total, units_of
from tidemark.sources.spec import union_all

# The types that count as numeric, and how many such columns are summed.
NUMERIC_TYPES = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
SUMMED_COLUMNS = 3

PROFILE_ROW = (
    "table_name string, status string, error string, total_rows bigint, "
    "numeric_columns array<string>, sums string"
)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]


def _is_whole(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.IntegerType, T.LongType))


def _whole_sum(column: Column) -> Column:
    """Sum that cannot overflow: whole numbers are added as decimals."""
    return F.sum(column.cast("decimal(20,0)")).cast("decimal(38,0)")


def _measured(df: DataFrame, names: list[str]) -> DataFrame:
    """``total_rows`` and ``sum_<column>``, one row, one pass over the table.

    With columns of doubles each row is taken apart into itself, which carries the whole numbers, and its doubles in units
    of their bins; what is shuffled is a row per task, column and bin.
    """
    doubles = [n for n in names if not _is_whole(df, n)]
    whole = [n for n in names if n not in doubles]
    if not doubles:
        return df.agg(F.count("*").alias("total_rows"), *[_whole_sum(F.col(f"`{n}`")).alias(f"sum_{n}") for n in whole])
    row = F.struct(F.lit(-1).alias("at"), F.lit(None).cast("int").alias(BIN), F.lit(None).cast("double").alias("value"))
    parts = [row]
    for i, n in enumerate(doubles):
        value = F.col(f"`{n}`").cast("double")
        parts.append(F.struct(F.lit(i).alias("at"), bin_of(value).alias(BIN), value.alias("value")))
    apart = df.select(*[F.col(f"`{n}`").alias(f"w{i}") for i, n in enumerate(whole)], F.inline(F.array(*parts)))
    is_row = F.col("at") == -1
    by_bin = apart.groupBy("at", BIN).agg(
        F.count_if(is_row).alias("rows"),
        F.sum(units_of(F.col("value"), F.col(BIN))).cast("decimal(38,0)").alias(UNITS),
        *[_whole_sum(F.when(is_row, F.col(f"w{i}"))).alias(f"w{i}") for i in range(len(whole))],
    )
    part = F.struct(BIN, UNITS)
    sums = {n: total(F.when(F.col("at") == i, part)) for i, n in enumerate(doubles)}
    sums |= {n: F.sum(f"w{i}").cast("decimal(38,0)") for i, n in enumerate(whole)}
    rows = F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows")
    return by_bin.agg(rows, *[sums[n].alias(f"sum_{n}") for n in names])


def profile(df: DataFrame, limit: int | None = SUMMED_COLUMNS) -> DataFrame:
    """``total_rows``, ``numeric_columns`` and ``sum_<column>`` of the first ``limit`` of them (None: all); one pass.

    Sums are exact before their last rounding, so they do not depend on the order or the splits of the rows.
    """
    names = numeric_columns(df)
    listed = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    return _measured(df, names[:limit]).select(
        "total_rows", listed.alias("numeric_columns"), *[f"`sum_{n}`" for n in names[:limit]]
    )


def profile_row(name: str, df: DataFrame, limit: int | None = SUMMED_COLUMNS) -> DataFrame:
    """:func:`profile` in a shape common to all tables: the sums as JSON text."""
    measured = profile(df, limit)
    sums = [c for c in measured.columns if c.startswith("sum_")]
    as_json = F.to_json(F.struct(*sums), {"ignoreNullFields": "false"}) if sums else F.lit("{}")
    return measured.select(
        F.lit(name).alias("table_name"),
        F.lit("success").alias("status"),
        F.lit(None).cast("string").alias("error"),
        "total_rows",
        "numeric_columns",
        as_json.alias("sums"),
    )


def profile_error(spark: SparkSession, name: str, error: str) -> DataFrame:
    """Row for a table that could not be profiled, in the schema of :func:`profile_row`."""
    known = {"table_name": name, "status": "error", "error": error}
    return spark.range(1).select(
        *[
            F.lit(known.get(f.name)).cast(f.dataType).alias(f.name)
            for f in T.StructType.fromDDL(PROFILE_ROW).fields
        ]
    )


def profile_many(tables: Mapping[str, DataFrame], limit: int | None = SUMMED_COLUMNS) -> DataFrame:
    """One row per table; all tables are scanned in one job."""
    return union_all([profile_row(name, df, limit) for name, df in tables.items()])
