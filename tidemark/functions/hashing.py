"""Content hash of a row: equal content gives an equal digest."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fields that never take part in the content hash.
UNHASHED_FIELDS = ("created_at", "updated_at", "version")


def _canonical(column: Column, data_type: T.DataType) -> Column:
    """Order everything whose order carries no meaning: map keys and struct fields."""
    if isinstance(data_type, T.MapType):
        entries = F.transform(
            F.map_entries(column),
            lambda e: F.struct(
                e["key"].alias("key"), _canonical(e["value"], data_type.valueType).alias("value")
            ),
        )
        by_key = F.array_sort(
            entries,
            lambda a, b: F.when(a["key"] < b["key"], -1).when(a["key"] > b["key"], 1).otherwise(0),
        )
        return F.map_from_entries(by_key)
    if isinstance(data_type, T.ArrayType):
        return F.transform(column, lambda e: _canonical(e, data_type.elementType))
    if isinstance(data_type, T.StructType):
        parts = [
            _canonical(column[f.name], f.dataType).alias(f.name)
            for f in sorted(data_type.fields, key=lambda f: f.name)
        ]
        return F.when(column.isNotNull(), F.struct(*parts))
    return column


def canonical_json(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """JSON text of the given columns in name order, NULLs included."""
    wanted = set(df.columns if columns is None else columns) - set(UNHASHED_FIELDS)
    fields = sorted((f for f in df.schema.fields if f.name in wanted), key=lambda f: f.name)
    if not fields:
        raise ValueError("no columns left to hash")
    parts = [_canonical(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def content_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """SHA-256 hex digest of :func:`canonical_json`; never NULL, and declared so to the optimizer."""
    return F.coalesce(F.sha2(canonical_json(df, columns), 256), F.lit(""))
