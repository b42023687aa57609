"""Type normalisation that never aborts a job on one malformed value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def field_type(df: DataFrame, name: str) -> T.DataType:
    """Type of a top-level column, with a clear error when it is absent."""
    if name not in df.columns:
        raise ValueError(f"column '{name}' not found; available: {df.columns}")
    return df.schema[name].dataType


def to_event_time(column: Column, timestamp_type: str = "timestamp") -> Column:
    """Text, date or timestamp to a timestamp; unreadable text becomes NULL."""
    return column.try_cast(timestamp_type)


def to_rank_number(column: Column, data_type: T.DataType) -> Column:
    """Any numeric form to bigint. Text such as ``'3.0'`` is truncated, not lost."""
    whole = column.try_cast("bigint")
    if isinstance(data_type, T.StringType):
        return F.coalesce(whole, column.try_cast("double").try_cast("bigint"))
    return whole


def is_temporal(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType))
