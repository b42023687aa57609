"""Ordered work on keys that may be very large.

Comparing neighbours inside one key needs the rows of that key in order. A plain window would put
a hot key on one task. Here every key is cut along its order into chunks; the chunk is a fixed function of the
order value, so it is the same whenever it is computed again. Rows are handled per (key, chunk), and only one
summary row per chunk is brought together per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_CHUNK = 1_000_000
SECONDS_PER_CHUNK = 3600
CHUNK = "__chunk"
_BEFORE_ALL = -(2**63)


def order_chunk(df: DataFrame, order_column: str, width: int | None = None) -> Column:
    """Chunk number that never falls while ``order_column`` rises; rows without an order value come first.

    Numbers are cut every ``width`` units (default one million: for a row position that is a hard bound on the
    rows per chunk), timestamps every ``width`` seconds (default one hour), dates per day.
    """
    data_type = df.schema[order_column].dataType
    column = F.col(order_column)
    if isinstance(data_type, T.IntegralType):
        # In whole numbers, rounded down: a double would mix up large ones.
        unit = int(width or ROWS_PER_CHUNK)
        chunk = F.expr(f"(cast(`{order_column}` as decimal(20,0)) - pmod(`{order_column}`, {unit}L)) div {unit}")
    elif isinstance(data_type, T.FractionalType):
        # NaN sorts after every number, so it goes into the last chunk.
        number = column.cast("double") / F.lit(float(width or ROWS_PER_CHUNK))
        chunk = (
            F.when(F.isnan(number) | (number >= 9e18), F.lit(2**63 - 1))
            .when(number <= -9e18, F.lit(_BEFORE_ALL + 1))
            .otherwise(F.floor(number).cast("bigint"))
        )
    elif isinstance(data_type, T.DateType):
        chunk = F.unix_date(column)
    elif isinstance(data_type, T.TimestampNTZType):
        days = F.unix_date(column.cast("date")).cast("bigint")
        seconds = days * 86400 + F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
        chunk = F.floor(seconds / F.lit(width or SECONDS_PER_CHUNK))
    elif isinstance(data_type, T.TimestampType):
        chunk = F.floor(F.unix_seconds(column) / F.lit(width or SECONDS_PER_CHUNK))
    else:
        raise ValueError(f"cannot cut chunks along a {data_type.simpleString()} column: '{order_column}'")
    return F.coalesce(chunk.cast("bigint"), F.lit(_BEFORE_ALL))
