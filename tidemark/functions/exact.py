"""Sums of doubles that do not depend on the order or grouping of their rows.

A double is a whole number of units of a power of two. Units are added as decimals per power, so nothing is rounded while
rows are summed, in whatever order and however often partial sums are summed again. Only the total of a group is rounded,
once, from its few powers in descending order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN, UNITS, ROWS, SUM = "__bin", "__units", "__rows", "__sum"

#: Powers are multiples of this, so that units fit a bigint and values of like size share a power.
STEP = 8
#: Bins of values that are no number of units; powers of doubles are far from them.
NAN, PLUS, MINUS = 10_000, 10_001, 10_002
INFINITY = float("inf")


def _scaled(value: Column, power: Column) -> Column:
    """``value`` times two to the ``power``, in two steps, as a single one may not be a double."""
    half = F.floor(power / 2)
    return value * F.pow(F.lit(2.0), half.cast("double")) * F.pow(F.lit(2.0), (power - half).cast("double"))


def bin_of(value: Column) -> Column:
    """The power of two whose multiples hold ``value`` exactly as a bigint; NULL for NULL.

    The logarithm may be off by one beside powers of two: 54 bits below it there is a bit to spare, and 62 bits above
    that power hold the units.
    """
    exponent = F.floor(F.log2(F.abs(value)))
    power = F.floor((exponent - 54) / STEP) * STEP
    return (
        F.when(value.isNull(), F.lit(None))
        .when(F.isnan(value), F.lit(NAN))
        .when(value == INFINITY, F.lit(PLUS))
        .when(value == -INFINITY, F.lit(MINUS))
        .when(value == 0.0, F.lit(0))
        .otherwise(power)
        .cast("int")
    )


def units_of(value: Column, power: Column) -> Column:
    """``value`` in units of its bin, 0 for what is no number."""
    some = F.when(power < NAN, _scaled(value, -power)).when(power >= NAN, F.lit(0.0))
    return some.cast("bigint").cast("decimal(28,0)")


def partial_sums(df: DataFrame, keys: Sequence[str | Column], value: Column) -> DataFrame:
    """Rows and units per key and bin; rows without a value have the bin NULL."""
    number = value.cast("double")
    with_bin = df.withColumn(BIN, bin_of(number)).withColumn(UNITS, units_of(number, F.col(BIN)))
    return with_bin.groupBy(*keys, BIN).agg(F.count("*").alias(ROWS), F.sum(UNITS).alias(UNITS))


def summed_again(partial: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return partial.groupBy(*keys, BIN).agg(F.sum(ROWS).alias(ROWS), F.sum(UNITS).cast("decimal(38,0)").alias(UNITS))


def totals(partial: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows and total per key of :func:`partial_sums` with one row per key and bin."""
    return partial.groupBy(*keys).agg(F.sum(ROWS).alias(ROWS), total(F.struct(BIN, UNITS)).alias(SUM))


def total(part: Column) -> Column:
    """Aggregate of structs (bin, units), one per bin: the double nearest to their exact sum, NULL without values.

    There are at most a few hundred bins, so the list of a group is short.
    """
    parts = F.collect_list(F.when(part[BIN].isNotNull(), part))
    numbers = F.sort_array(F.filter(parts, lambda p: p[BIN] < NAN), asc=False)

    def has(kind: int) -> Column:
        return F.exists(parts, lambda p: p[BIN] == kind)

    def added(so_far: Column, value: Column) -> Column:
        """The sum and its rounding error, kept beside it."""
        high = so_far["high"] + value
        moved = high - so_far["high"]
        error = (so_far["high"] - (high - moved)) + (value - moved)
        return F.struct(high.alias("high"), (so_far["low"] + error).alias("low"))

    def with_part(so_far: Column, p: Column) -> Column:
        # Units have more bits than a double: their upper and their lower part, each exact.
        span = F.lit(1 << 53).cast("decimal(16,0)")
        lower = p[UNITS] % span
        upper = ((p[UNITS] - lower) / span).cast("double")
        once = added(so_far, _scaled(upper, p[BIN] + 53))
        return added(once, _scaled(lower.cast("double"), p[BIN]))

    start = F.struct(F.lit(0.0).alias("high"), F.lit(0.0).alias("low"))
    finite = F.aggregate(
        numbers, start, with_part, lambda s: F.when(F.isnan(s["low"]), s["high"]).otherwise(s["high"] + s["low"])
    )
    return (
        F.when(F.size(parts) == 0, F.lit(None).cast("double"))
        .when(has(NAN) | (has(PLUS) & has(MINUS)), F.lit(float("nan")))
        .when(has(PLUS), F.lit(INFINITY))
        .when(has(MINUS), F.lit(-INFINITY))
        .otherwise(finite)
    )
