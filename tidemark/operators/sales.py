"""Totals, means and categories of sales rows, for one period or many."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exact import ROWS, SUM, partial_sums, summed_again, totals
from tidemark.functions.types import is_temporal

# Column names looked for, in order of preference.
DATE_COLUMNS = ("data", "date")
VALUE_COLUMNS = ("valor", "amount")
CATEGORY_COLUMN = "categoria"


@dataclass(frozen=True)
class SalesColumns:
    """Columns of a sales table by role; ``None`` means the table has no such column."""

    date: str | None = None
    value: str | None = None
    category: str | None = None

    @classmethod
    def of(cls, df: DataFrame) -> SalesColumns:
        def first(names: Sequence[str]) -> str | None:
            return next((n for n in names if n in df.columns), None)

        return cls(first(DATE_COLUMNS), first(VALUE_COLUMNS), first((CATEGORY_COLUMN,)))


def period_range(period: str) -> tuple[str, str] | None:
    """Half-open date range of ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD``; None for any other prefix."""
    if not re.fullmatch(r"\d{4}(-\d{2}(-\d{2})?)?", period):
        return None
    try:
        parts = [int(p) for p in period.split("-")]
        start = dt.date(*(parts + [1, 1])[:3])
        if len(parts) == 3:
            end = start + dt.timedelta(days=1)
        elif len(parts) == 2:
            end = dt.date(start.year + start.month // 12, start.month % 12 + 1, 1)
        else:
            end = dt.date(start.year + 1, 1, 1)
    except (ValueError, OverflowError):
        return None
    return start.isoformat(), end.isoformat()


def covering_range(period: str) -> tuple[str, str] | None:
    """Range of the day, month or year the prefix lies in, for prefixes such as ``1998-1``."""
    for length in (10, 7, 4):
        span = period_range(period[:length]) if len(period) >= length else None
        if span:
            return span
    return None


def period_condition(df: DataFrame, period: str, date_column: str) -> Column:
    """Rows whose date, written as text, starts with ``period``.

    On date and timestamp columns the year, month or day becomes a range, which reaches the file scan.
    """
    column = F.col(date_column)
    data_type = df.schema[date_column].dataType
    if not is_temporal(data_type):
        return column.cast("string").startswith(period)
    exact, around = period_range(period), covering_range(period)
    prefix = column.cast("string").startswith(period)
    if around is None:
        return prefix
    start, end = (F.lit(d).cast(data_type) for d in around)
    within = (column >= start) & (column < end)
    return within if exact else within & prefix


def filter_period(df: DataFrame, period: str, columns: SalesColumns | None = None) -> DataFrame:
    """Rows of one period; a table without a date column is returned whole."""
    columns = columns or SalesColumns.of(df)
    return df if columns.date is None else df.where(period_condition(df, period, columns.date))


class _Sums:
    """Row count and value sum per group, in stages that may follow each other any number of times.

    Whole numbers are added as decimals, which cannot overflow, and decimals as they are. Doubles, and text read as such, are
    added in units per bin, so that the total does not depend on the order of the rows; unreadable text counts as NULL.
    """

    def __init__(self, df: DataFrame, value: str | None) -> None:
        self.value = None
        self.exact = False
        if value is not None:
            data_type, column = df.schema[value].dataType, F.col(value)
            self.exact = isinstance(data_type, (T.DoubleType, T.FloatType, T.StringType))
            if isinstance(data_type, T.IntegralType):
                column = column.cast("decimal(20,0)")
            self.value = column.try_cast("double") if self.exact else column

    def first(self, df: DataFrame, *keys: str | Column) -> DataFrame:
        if self.exact:
            return partial_sums(df, keys, self.value)
        sums = [] if self.value is None else [F.sum(self.value).alias(SUM)]
        return df.groupBy(*keys).agg(F.count("*").alias(ROWS), *sums)

    def again(self, partial: DataFrame, *keys: str) -> DataFrame:
        if self.exact:
            return summed_again(partial, keys)
        sums = [] if self.value is None else [F.sum(SUM).alias(SUM)]
        return partial.groupBy(*keys).agg(F.sum(ROWS).alias(ROWS), *sums)

    def done(self, partial: DataFrame, *keys: str) -> DataFrame:
        """``__rows`` and ``__sum`` of partial sums with one row per key, or per key and bin."""
        if self.exact:
            return totals(partial, keys)
        if self.value is None:
            return partial
        data_type = partial.schema[SUM].dataType
        whole = isinstance(data_type, T.DecimalType) and data_type.scale == 0
        return partial.withColumn(SUM, F.col(SUM).cast("decimal(38,0)")) if whole else partial


def _total(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def _mean(total: Column, rows: Column) -> Column:
    """Total over all rows, those without a value included; 0.0 when there are none."""
    return F.when(rows > 0, total / rows).otherwise(F.lit(0.0))


def sales_totals(df: DataFrame, columns: SalesColumns | None = None) -> DataFrame:
    """``total_registros`` and, if there is a value column, ``total_vendas`` and ``media_vendas``. One row."""
    columns = columns or SalesColumns.of(df)
    sums = _Sums(df, columns.value)
    found = sums.done(sums.first(df))
    rows = F.coalesce(F.col(ROWS), F.lit(0)).cast("bigint")
    if columns.value is None:
        return found.select(rows.alias("total_registros"))
    total = _total(F.col(SUM))
    return found.select(
        rows.alias("total_registros"), total.alias("total_vendas"), _mean(total, rows).alias("media_vendas")
    )


def sales_by_category(df: DataFrame, columns: SalesColumns | None = None) -> DataFrame:
    """``quantidade`` and ``total`` per category; NULL is a category, without a value column the total is 0."""
    columns = columns or SalesColumns.of(df)
    if columns.category is None:
        raise ValueError("no category column")
    sums = _Sums(df, columns.value)
    found = sums.done(sums.first(df, columns.category), columns.category)
    return found.select(columns.category, *_category_figures(columns))


def _scan_condition(df: DataFrame, periods: Sequence[str], date_column: str) -> Column | None:
    """Filter for the scan that keeps every row of any of the periods; None when it cannot be stated."""
    data_type = df.schema[date_column].dataType
    if not is_temporal(data_type):
        return _text_condition(F.col(date_column).cast("string"), _outermost(periods))
    else:
        spans = [covering_range(p) for p in periods]
        if any(s is None for s in spans):
            return None
        merged: list[list[str]] = []
        for start, end in sorted(spans):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        column = F.col(date_column)
        wanted = [
            (column >= F.lit(start).cast(data_type)) & (column < F.lit(end).cast(data_type))
            for start, end in merged
        ]
    return _any_of(wanted)


def _any_of(conditions: Sequence[Column]) -> Column:
    """A balanced OR, so that any number of conditions stays shallow."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any_of(conditions[:half]) | _any_of(conditions[half:])


def _text_condition(column: Column, prefixes: Sequence[str]) -> Column | None:
    """Rows that start with any prefix: one ``IN`` per length, and bounds of the text that reach the scan."""
    if not all(prefixes):
        return None
    lengths = sorted({len(p) for p in prefixes})
    listed = [F.substring(column, 1, n).isin(*[p for p in prefixes if len(p) == n]) for n in lengths]
    condition = _any_of(listed) & (column >= min(prefixes))
    # The first text after all that start with the last prefix.
    last = max(prefixes, key=lambda p: p.encode("utf-8"))
    if ord(last[-1]) < 0xD7FF:
        condition &= column < last[:-1] + chr(ord(last[-1]) + 1)
    return condition


def _outermost(periods: Sequence[str]) -> list[str]:
    """Periods not contained in another one."""
    kept: list[str] = []
    for p in sorted(set(periods)):
        if not kept or not p.startswith(kept[-1]):
            kept.append(p)
    return kept


def _with_periods(df: DataFrame, text: Column, periods: Sequence[str]) -> DataFrame:
    """Each row once per period its date text starts with.

    A prefix match becomes an equality match: the text is cut to every length that occurs among the periods.
    """
    lengths = sorted({len(p) for p in periods})
    prefixes = F.array_distinct(F.array(*[F.substring(text, 1, n) for n in lengths]))
    return df.withColumn("periodo", F.explode(prefixes)).where(F.col("periodo").isin(sorted(set(periods))))


def _each_period(periods: Sequence[str]) -> Column:
    return F.explode(F.array(*[F.lit(p) for p in sorted(set(periods))]))


def rows_by_period(
    df: DataFrame, periods: Sequence[str], columns: SalesColumns | None = None
) -> DataFrame:
    """Rows of every period with a leading column ``periodo``; nested periods repeat a row."""
    _check(periods)
    columns = columns or SalesColumns.of(df)
    if columns.date is None:
        return df.select(_each_period(periods).alias("periodo"), *df.columns)
    condition = _scan_condition(df, periods, columns.date)
    scanned = df if condition is None else df.where(condition)
    matched = _with_periods(scanned, F.col(columns.date).cast("string"), periods)
    return matched.select("periodo", *df.columns)


def _partials(
    df: DataFrame, periods: Sequence[str], columns: SalesColumns, extra: Sequence[str]
) -> tuple[_Sums, DataFrame]:
    """How to add on, and partial sums per period, and per ``extra`` column.

    The table is aggregated once at the finest date prefix in use. Only that small result meets the periods,
    however many there are and however they nest.
    """
    sums = _Sums(df, columns.value)
    if columns.date is None:
        return sums, sums.first(df, *extra).withColumn("periodo", _each_period(periods))
    condition = _scan_condition(df, periods, columns.date)
    scanned = df if condition is None else df.where(condition)
    column, longest = F.col(columns.date), max(len(p) for p in periods)
    if is_temporal(df.schema[columns.date].dataType) and longest <= 10:
        finest = column.cast("date")
    else:
        finest = F.substring(column.cast("string"), 1, longest)
    by_prefix = sums.first(scanned, finest.alias("__prefix"), *extra)
    matched = _with_periods(by_prefix, F.col("__prefix").cast("string"), periods)
    return sums, sums.again(matched, "periodo", *extra)


def _totals_of(found: DataFrame, periods: Sequence[str], columns: SalesColumns) -> DataFrame:
    wanted = found.sparkSession.range(1).select(_each_period(periods).alias("periodo"))
    all_periods = wanted.join(found, on="periodo", how="left")
    rows = F.coalesce(F.col(ROWS), F.lit(0)).cast("bigint")
    result = [F.col("periodo"), rows.alias("total_registros")]
    if columns.value is not None:
        total = _total(F.col(SUM))
        result += [total.alias("total_vendas"), _mean(total, rows).alias("media_vendas")]
    return all_periods.select(*result)


def _categories_of(found: DataFrame, columns: SalesColumns) -> DataFrame:
    return found.select("periodo", columns.category, *_category_figures(columns))


def _category_figures(columns: SalesColumns) -> list[Column]:
    total = F.lit(0).cast("bigint") if columns.value is None else F.col(SUM)
    return [F.col(ROWS).cast("bigint").alias("quantidade"), total.alias("total")]


def sales_by_period(
    df: DataFrame, periods: Sequence[str], columns: SalesColumns | None = None
) -> DataFrame:
    """:func:`sales_totals` for every period in one pass; a period without rows reports 0 and 0.0."""
    _check(periods)
    columns = columns or SalesColumns.of(df)
    sums, found = _partials(df, periods, columns, ())
    return _totals_of(sums.done(found, "periodo"), periods, columns)


def sales_by_period_and_category(
    df: DataFrame, periods: Sequence[str], columns: SalesColumns | None = None
) -> DataFrame:
    """:func:`sales_by_category` for every period in one pass."""
    _check(periods)
    columns = columns or SalesColumns.of(df)
    if columns.category is None:
        raise ValueError("no category column")
    sums, found = _partials(df, periods, columns, (columns.category,))
    return _categories_of(sums.done(found, "periodo", columns.category), columns)


def analyse_periods(
    df: DataFrame, periods: Sequence[str], columns: SalesColumns | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Totals per period and, with a category column, totals per period and category, from the same aggregation."""
    _check(periods)
    columns = columns or SalesColumns.of(df)
    if columns.category is None:
        return sales_by_period(df, periods, columns), None
    sums, found = _partials(df, periods, columns, (columns.category,))
    whole = sums.done(sums.again(found, "periodo"), "periodo")
    by_category = sums.done(found, "periodo", columns.category)
    return _totals_of(whole, periods, columns), _categories_of(by_category, columns)


def _check(periods: Sequence[str]) -> None:
    if not periods:
        raise ValueError("give at least one period")
