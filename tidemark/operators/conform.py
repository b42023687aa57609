"""Projection and casts that make a frame fit a target table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import gathered, target_fields


# Whole types from narrow to wide, with the decimal digits that hold all their values.
WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
# Digits of the whole numbers that these types hold exactly.
FLOAT_DIGITS = {T.FloatType: 7, T.DoubleType: 15}
MOST_DIGITS = 38


def _key(spark: SparkSession, name: str) -> str:
    """What Spark compares of a name: case counts only if it is set to."""
    return name if spark.conf.get("spark.sql.caseSensitive") == "true" else name.lower()


def _sources(df: DataFrame, target: Sequence[T.StructField]) -> dict[str, str]:
    """Target column to source column, found the way Spark resolves names."""
    spark = df.sparkSession
    present = {_key(spark, c): c for c in df.columns}
    return {f.name: present[_key(spark, f.name)] for f in target if _key(spark, f.name) in present}


def _wider_number(a: T.DataType, b: T.DataType) -> T.DataType | None:
    kinds = {type(a), type(b)}
    if kinds <= WHOLE_DIGITS.keys():
        return max(a, b, key=lambda t: WHOLE_DIGITS[type(t)])
    if kinds <= FLOAT_DIGITS.keys():
        return T.DoubleType()
    if kinds & FLOAT_DIGITS.keys():
        floating, other = (a, b) if type(a) in FLOAT_DIGITS else (b, a)
        digits = WHOLE_DIGITS.get(type(other), MOST_DIGITS)
        holds = [t for t, most in FLOAT_DIGITS.items() if digits <= most and most >= FLOAT_DIGITS[type(floating)]]
        return holds[0]() if holds else None
    parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (WHOLE_DIGITS[type(t)], 0) for t in (a, b)]
    before, after = (max(p) for p in zip(*parts))
    return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else None


def widened(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both without loss; None if there is no such type.

    Struct fields are matched by name, those of one side only are kept, ``a``'s first. Text holds only text: that values can be
    written as text is the business of a cast.
    """
    if isinstance(a, T.NullType) or a == b:
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        others, fields = {f.name: f for f in b.fields}, []
        for field in a.fields:
            other = others.pop(field.name, field)
            kind = widened(field.dataType, other.dataType)
            if kind is None:
                return None
            fields.append(T.StructField(field.name, kind))
        return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in others.values()])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        kind = widened(a.elementType, b.elementType)
        return None if kind is None else T.ArrayType(kind)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = widened(a.keyType, b.keyType), widened(a.valueType, b.valueType)
        return None if key is None or value is None else T.MapType(key, value)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return _wider_number(a, b)
    times = {T.DateType, T.TimestampType}, {T.DateType, T.TimestampNTZType}
    if {type(a), type(b)} in times:
        return b if isinstance(a, T.DateType) else a
    return None


@dataclass(frozen=True)
class Drift:
    """How a source differs from a target: columns only the source has, columns only the target has, and for columns of both
    whose values the target's type cannot all hold, the type that could (None: no type)."""

    new: tuple[T.StructField, ...]
    missing: tuple[str, ...]
    narrow: dict[str, T.DataType | None]


def schema_drift(df: DataFrame, target: Sequence[T.StructField]) -> Drift:
    """The :class:`Drift` of ``df`` against the target's fields; from schemas alone, no data is read.

    Text on either side always fits: text is parsed (:func:`lost_values` counts what does not parse), and every value
    can be written as text. A column without a type, all NULL, is not new.
    """
    spark, sources = df.sparkSession, _sources(df, target)
    known = {_key(spark, f.name) for f in target}
    new = [
        T.StructField(f.name, f.dataType)
        for f in df.schema.fields
        if _key(spark, f.name) not in known and not isinstance(f.dataType, T.NullType)
    ]
    narrow = {}
    for field in (f for f in target if f.name in sources):
        given = df.schema[sources[field.name]].dataType
        if isinstance(given, T.StringType) or isinstance(field.dataType, T.StringType):
            continue
        wider = widened(field.dataType, given)
        if wider is None or wider.simpleString() != field.dataType.simpleString():
            narrow[field.name] = wider
    return Drift(tuple(new), tuple(f.name for f in target if f.name not in sources), narrow)


def conform(df: DataFrame, target: Sequence[T.StructField]) -> DataFrame:
    """Exactly the target's columns and types.

    Columns outside the target are dropped, missing ones become typed NULLs, a value that cannot be cast
    becomes NULL (:func:`lost_values` counts those).
    """
    sources = _sources(df, target)
    return df.select(
        *[
            (
                F.col(f"`{sources[f.name]}`").try_cast(f.dataType)
                if f.name in sources
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in target
        ]
    )


def lost_values(df: DataFrame, target: Sequence[T.StructField]) -> DataFrame:
    """Per target column present in ``df``: how many values :func:`conform` turns into NULL. One row."""
    sources = _sources(df, target)
    if not sources:
        raise ValueError("no column in common with the target")

    def lost(field: T.StructField) -> Column:
        column = F.col(f"`{sources[field.name]}`")
        return F.count_if(column.isNotNull() & column.try_cast(field.dataType).isNull())

    return df.agg(*[lost(f).alias(f.name) for f in target if f.name in sources])


def _refuse_narrow(name: str, drift: Drift) -> None:
    """The list of what does not fit, before anything is changed: a catalog table cannot change the type of a column."""
    if drift.narrow:
        wanted = ", ".join(f"{c} ({'no common type' if t is None else t.simpleString()})" for c, t in drift.narrow.items())
        raise ValueError(f"{name} has columns too narrow for the source, with the type that holds both: {wanted}")


def conform_and_write(
    spark: SparkSession,
    df: DataFrame,
    database: str,
    table: str,
    mode: str = "append",
    extra_fields: Sequence[T.StructField] = (),
    evolve: bool = False,
) -> Drift:
    """Write ``df`` to a catalog table in the table's own columns, types and partitions; how the two differed before.

    ``extra_fields`` are added to the table first, so that columns new at the source can be registered; with ``evolve`` all
    columns new at the source are, and columns whose type cannot hold the source's values are refused in one list
    before anything is changed. Without it such values become NULL. Only partitions present in ``df`` are touched by
    ``mode="overwrite"``, whatever the session is set to, so writers in other threads are not affected; a table without
    partitions is replaced.
    """
    name = f"`{database}`.`{table}`"
    known = spark.table(name).schema.fields
    drift = schema_drift(df, known)
    if evolve:
        _refuse_narrow(name, drift)
    wanted = {_key(spark, f.name): f for f in (*(drift.new if evolve else ()), *extra_fields)}
    new = [f for key, f in wanted.items() if key not in {_key(spark, k.name) for k in known}]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    fields, partitions = target_fields(spark, database, table)
    into = "OVERWRITE" if mode == "overwrite" else "INTO"
    spark.sql(
        f"INSERT {into} {name} WITH ('partitionOverwriteMode' = 'dynamic') SELECT * FROM {{rows}}",
        rows=gathered(conform(df, fields), partitions),
    )
    return drift
