"""Working sets from a ready frame, a list of frames, or a declarative table-and-join specification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Union

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class JoinSpec:
    """One equi-join step: ``on`` holds (left column, right column) pairs, any number of them.

    Adaptive execution splits hot keys of inner joins on both sides, but of an outer join only on the side whose
    rows are all kept, and of a full join on neither. ``skewed`` asks for an outer join put together from an
    inner join and anti-joins against distinct keys, which splits everywhere and reads the sources twice.
    """

    left_alias: str
    right_alias: str
    how: str = "inner"
    on: Sequence[tuple[str, str]] = ()
    rename_collisions: bool = True
    collision_prefix: str | None = None
    skewed: bool = False


@dataclass(frozen=True)
class SourceSpec:
    """Tables by alias (``"db.table"`` or a frame), joins in order, then a filter, then a projection."""

    tables: Mapping[str, Union[str, DataFrame]]
    joins: Sequence[JoinSpec] = ()
    select_columns: Sequence[str] | None = None
    where: str | None = None


Source = Union[DataFrame, Sequence[DataFrame], SourceSpec]


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing on one side is NULL there, duplicates stay."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def materialize(
    spark: SparkSession, source: Source, empty_schema: str | None = None
) -> DataFrame:
    """One frame from any accepted source. An empty list needs ``empty_schema``."""
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, SourceSpec):
        return build_source(spark, source)
    if isinstance(source, (list, tuple)):
        if source:
            return union_all(source)
        if empty_schema is None:
            raise ValueError("an empty list of frames needs a schema")
        fields = T.StructType.fromDDL(empty_schema).fields
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    raise ValueError(f"unsupported source: {type(source).__name__}")


def build_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Joins, filter and projection of a spec as one lazy plan; Catalyst pushes the filter down.

    Filter and projection may qualify a column by its alias, as long as the column was not renamed.
    """
    tables = {
        alias: (spark.table(source) if isinstance(source, str) else source).alias(alias)
        for alias, source in spec.tables.items()
    }
    if spec.joins:
        df = _table(tables, spec.joins[0].left_alias)
        for step in spec.joins:
            df = _join(df, _table(tables, step.right_alias), step)
    elif len(tables) == 1:
        (df,) = tables.values()
    else:
        raise ValueError("a spec without joins must name exactly one table")
    if spec.where:
        df = df.where(spec.where)
    if spec.select_columns:
        df = df.select(*spec.select_columns)
    return df


def _table(tables: Mapping[str, DataFrame], alias: str) -> DataFrame:
    if alias not in tables:
        raise ValueError(f"join names unknown alias '{alias}'; known: {sorted(tables)}")
    return tables[alias]


def _join(left: DataFrame, right: DataFrame, step: JoinSpec) -> DataFrame:
    if not step.on:
        raise ValueError(f"join with '{step.right_alias}' has no key pairs; cross joins are not offered")
    keys = [left_key for left_key, _ in step.on]
    right_keys = [right_key for _, right_key in step.on]
    if len(set(keys)) < len(keys) or len(set(right_keys)) < len(right_keys):
        raise ValueError(f"a key column is paired twice in the join with '{step.right_alias}'")
    renames = {r: l for l, r in step.on if l != r}
    for new_name in renames.values():
        if new_name in right.columns and new_name not in renames:
            raise ValueError(
                f"'{step.right_alias}' already has a column '{new_name}'; rename or drop it before the join"
            )
    right = right.withColumnsRenamed(renames)
    if step.rename_collisions:
        prefix = step.collision_prefix or f"{step.right_alias}__"
        shared = [c for c in right.columns if c in set(left.columns) and c not in keys]
        right = right.withColumnsRenamed({c: f"{prefix}{c}" for c in shared})
    if step.skewed:
        return _outer_by_parts(left, right, keys, step.how)
    return left.join(right, on=keys, how=step.how)


# Spark's names of the outer joins, and which sides they keep whole.
_KEEPS_LEFT = {"left", "leftouter", "left_outer", "full", "outer", "fullouter", "full_outer"}
_KEEPS_RIGHT = {"right", "rightouter", "right_outer", "full", "outer", "fullouter", "full_outer"}


def _outer_by_parts(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    how = how.lower()
    if how not in _KEEPS_LEFT | _KEEPS_RIGHT:
        return left.join(right, on=keys, how=how)
    matched = left.join(right, on=keys, how="inner")
    parts = [matched]
    if how in _KEEPS_LEFT:
        parts.append(left.join(right.select(*keys).distinct(), on=keys, how="left_anti"))
    if how in _KEEPS_RIGHT:
        parts.append(right.join(left.select(*keys).distinct(), on=keys, how="left_anti"))
    return union_all(parts)
