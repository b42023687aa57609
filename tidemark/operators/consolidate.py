"""Consolidation of two origins of operation events into one winning row per operation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.types import field_type, to_event_time, to_rank_number
from tidemark.operators.key_filter import KeyFilter, build, filter_columns, pruned
from tidemark.operators.ranking import rank_value, top_per_key
from tidemark.sources.spec import Source, materialize
from tidemark.sources.tables import scratch_path

_FROM_A = "__from_a"


@dataclass(frozen=True)
class PositionRule:
    """Column names and the ranking of one consolidation.

    Between origins the later value date wins, then the higher priority, then the later receipt, then the
    preferred origin. ``tie_breakers`` (higher wins) settle what is still equal; without them a full tie is
    settled arbitrarily. The version takes no part in the choice, it only finds the full record afterwards.
    """

    # Default column names of operation events.
    key: str = "num_oper"
    version: str = "cod_idef_vers_oper"
    event_code: str = "cod_idef_even_prcs"
    value_time: str = "dat_vlr_even_oper"
    priority: str = "num_prio_even_oper"
    receipt_time: str = "dat_recm_even_oper"
    origin: str = "origem_registro"
    preferred_origin: str = "ONLINE"

    # What a NULL counts as, and is replaced by, when nulls_as_minimum is on.
    nulls_as_minimum: bool = True
    minimum_time: str = "1900-01-01 00:00:00"
    minimum_priority: int = 1

    # Order that picks the latest row inside one origin; None means receipt, value date, priority.
    latest_order: tuple[str, ...] | None = None
    reduce_each_side: bool = True
    tie_breakers: tuple[str, ...] = ()
    timestamp_type: str = "timestamp"

    @property
    def receipt_first(self) -> tuple[str, ...]:
        return (self.receipt_time, self.value_time, self.priority)

    @property
    def value_first(self) -> tuple[str, ...]:
        return (self.value_time, self.priority, self.receipt_time)

    @property
    def side_order(self) -> tuple[str, ...]:
        return tuple(self.latest_order or self.receipt_first)

    @property
    def empty_schema(self) -> str:
        t = self.timestamp_type
        return (
            f"`{self.key}` bigint, `{self.version}` bigint, `{self.value_time}` {t}, "
            f"`{self.priority}` bigint, `{self.receipt_time}` {t}"
        )


def normalize_types(df: DataFrame, rule: PositionRule = PositionRule()) -> DataFrame:
    """Dates to timestamps and priority to bigint; unreadable values become NULL."""
    priority_type = field_type(df, rule.priority)
    for name in (rule.value_time, rule.receipt_time):
        field_type(df, name)
    return df.withColumns(
        {
            rule.value_time: to_event_time(F.col(rule.value_time), rule.timestamp_type),
            rule.receipt_time: to_event_time(F.col(rule.receipt_time), rule.timestamp_type),
            rule.priority: to_rank_number(F.col(rule.priority), priority_type),
        }
    )


def nulls_to_minimum(df: DataFrame, rule: PositionRule = PositionRule()) -> DataFrame:
    """Replace NULL dates and priorities by the rule's minimum; the replacement stays in the result."""
    if not rule.nulls_as_minimum:
        return df
    earliest = F.lit(rule.minimum_time).cast(rule.timestamp_type)
    return df.withColumns(
        {
            rule.value_time: F.coalesce(F.col(rule.value_time), earliest),
            rule.receipt_time: F.coalesce(F.col(rule.receipt_time), earliest),
            rule.priority: F.coalesce(
                F.col(rule.priority), F.lit(rule.minimum_priority).cast("bigint")
            ),
        }
    )


def tag_origin(df: DataFrame, name: str, rule: PositionRule = PositionRule()) -> DataFrame:
    return df.withColumn(rule.origin, F.lit(name))


def prefers(rule: PositionRule, origin: Column) -> Column:
    """1 for the preferred origin, else 0."""
    return F.when(origin == F.lit(rule.preferred_origin), F.lit(1)).otherwise(F.lit(0))


def latest_per_origin(df: DataFrame, rule: PositionRule = PositionRule()) -> DataFrame:
    """Latest row per operation inside one origin, by ``rule.side_order``."""
    return top_per_key(df, [rule.key], [*rule.side_order, *rule.tie_breakers])


def winner_per_operation(df: DataFrame, rule: PositionRule = PositionRule()) -> DataFrame:
    """Winning row per operation over all origins present in ``df``."""
    order = [*rule.value_first, prefers(rule, F.col(rule.origin)), *rule.tie_breakers]
    return top_per_key(df, [rule.key], order)


def consolidate(
    spark: SparkSession,
    origin_a: Source,
    origin_b: Source,
    rule: PositionRule = PositionRule(),
    name_a: str = "ONLINE",
    name_b: str = "BATCH",
    return_columns: Sequence[str] | None = None,
) -> DataFrame:
    """One winning row per operation, with the origin it came from.

    Each side is first reduced to its latest row (unless ``reduce_each_side`` is off), then the sides compete.
    Both steps happen in one aggregation with one shuffle.
    """
    sides = []
    for source, name, is_a in ((origin_a, name_a, True), (origin_b, name_b, False)):
        side = materialize(spark, source, empty_schema=rule.empty_schema)
        side = tag_origin(nulls_to_minimum(normalize_types(side, rule), rule), name, rule)
        sides.append(side.withColumn(_FROM_A, F.lit(is_a)))
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    if return_columns and set(return_columns) <= set(both.columns):
        # The aggregation carries whole rows; what is not returned must be left out before it.
        needed = {rule.key, rule.origin, _FROM_A, *rule.value_first, *rule.side_order, *rule.tie_breakers}
        both = both.select(*[f"`{n}`" for n in both.columns if n in needed or n in return_columns])

    # When the latest row of a side is chosen by the winner's own order, the best row overall is also the best
    # row of its side, and the reduction changes nothing.
    if rule.reduce_each_side and rule.side_order != rule.value_first:
        winners = _latest_then_winner(both, rule)
    else:
        winners = winner_per_operation(both.drop(_FROM_A), rule)
    if return_columns:
        winners = select_return_columns(winners, return_columns, rule)
    return winners


def _latest_then_winner(both: DataFrame, rule: PositionRule) -> DataFrame:
    """The latest row of side A and of side B per operation, next to each other, then the better of the two."""
    columns = [c for c in both.columns if c != _FROM_A]
    row = F.struct(*[F.col(f"`{c}`") for c in columns if c != rule.key])
    latest = rank_value([*rule.side_order, *rule.tie_breakers])
    sides = both.groupBy(rule.key).agg(
        F.max_by(row, F.when(F.col(_FROM_A), latest)).alias("__a"),
        F.max_by(row, F.when(~F.col(_FROM_A), latest)).alias("__b"),
    )

    def rank(best: Column) -> Column:
        return rank_value(
            [
                *[best[c] for c in rule.value_first],
                prefers(rule, best[rule.origin]),
                *[best[c] for c in rule.tie_breakers],
            ]
        )

    a, b = F.col("__a"), F.col("__b")
    b_wins = a.isNull() | (b.isNotNull() & (rank(b) > rank(a)))
    return (
        sides.select(rule.key, F.when(b_wins, b).otherwise(a).alias("__winner"))
        .select(rule.key, "__winner.*")
        .select(*[F.col(f"`{c}`") for c in columns])
    )


def select_return_columns(
    winners: DataFrame, columns: Sequence[str], rule: PositionRule = PositionRule()
) -> DataFrame:
    """Chosen columns; the origin is appended when it is not among them."""
    extra = [] if rule.origin in columns else [rule.origin]
    return winners.select(*columns, *extra)


def winners_of(winners: DataFrame, name: str, rule: PositionRule = PositionRule()) -> DataFrame:
    return winners.where(F.col(rule.origin) == F.lit(name))


def rehydrate(
    winners: DataFrame,
    full_a: DataFrame,
    full_b: DataFrame,
    rule: PositionRule = PositionRule(),
    name_a: str = "ONLINE",
    name_b: str = "BATCH",
    prune: KeyFilter | None = None,
) -> DataFrame:
    """Full record of every winner from its own side, by operation and version.

    The full tables are tagged and unioned first, so the winners are computed and joined once instead of once
    per side. A winner without a full record disappears; several full records give several rows. Columns of the
    winners that neither full table has are kept, after those of the full record; consolidate with only the wanted
    ones as ``return_columns``.

    The full tables are mostly rows of no winner, all of which a sort-merge join shuffles. With ``prune`` the winners are
    written to the scratch folder and counted there, and a Bloom filter of their keys leaves such rows behind at the scan.
    Where the filter would be larger than ``prune`` allows, the join is the plain one.
    """
    keys = [rule.key, rule.version, rule.origin]
    full = tag_origin(full_a, name_a, rule).unionByName(
        tag_origin(full_b, name_b, rule), allowMissingColumns=True
    )
    known = {c.lower() for c in full.columns}
    own = [c for c in winners.columns if c.lower() not in known]
    rest = [c for c in full.columns if c.lower() not in {k.lower() for k in keys}]
    winners = winners.select(*keys, *[f"`{c}`" for c in own])
    if prune is not None:
        winners, full = _pruned(winners, full, keys, prune)
    joined = winners.join(full, on=keys, how="inner")
    return joined.select(*[f"`{c}`" for c in [*keys, *rest, *own]])


def _pruned(winners: DataFrame, full: DataFrame, keys: list[str], prune: KeyFilter) -> tuple[DataFrame, DataFrame]:
    """The written winners, and the full rows that may belong to one."""
    path = scratch_path(winners.sparkSession, "winners")
    winners.write.parquet(path)
    winners = winners.sparkSession.read.schema(winners.schema).parquet(path)
    columns, count = filter_columns(winners, full, keys), winners.count()
    if not columns or not prune.fits(count):
        return winners, full
    blocks = prune.blocks(count)
    return winners, pruned(full, build(winners, columns, blocks, prune), columns, blocks, prune)


def summarize(
    winners: DataFrame, name_a: str = "ONLINE", name_b: str = "BATCH"
) -> DataFrame:
    """Winner count and the names of the two origins, one row."""
    return winners.agg(F.count("*").alias("total_vencedores")).select(
        "total_vencedores",
        F.lit(name_a).alias("origem_a"),
        F.lit(name_b).alias("origem_b"),
        F.lit("sucesso").alias("status"),
    )
