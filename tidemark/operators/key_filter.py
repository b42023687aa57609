"""A Bloom filter of keys as a small table, to leave rows without a partner behind before they are shuffled.

Every key belongs to one block of the filter and sets a few bits in it. The filter is an ordinary aggregation: bits are
combined per word in each task before anything is shuffled. Its blocks are broadcast and joined by block number; a row
stays if all bits of its key are set. No row with a partner is lost, some without one stay.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK, WORDS = "__block", "__words"
#: Words of 64 bits in a block: with 4096 bits a block, 12 bits of a hash choose one.
BLOCK_WORDS = 64
BIT_HASH = 12

#: Types whose equal values have equal hashes.
HASHED_ALIKE = (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType, T.BinaryType)


@dataclass(frozen=True)
class KeyFilter:
    """How large a filter may be. With 12 bits a key and 4 hashes about 1 row of 200 without a partner stays."""

    bits_per_key: int = 12
    hashes: int = 4
    most_bytes: int = 64 << 20

    def blocks(self, keys: int) -> int:
        return max(1, math.ceil(keys * self.bits_per_key / (64 * BLOCK_WORDS)))

    def fits(self, keys: int) -> bool:
        """Would a filter of so many keys stay within the size that may be broadcast?"""
        return self.blocks(keys) * 8 * BLOCK_WORDS <= self.most_bytes


def filter_columns(left: DataFrame, right: DataFrame, on: Sequence[str]) -> dict[str, str]:
    """Key columns that both sides hash alike, with the type to hash them in; others take no part in the filter."""
    found = {}
    for name in on:
        a, b = left.schema[name].dataType, right.schema[name].dataType
        if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
            found[name] = "bigint"
        elif a == b and isinstance(a, HASHED_ALIKE):
            found[name] = a.simpleString()
    return found


def _hash(columns: dict[str, str], seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(f"`{n}`").cast(t) for n, t in columns.items()])


def _bits(columns: dict[str, str], hashes: int) -> list[Column]:
    """Numbers of the bits of a key in its block."""
    drawn = _hash(columns, 2)
    return [F.shiftrightunsigned(drawn, BIT_HASH * i).bitwiseAND(F.lit((1 << BIT_HASH) - 1)).cast("int") for i in range(hashes)]


def build(keys: DataFrame, columns: dict[str, str], blocks: int, shape: KeyFilter = KeyFilter()) -> DataFrame:
    """The filter: ``__block`` and its ``__words``, an array of bigints. Repeated keys change nothing."""
    if not 0 < shape.hashes <= 64 // BIT_HASH:
        raise ValueError(f"between 1 and {64 // BIT_HASH} hashes fit one draw")
    block = F.pmod(_hash(columns, 1), F.lit(blocks)).alias(BLOCK)
    bits = keys.select(block, F.explode(F.array(*_bits(columns, shape.hashes))).alias("__bit"))
    word = F.floor(F.col("__bit") / 64).cast("int").alias("__word")
    set_bit = F.expr("shiftleft(1L, __bit % 64)")
    words = bits.groupBy(BLOCK, word).agg(F.bit_or(set_bit).alias("__set"))
    by_word = F.map_from_entries(F.collect_list(F.struct("__word", "__set")))  # at most BLOCK_WORDS entries
    places = F.sequence(F.lit(0), F.lit(BLOCK_WORDS - 1))
    return (
        words.groupBy(BLOCK)
        .agg(by_word.alias("__by_word"))
        .select(BLOCK, F.transform(places, lambda i: F.coalesce(F.try_element_at("__by_word", i), F.lit(0))).alias(WORDS))
    )


def pruned(rows: DataFrame, keys_filter: DataFrame, columns: dict[str, str], blocks: int, shape: KeyFilter) -> DataFrame:
    """``rows`` without those whose key is in no block of the filter; call it only for a filter that :meth:`KeyFilter.fits`."""
    block = F.pmod(_hash(columns, 1), F.lit(blocks))
    near = rows.withColumn(BLOCK, block).join(F.broadcast(keys_filter), on=BLOCK, how="inner")

    def is_set(bit: Column) -> Column:
        word = F.get(F.col(WORDS), F.floor(bit / 64).cast("int"))
        return F.getbit(word, bit % 64) == 1

    for bit in _bits(columns, shape.hashes):
        near = near.where(is_set(bit))
    return near.select(*[f"`{c}`" for c in rows.columns])
