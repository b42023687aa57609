"""Packing of documents into sequences by a grouping genetic algorithm on islands.

A solution is a list of bins. Crossover injects whole well-filled bins of one parent into the other, removes the bins
that hold a document twice and best-fits the displaced documents; mutation empties a few poor bins. The fitness is the
mean of squared fills, which prefers full bins to evenly filled ones.

Documents are dealt into shards of bounded size. Several islands, each a task of its own, evolve populations for each
shard; after each epoch the elite of an island moves to the next one. A shard whose best solution has no more bins than
its tokens need is solved and evolves no further. Poorly filled bins of all shards are then dealt and packed again.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored, text_batches
from .tokens import encoder

Bins = list[list[int]]


@dataclass(frozen=True)
class Search:
    """How hard to search: islands and epochs per shard, individuals and generations per island."""

    shard_items: int = 1024
    islands: int = 2
    epochs: int = 2
    population: int = 4
    generations: int = 6
    rounds: int = 4
    full: float = 0.995


def best_fit(items: list[int], lengths: list[int], capacity: int, bins: Bins) -> Bins:
    """``bins`` with the items added, longest first, each to the bin that it leaves the least room in."""
    out = [list(b) for b in bins]
    rooms = sorted((capacity - sum(lengths[i] for i in b), k) for k, b in enumerate(out))
    for item in sorted(items, key=lambda i: (-lengths[i], i)):
        length = lengths[item]
        at = bisect_left(rooms, (length, -1))
        if at == len(rooms):
            out.append([item])
            insort(rooms, (capacity - length, len(out) - 1))
        else:
            room, k = rooms.pop(at)
            out[k].append(item)
            insort(rooms, (room - length, k))
    return out


def fitness(bins: Bins, lengths: list[int], capacity: int) -> float:
    return sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins))


def crossover(mother: Bins, father: Bins, lengths: list[int], capacity: int, draw: np.random.Generator) -> Bins:
    """Some of the father's fullest bins, whole, and what is left of the mother's; displaced documents best-fitted."""
    by_fill = sorted(range(len(father)), key=lambda k: -sum(lengths[i] for i in father[k]))
    best = by_fill[: max(1, len(by_fill) // 2)]
    count = int(draw.integers(1, len(best) + 1))
    injected = [father[best[k]] for k in draw.permutation(len(best))[:count]]
    taken = {i for b in injected for i in b}
    kept = [b for b in mother if not taken.intersection(b)]
    displaced = [i for b in mother if taken.intersection(b) for i in b if i not in taken]
    return best_fit(displaced, lengths, capacity, injected + kept)


def mutated(bins: Bins, lengths: list[int], capacity: int, draw: np.random.Generator) -> Bins:
    """The emptiest bins and a few others emptied and their documents best-fitted again."""
    by_fill = sorted(range(len(bins)), key=lambda k: sum(lengths[i] for i in bins[k]))
    count = min(len(bins), 2 + len(bins) // 20)
    gone = set(by_fill[:count]) | set(draw.integers(0, len(bins), count).tolist())
    loose = [i for k in gone for i in bins[k]]
    return best_fit(loose, lengths, capacity, [b for k, b in enumerate(bins) if k not in gone])


def least_bins(lengths: list[int], capacity: int) -> int:
    return -(-sum(lengths) // capacity)


def evolve(lengths: list[int], capacity: int, start: list[Bins], search: Search, seed: int) -> list[Bins]:
    """A population, best first, evolved from the given solutions; it ends early at the least possible number of bins."""
    draw = np.random.default_rng(seed)
    everything = list(range(len(lengths)))
    people = list(start) or [best_fit(everything, lengths, capacity, [])]
    least = least_bins(lengths, capacity)

    def ranked(some: list[Bins]) -> list[Bins]:
        return sorted(some, key=lambda b: (len(b), -fitness(b, lengths, capacity)))[: search.population]

    while len(people) < search.population and len(people[0]) > least:
        loose = draw.permutation(len(lengths)).tolist()
        cut = len(loose) // 4
        first = [[i] for i in loose[: max(1, min(cut, least // 2))]]
        rest = loose[len(first) :]
        people.append(best_fit(rest, lengths, capacity, first))
    people = ranked(people)
    for _ in range(search.generations):
        if len(people[0]) <= least:
            break
        children = []
        for k in range(search.population):
            a, b = people[k % len(people)], people[int(draw.integers(0, len(people)))]
            child = crossover(a, b, lengths, capacity, draw)
            children.append(mutated(child, lengths, capacity, draw))
        people = ranked(people + children)
    return people


def encoded(bins: Bins, count: int) -> bytes:
    """The bin of each item as little-endian unsigned 32-bit numbers."""
    out = np.zeros(count, "<u4")
    for k, b in enumerate(bins):
        out[b] = k
    return out.tobytes()


def decoded(value: bytes) -> Bins:
    owner = np.frombuffer(value, "<u4")
    bins: Bins = [[] for _ in range(int(owner.max()) + 1)] if len(owner) else []
    for i, k in enumerate(owner.tolist()):
        bins[k].append(i)
    return bins


def epoch(items: DataFrame, elites: DataFrame | None, capacity: int, search: Search, turn: int) -> DataFrame:
    """One epoch of every island: shard, island, rank, bins, n_bins. ``items``: shard, at (place in the shard), length.

    An island starts from its own population and the elite that migrates from the island before it.
    """
    islands = F.explode(F.sequence(F.lit(0), F.lit(search.islands - 1)))
    dealt = items.select("shard", islands.alias("island"), "at", "length")
    kind = "shard long, island int, rank int, bins binary, n_bins int"

    def evolved(shard: int, island: int, lengths: list[int], start: list[Bins]) -> pd.DataFrame:
        seed = (shard * 1_000_003 + island * 1009 + turn) % (1 << 63)
        people = evolve(lengths, capacity, start, search, seed)
        return pd.DataFrame(
            {
                "shard": shard,
                "island": island,
                "rank": range(len(people)),
                "bins": [encoded(b, len(lengths)) for b in people],
                "n_bins": [len(b) for b in people],
            }
        )

    if elites is None:

        def first(key, rows):
            return evolved(int(key[0]), int(key[1]), rows.sort_values("at")["length"].tolist(), [])

        return dealt.groupBy("shard", "island").applyInPandas(first, kind)

    def later(key, rows, known):
        start = [decoded(b) for b in known.sort_values(["n_bins", "rank", "migrant"])["bins"]]
        return evolved(int(key[0]), int(key[1]), rows.sort_values("at")["length"].tolist(), start)

    migrants = elites.where("rank = 0").withColumn("island", (F.col("island") + 1) % search.islands)
    known = elites.withColumn("migrant", F.lit(0)).unionByName(migrants.withColumn("migrant", F.lit(1)))
    known = known.join(items.select("shard").distinct(), "shard", "left_semi")
    return dealt.groupBy("shard", "island").cogroup(known.groupBy("shard", "island")).applyInPandas(later, kind)


def pack_items(items: DataFrame, capacity: int, search: Search = Search()) -> DataFrame:
    """``items`` (item long, length) -> (item, sequence_id), with at most ``capacity`` in each sequence.

    Items must be unique and not negative, lengths between 1 and ``capacity``. An item that fills a sequence alone is
    not searched for and names its sequence; other sequences have negative numbers made of round, shard and bin.
    """
    ship(items.sparkSession)
    items = stored(items.select("item", "length"), "items")
    out = items.where(F.col("length") >= capacity).select("item", F.col("item").alias("sequence_id"))
    left = items.where(F.col("length") < capacity)
    for turn in range(1, search.rounds + 1):
        count = left.count()
        if not count:
            break
        shards = -(-count // search.shard_items)
        last = turn == search.rounds or shards == 1
        dealt = left.withColumn("shard", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(shards)))
        packed = stored(packed_shards(dealt, capacity, search, turn), f"packed-{turn}")
        full = F.lit(True) if last else F.col("fill") >= search.full * capacity
        number = (F.shiftleft(F.lit(turn).cast("long"), 58) + F.shiftleft(F.col("shard"), 18) + F.col("bin") + 1) * -1
        out = out.unionByName(packed.where(full).select("item", number.alias("sequence_id")))
        left = packed.where(~full).select("item", "length")
    return out


def packed_shards(dealt: DataFrame, capacity: int, search: Search, turn: int) -> DataFrame:
    """``dealt`` (item, length, shard) with bin and fill, the tokens in that bin."""
    place = F.row_number().over(Window.partitionBy("shard").orderBy("item")) - 1
    dealt = stored(dealt.withColumn("at", place), f"shards-{turn}")
    elites = stored(epoch(dealt, None, capacity, search, 0), f"epoch-{turn}-0")
    need = dealt.groupBy("shard").agg(F.ceil(F.sum("length") / capacity).alias("need"))
    for k in range(1, search.epochs):
        best = elites.groupBy("shard").agg(F.min("n_bins").alias("n_bins"))
        open_shards = best.join(need, "shard").where("n_bins > need").select("shard")
        open_items = dealt.join(open_shards, "shard", "left_semi")
        evolved = stored(epoch(open_items, elites, capacity, search, turn * 100 + k), f"epoch-{turn}-{k}")
        elites = stored(
            elites.join(evolved.select("shard").distinct(), "shard", "left_anti").unionByName(evolved), f"elites-{turn}-{k}"
        )
    best = elites.groupBy("shard").agg(
        F.min(F.struct("n_bins", "rank", "island")).alias("best")
    )
    chosen = elites.join(best, "shard").where(
        (F.col("rank") == F.col("best.rank")) & (F.col("island") == F.col("best.island")) & (F.col("n_bins") == F.col("best.n_bins"))
    )

    def named(batches):
        for batch in batches:
            for shard, value in zip(batch["shard"], batch["bins"]):
                owner = np.frombuffer(value, "<u4").astype(np.int64)
                yield pd.DataFrame({"shard": shard, "at": np.arange(len(owner)), "bin": owner})

    owners = chosen.select("shard", "bins").mapInPandas(named, "shard long, at int, bin long")
    placed = stored(dealt.join(owners, ["shard", "at"]), f"placed-{turn}")
    fills = placed.groupBy("shard", "bin").agg(F.sum("length").alias("fill"))
    return placed.join(fills, ["shard", "bin"]).select("item", "length", "shard", "bin", "fill")


def pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int = 1) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each whole text and its end: doc_id, piece, start, length, ids_crc32."""
    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, False).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch, texts in text_batches(batches, "text"):
            at, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encode(texts)):
                ids += end
                for k in range(0, len(ids), 4 * capacity):
                    part = ids[k : k + 4 * capacity]
                    at.append(i)
                    piece.append(k // (4 * capacity))
                    start.append(k // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(documents: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, search: Search = Search()) -> DataFrame:
    """Pieces of all documents with their sequence and offset there.

    Columns doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null texts count as empty: a piece with the
    end id alone. Repeated rows are packed each. Offsets in a sequence are gapless from 0. Only documents of more than
    ``capacity`` ids are cut.
    """
    found = pieces(documents, tokenizer, capacity, end_id)
    # Unique within the written table, however often it is read: equal rows keep different numbers.
    found = stored(found.withColumn("item", F.monotonically_increasing_id()), "pieces")
    rows = found.join(pack_items(found, capacity, search), "item")
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "item").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
