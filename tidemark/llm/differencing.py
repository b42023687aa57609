"""Packing of documents into near-equal windows by multiway differencing.

A partial partition is a descending list of window sums. It starts as one piece and empty windows; the two partitions
of the largest differences are merged, the largest windows of one with the smallest of the other, until one is left.
If its largest window exceeds the capacity, differencing starts again with more windows.

Documents may be cut, and differencing evens out to about its smallest pieces: texts are cut into bodies of at most a
quarter of a window, and of every fourth text the last few ids into pieces of powers of two. Pieces are dealt into shards
of bounded size by a hash of their row number, so that equal documents meet many others.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored, text_batches
from .tokens import encoder

SHARD_PIECES = 4096
#: One text in so many gives fine pieces, of the rest of its length by so many.
FINE_TEXTS = 4
FINE_IDS = 256


def piece_lengths(count: int, capacity: int, fine: bool) -> list[int]:
    """Lengths of the pieces of a text of ``count`` ids in order: whole windows, bodies, and powers of two if ``fine``."""
    whole, rest = divmod(count, capacity)
    body, out = max(1, capacity // 4), [capacity] * whole
    last = rest % min(FINE_IDS, body) if fine else 0
    while rest > last:
        out.append(min(body, rest - last))
        rest -= out[-1]
    return out + [1 << b for b in reversed(range(last.bit_length())) if last >> b & 1]


def merged(a: tuple, b: tuple, windows: int, nodes: list[tuple[int, int]], leaves: int) -> tuple:
    """Two partial partitions (sums, nodes), descending and without empty windows, added with opposing order."""
    (x, p), (y, q) = a, b
    over = len(x) + len(y) - windows
    if over <= 0:  # the smallest windows of each are empty ones of the other
        sums, owners = np.concatenate([x, y]), np.concatenate([p, q])
    else:
        i, k = len(x) - over, len(y) - over
        both = zip(p[i:].tolist(), q[k:][::-1].tolist())
        new = np.arange(leaves + len(nodes), leaves + len(nodes) + over)
        nodes.extend(both)
        sums = np.concatenate([x[:i], y[:k], x[i:] + y[k:][::-1]])
        owners = np.concatenate([p[:i], q[:k], new])
    order = np.argsort(-sums, kind="stable")
    return sums[order], owners[order]


def difference(lengths: list[int], windows: int) -> tuple[np.ndarray, np.ndarray]:
    """The sums of the windows, descending, and the window of each piece."""
    nodes: list[tuple[int, int]] = []
    leaves = len(lengths)
    heap = [(-n, i, (np.array([n], np.int64), np.array([i], np.int64))) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    while len(heap) > 1:
        _, turn, a = heapq.heappop(heap)
        sums, owners = merged(a, heapq.heappop(heap)[2], windows, nodes, leaves)
        least = int(sums[-1]) if len(sums) == windows else 0
        heapq.heappush(heap, (least - int(sums[0]), turn, (sums, owners)))
    sums, owners = heap[0][2]
    window = np.zeros(leaves + len(nodes), np.int64)
    window[owners] = np.arange(len(owners))
    for k in range(len(nodes) - 1, -1, -1):  # a node is made after its parts
        window[list(nodes[k])] = window[leaves + k]
    return sums, window[:leaves]


def windows_of(lengths: list[int], capacity: int) -> np.ndarray:
    """The window of each piece; as few windows as differencing finds, from the least number that could hold all."""
    windows = -(-sum(lengths) // capacity)
    while True:
        sums, window = difference(lengths, windows)
        if sums[0] <= capacity:
            return window
        windows += max(1, windows // 200)


def pieces(documents: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """Pieces of the ids of each whole text and its end: doc_id, start, length, ids_crc32, doc_tokens."""
    ship(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, False).encode
        end = np.array([end_id], "<u4").tobytes()
        for batch, texts in text_batches(batches, "text"):
            rows, figures = [], []
            names = batch.column("doc_id").to_pylist()
            for i, ids in enumerate(encode(texts)):
                ids += end
                fine = zlib.crc32(repr(names[i]).encode(), zlib.crc32(ids)) % FINE_TEXTS == 0
                start, count = 0, len(ids) // 4
                for length in piece_lengths(count, capacity, fine):
                    rows.append(i)
                    figures.append((start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), count))
                    start += length
            columns = np.array(figures, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), *map(pa.array, columns)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack(documents: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Pieces of all documents with their sequence and offset there.

    Columns doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. Null texts count as empty: the end id
    alone. Repeated rows and null ids are packed each. Offsets in a sequence are gapless from 0. A piece that fills a
    sequence is one; the others are packed by shard. An empty table gives no rows; other columns are left out.
    """
    found = pieces(documents, tokenizer, capacity, end_id)
    # Unique within the written table, however often it is read.
    found = stored(found.withColumn("piece", F.monotonically_increasing_id()), "pieces-differencing")
    full = found.where(F.col("length") == capacity)
    loose = found.where(F.col("length") < capacity)
    shards = max(1, -(-loose.count() // SHARD_PIECES))
    kind = found.drop("piece").withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")}).schema

    def packed(key, shard):
        shard = shard.sort_by("piece")
        lengths = shard["length"].to_numpy()
        window = windows_of(lengths.tolist(), capacity)
        order = np.lexsort((np.arange(len(window)), -lengths, window))
        ends = np.cumsum(lengths[order])
        first = np.diff(window[order], prepend=-1) != 0
        base = (ends - lengths[order])[first]
        offset = np.empty(len(window), np.int64)
        offset[order] = ends - lengths[order] - np.repeat(base, np.diff([*np.flatnonzero(first), len(window)]))
        shard = shard.append_column("sequence_id", pa.array((key[0].as_py() << 32) + window))
        return shard.append_column("offset", pa.array(offset)).select(kind.names)

    dealt = loose.withColumn("shard", F.pmod(F.xxhash64("piece"), F.lit(shards)))
    rows = dealt.groupBy("shard").applyInArrow(packed, kind)
    own = full.withColumns({"sequence_id": -1 - F.col("piece"), "offset": F.lit(0).cast("long")})
    return rows.unionByName(own.drop("piece"))
