"""Near copies by SimHash: fingerprints within a few bits are linked, by exact comparison of tiles.

Equal fingerprints are one row from the start. The others meet in cells, made so that two fingerprints within the
radius share at least one (see ``cell_masks``); a cell is cut into tiles by population count, and tiles whose counts
differ by more than the radius are never paired, since each differing bit changes the count by one at most. A tile pair
is compared as a whole with exclusive-or and bit counts, and gives only the edges of a spanning forest, not its pairs.

``near_copies`` is exact in this sense: at its small radius two fingerprints share a cell for certain. At the radius of
``without_copies`` they do so only by chance, and two texts that are 0.8 alike may lie beyond it. There SimHash only joins
most of each group cheaply. What it may have missed is found by the smallest hashes of the shingle sets, of which two sets
that are alike share one for certain (see ``missed_pairs``), and every link is checked on the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, only_own, ship, shuffle_partitions, stored, text_batches
from .graph import components

SEED = 42
WORD_BITS = 64
# Constants that turn one 64-bit hash into further ones.
STREAMS = tuple(np.uint64(x) for x in (0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
SPREAD = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
TILE = 2048
#: Hashes whose bits are counted at once.
COUNTED = 1 << 16


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, repeats included; of all words when there are fewer; none without a word."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[size - 1 :].tolist())], np.uint64)


def streams(hashes: np.ndarray, words: int) -> list[np.ndarray]:
    """The hashes themselves and, for longer fingerprints, further mixes of them."""
    out = [hashes]
    for salt in STREAMS[1:words]:
        h = hashes + salt
        h = (h ^ (h >> np.uint64(30))) * SPREAD[0]
        h = (h ^ (h >> np.uint64(27))) * SPREAD[1]
        out.append(h ^ (h >> np.uint64(31)))
    return out


def fingerprint(text: str | None, size: int, words: int = 1) -> bytes:
    """``words`` times 64 bits, each set if it is in over half the shingle hashes; big-endian."""
    return majority(shingle_hashes(text, size), words)


def majority(hashes: np.ndarray, words: int) -> bytes:
    out = b""
    for h in streams(hashes, words):
        counts = np.zeros(WORD_BITS, np.int64)
        for i in range(0, len(h), COUNTED):
            bits = np.unpackbits(h[i : i + COUNTED].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
        out += np.packbits(counts * 2 > len(h), bitorder="little").tobytes()[::-1]
    return out


def with_fingerprint(documents: DataFrame, column: str, size: int, words: int = 1, text: str = "text") -> DataFrame:
    """``documents`` with a fingerprint of each whole text; null and wordless texts have all bits zero."""
    @F.pandas_udf("binary")
    def made(texts: pd.Series) -> pd.Series:
        only_own()
        return pd.Series([fingerprint(t, size, words) for t in texts.tolist()], dtype=object)

    ship(documents.sparkSession)
    return documents.withColumn(column, made(F.col(f"`{text}`")))


def cell_masks(bits: int, radius: int, cell_bits: int = 14, cells: int = 40) -> list[np.ndarray]:
    """Bit positions by which fingerprints are dealt into cells.

    Small radius: ``radius + 1`` disjoint parts of the fingerprint; two that differ in ``radius`` bits agree in one of
    the parts for certain. Otherwise, where such parts would be too short to tell anything apart, ``cells`` fixed random
    choices of ``cell_bits`` positions: 256 bits that differ in 39 share a cell with chance 0.98, in 50 with 0.86.
    """
    if bits // (radius + 1) >= 12:
        return np.array_split(np.arange(bits), radius + 1)
    draw = np.random.default_rng(2024)
    return [np.sort(draw.choice(bits, cell_bits, replace=False)) for _ in range(cells)]


def as_numbers(fingerprints: Sequence[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(fingerprints), ">u8").reshape(len(fingerprints), -1).astype(np.uint64)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of two arrays of fingerprints, word by word."""
    out = np.bitwise_count(a[..., 0] ^ b[..., 0]).astype(np.uint16)
    for w in range(1, a.shape[-1]):
        out += np.bitwise_count(a[..., w] ^ b[..., w])
    return out


def dealt(fingerprints: DataFrame, radius: int, masks: list[np.ndarray]) -> DataFrame:
    """A row per fingerprint and cell: cell, f, pc (its population count)."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("f").to_pylist()
            for i in range(0, len(values), 4096):
                some = values[i : i + 4096]
                raw = np.frombuffer(b"".join(some), np.uint8).reshape(len(some), -1)
                bits = np.unpackbits(raw, axis=1)
                counts = bits.sum(axis=1, dtype=np.int32)
                for k, mask in enumerate(masks):
                    places = np.left_shift(np.int64(1), np.arange(len(mask), dtype=np.int64))
                    cell = bits[:, mask].astype(np.int64) @ places + (np.int64(k) << np.int64(40))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell), pa.array(some, pa.binary()), pa.array(counts)], names=["cell", "f", "pc"]
                    )

    return fingerprints.mapInArrow(cells, "cell long, f binary, pc int")


def forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest index that each of n nodes reaches over the links u-v."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def spanned(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links u-v; its edges need not be links themselves."""
    root = forest(u, v, n)
    child = np.flatnonzero(root != np.arange(n))
    return child, root[child]


def picked(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each node one link to a lower node, by chance, so that no node gets many; its edges are links themselves."""
    order = np.random.default_rng(7).permutation(len(u))
    lower, upper = np.minimum(u, v)[order], np.maximum(u, v)[order]
    child, first = np.unique(upper, return_index=True)
    return child, lower[first]


#: Distances computed at once within a tile pair.
BLOCK = 1 << 20


def tile_links(
    numbers: np.ndarray, side: np.ndarray, counts: np.ndarray, radius: int, reduced=spanned
) -> tuple[np.ndarray, np.ndarray]:
    """Links within one tile (all ``side`` 0) or between two, reduced to a spanning forest.

    Rows come by population count; each block meets only those rows whose counts are within the radius.
    """
    order = np.argsort(counts, kind="stable")
    numbers, side, counts = numbers[order], side[order], counts[order]
    two = bool(side.any())
    us, vs, n = [], [], len(numbers)
    step = max(1, BLOCK // max(1, n))
    for i in range(0, n, step):
        rows = numbers[i : i + step]
        upper = int(np.searchsorted(counts, counts[min(n, i + step) - 1] + radius, "right"))
        near = distances(rows[:, None, :], numbers[None, i:upper, :]) <= radius
        a, b = np.nonzero(near)
        a, b = a + i, b + i
        keep = (a < b) & ((side[a] != side[b]) if two else True)
        us.append(a[keep])
        vs.append(b[keep])
    child, other = reduced(np.concatenate(us), np.concatenate(vs), n)
    return order[child], order[other]


def run_links(
    cells: np.ndarray, numbers: np.ndarray, counts: np.ndarray, radius: int, reduced=spanned
) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal cells, all short: each row meets those so many places further on."""
    us, vs, n, lag = [], [], len(cells), 1
    at = np.arange(n)
    while True:
        at = at[at + lag < n]
        at = at[cells[at] == cells[at + lag]]
        if not len(at):
            break
        near = at[np.abs(counts[at] - counts[at + lag]) <= radius]
        near = near[distances(numbers[near], numbers[near + lag]) <= radius]
        us.append(near)
        vs.append(near + lag)
        lag += 1
    u = np.concatenate(us) if us else np.zeros(0, int)
    v = np.concatenate(vs) if vs else np.zeros(0, int)
    return reduced(u, v, n)


SHORT_RUN = 64
#: Rows gathered before they are compared, but for a run that is longer.
GATHERED = 1 << 17


def in_runs(links):
    """Function over rows sorted by ``cell`` that gives ``links`` tables of whole runs of equal cells."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= GATHERED:
                whole = pa.Table.from_batches(held).combine_chunks()
                cells = whole.column("cell").to_numpy()
                cut = int(np.searchsorted(cells, cells[-1]))  # the last run may go on
                if cut:
                    yield from links(whole.slice(0, cut))
                held = whole.slice(cut).to_batches()
                rows = len(cells) - cut
        if rows:
            yield from links(pa.Table.from_batches(held).combine_chunks())

    return work


def compared(radius: int, reduced=spanned):
    """Function over rows sorted by ``cell``: links (a, b) of fingerprints, of each part as few as ``reduced`` leaves."""

    def links(table: pa.Table) -> Iterator[pa.RecordBatch]:
        cells = table.column("cell").to_numpy()
        side = table.column("side").to_numpy()
        counts = table.column("pc").to_numpy().astype(np.int32)
        values = table.column("f").to_pylist()
        numbers = as_numbers(values)
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        lengths = np.diff(np.append(starts, len(cells)))
        short = np.repeat(lengths <= SHORT_RUN, lengths) & (side == 0)
        found = []
        own = np.flatnonzero(short)
        if len(own):
            a, b = run_links(cells[own], numbers[own], counts[own], radius, reduced)
            found.append((own[a], own[b]))
        for start, length in zip(starts.tolist(), lengths.tolist()):
            if not short[start : start + length].all():
                part = slice(start, start + length)
                a, b = tile_links(numbers[part], side[part], counts[part], radius, reduced)
                found.append((a + start, b + start))
        for a, b in found:
            if len(a):
                yield pa.RecordBatch.from_pydict(
                    {
                        "a": pa.array([values[i] for i in a.tolist()], pa.binary()),
                        "b": pa.array([values[i] for i in b.tolist()], pa.binary()),
                    }
                )

    return in_runs(links)


def in_tiles(rows: DataFrame, item: str, reach: int, *more: str) -> DataFrame:
    """Rows (cell, ``item``, pc) by tiles: cell, side, item, pc and ``more`` columns, sorted by cell within partitions.

    Cells of up to ``TILE`` rows are one tile. Larger ones are cut into tiles by pc and hash, and each pair of tiles whose
    pc are within ``reach`` becomes a cell of its own: no task ever holds more than two tiles.
    """
    kept = [item, "pc", *more]
    sizes = stored(rows.groupBy("cell", "pc").agg(F.count("*").alias("n")), "cell-sizes")
    totals = sizes.groupBy("cell").agg(F.sum("n").alias("total"))
    large = stored(totals.where(F.col("total") > TILE).select("cell"), "large-cells")
    small = rows.join(large, "cell", "left_anti").select("cell", F.lit(0).alias("side"), *kept)
    # Tiles of the large cells: one pc each, and where that is too many rows, one hash share of it.
    tiles = sizes.join(large, "cell").select(
        "cell", "pc", F.ceil(F.col("n") / TILE).cast("int").alias("parts")
    )
    tiles = stored(tiles.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))), "tiles")
    other = tiles.select("cell", F.col("pc").alias("pc2"), F.col("part").alias("part2"))
    pairs = tiles.join(other, "cell").where(
        (F.col("pc2") - F.col("pc")).between(0, reach)
        & ((F.col("pc") < F.col("pc2")) | (F.col("part") <= F.col("part2")))
    )
    pairs = pairs.withColumn("pair", F.xxhash64("cell", "pc", "part", "pc2", "part2"))
    lone = (F.col("pc") == F.col("pc2")) & (F.col("part") == F.col("part2"))
    sides = pairs.select("cell", "pc", "part", "parts", "pair", F.lit(0).alias("side")).union(
        pairs.where(~lone).select("cell", "pc2", "part2", F.lit(None).cast("int"), "pair", F.lit(1))
    )
    sides = sides.drop("parts")
    members = rows.join(tiles.select("cell", "pc", "parts").distinct(), ["cell", "pc"]).withColumn(
        "part", F.pmod(F.xxhash64(item), F.col("parts")).cast("int")
    )
    members = members.join(sides, ["cell", "pc", "part"]).select(F.col("pair").alias("cell"), "side", *kept)
    together = small.unionByName(members).repartition(max(shuffle_partitions(rows.sparkSession), 8), "cell")
    return together.sortWithinPartitions("cell")


def near_links(fingerprints: DataFrame, radius: int, bits: int, reduced=spanned) -> DataFrame:
    """Links (a, b) that join distinct fingerprints (column f) within the radius into their components.

    With disjoint cells (see ``cell_masks``) these are the components of all pairs within the radius.
    """
    ship(fingerprints.sparkSession)
    rows = dealt(fingerprints, radius, cell_masks(bits, radius))  # cheap to make again, large to keep
    return in_tiles(rows, "f", radius).mapInArrow(compared(radius, reduced), "a binary, b binary").distinct()


def groups(fingerprints: DataFrame, radius: int, bits: int) -> DataFrame:
    """Of each fingerprint (column f, repeats allowed) that is linked to another: f and the root of its component."""
    distinct = stored(fingerprints.select("f").where(F.col("f").isNotNull()).distinct(), "fingerprints")
    return components(near_links(distinct, radius, bits)).select(F.col("node").alias("f"), "root")


def near_copies(
    documents: DataFrame,
    size: int = 3,
    radius: int = 3,
    words: int = 1,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Per row of ``documents``: doc_id, fingerprint (hexadecimal) and component_id, the smallest doc_id it reaches.

    Null, empty and wordless texts have a fingerprint of zeros and are linked like any other. Repeated rows come back
    each. A null doc_id is larger than any other; a component with no other has a null id.
    """
    rows = documents.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = with_fingerprint(rows, "f", size, words).select("doc_id", "f")
    rows = stored(rows, "document-fingerprints")
    linked = stored(groups(rows, radius, WORD_BITS * words), "groups")
    least = rows.groupBy("f").agg(F.min("doc_id").alias("least"))
    least = least.join(linked, "f", "left").withColumn("root", F.coalesce("root", "f"))
    least = stored(least.select("f", "root", "least"), "least-by-fingerprint")
    of_root = least.groupBy("root").agg(F.min("least").alias("component_id"))
    of_each = stored(least.join(of_root, "root").select("f", "component_id"), "component-of-fingerprint")
    found = rows.join(of_each, "f")
    return found.select("doc_id", F.lower(F.hex("f")).alias("fingerprint"), "component_id")


#: Shingle sets are near copies when their Jaccard similarity is this fraction or more.
ALIKE = (4, 5)
#: Parity bits of a shingle set.
PARITY_BITS = 512


def alike(common, total, similarity: tuple[int, int] = ALIKE):
    """Are sets with ``total`` members together, ``common`` of them counted twice, similar enough?"""
    part, whole = similarity
    return whole * common >= part * (total - common)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, size))


def parity(members: np.ndarray) -> bytes:
    """Of each class of hashes whether an odd number is in the set: differing bits never exceed differing members."""
    counts = np.bincount((members % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS)
    return np.packbits(counts & 1).tobytes()


def short_id(key: bytes) -> int:
    """The first half of a set's key; two sets that have one in common only cause a needless comparison."""
    return int.from_bytes(key[:8], "big", signed=True)


def with_set(texts: DataFrame, size: int, words: int) -> DataFrame:
    """For each row of ``texts`` (id, h, text) its doc_id and h, the text's fingerprint f and, of its shingle set, key, short id,
    size and parity bits. Texts are handled in slices, so that a task holds few of them."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        for batch, values in text_batches(batches, "text"):
            out = []
            for text in values:
                hashes = shingle_hashes(text, size)
                members = np.unique(hashes)
                key = xxhash.xxh3_128_digest(members.tobytes(), SEED)
                out.append((majority(hashes, words), key, short_id(key), len(members), parity(members)))
            kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.binary())
            columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
            names = ["doc_id", "h", "f", "key", "id", "size", "bits"]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("h"), *columns], names=names)

    ship(texts.sparkSession)
    schema = T.StructType([T.StructField("doc_id", texts.schema["id"].dataType), T.StructField("h", T.LongType())])
    for field in T.StructType.fromDDL("f binary, key binary, id long, size int, bits binary").fields:
        schema = schema.add(field)
    return texts.select("id", "h", "text").mapInArrow(made, schema)


def wide_parity(members: np.ndarray) -> bytes:
    """As many parity bits as the set has members, rounded up to a power of two.

    Unlike sets then differ in about half of their number in bits, those that are alike in at most two ninths.
    """
    bits = np.uint64(max(PARITY_BITS, 1 << (len(members) - 1).bit_length()) if len(members) else PARITY_BITS)
    counts = np.bincount((members & (bits - np.uint64(1))).astype(np.int64), minlength=int(bits))
    return np.packbits(counts & 1).tobytes()


def parity_distance(x: np.ndarray, y: np.ndarray) -> int:
    """Differing parity bits; the wider ones are folded to the width of the others, which adds up the same hashes."""
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


#: Bits that mark the rows asked for, 4 KB of them in a bitmap of Spark's: 2 MB in all, however many rows there are.
MARKS = 1 << 24


def asked_only(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """Those rows of ``texts`` (id, h) that are in ``asked`` (doc_id, of_h), and by chance a few others.

    Each row asked for sets one of ``MARKS`` bits, and rows with a set bit stay. The bits go to all tasks, so that texts
    which nobody asks for are not shuffled; the share that stays by chance is at most that of the bits set.
    """

    def mark(*columns: str):
        return F.pmod(F.xxhash64(*columns), F.lit(MARKS)) + 1

    at = mark("doc_id", "of_h")
    marks = asked.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("marks"))
    at = F.bitmap_bit_position(mark("id", "h"))
    byte = F.conv(F.hex(F.substring("marks", (F.shiftright(at, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = texts.join(F.broadcast(marks), F.bitmap_bucket_number(mark("id", "h")) == F.col("bucket"))
    return found.where(F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1).select(*texts.columns)


def checked(pairs: DataFrame, sets: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Those of the ``pairs`` (a, b) of set keys whose shingle sets are alike, by the sets themselves.

    ``sets`` (key, least) names a document of each set, ``texts`` (id, h, text) holds the documents.
    """
    pairs = stored(pairs.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pairs-to-check")

    def texts_of(some: DataFrame, label: str) -> DataFrame:
        """The key and text of each set in ``some`` pairs."""
        asked = some.select(F.col("a").alias("key")).union(some.select("b")).distinct()
        asked = stored(sets.join(asked, "key").select("key", "least.doc_id", F.col("least.h").alias("of_h")), label)
        same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("of_h"))
        # Merged at every size: few texts are left, and what is shuffled should grow with them from the start.
        return asked_only(texts, asked).join(asked.hint("merge"), same).select("key", "text")

    def parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        for batch, values in text_batches(batches, "text", most_rows=256, most_bytes=1 << 20):
            sets = [shingle_set(t, size) for t in values]
            bits, sizes = pa.array([wide_parity(m) for m in sets], pa.binary()), pa.array([len(m) for m in sets], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("key"), bits, sizes], names=["key", "parity", "size"])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        for batch, values in text_batches(batches, "text", most_rows=256, most_bytes=1 << 20):
            sets = pa.array([shingle_set(t, size).tobytes() for t in values], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), sets], names=["key", "members"])

    found = texts_of(pairs, "sets-to-tell-apart").mapInArrow(parities, "key binary, parity binary, size int")
    found = stored(found.dropDuplicates(["key"]), "parities-to-check")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        part, whole = ALIKE
        for batch in batches:
            kept = []
            for n, m, x, y in zip(batch.column("n").to_pylist(), batch.column("m").to_pylist(), batch.column("x"), batch.column("y")):
                least = -(-part * (n + m) // (part + whole))
                x, y = (np.frombuffer(v.as_buffer(), np.uint8) for v in (x, y))
                kept.append(alike(min(n, m), n + m) and parity_distance(x, y) <= n + m - 2 * least)
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    # Parity bits are a small part of a set and tell most unlike ones; sets go only to the pairs that are left.
    sides = {c: found.select(F.col("key").alias(c), F.col("parity").alias(v), F.col("size").alias(n)) for c, v, n in (("a", "x", "n"), ("b", "y", "m"))}
    close = pairs.join(sides["a"], "a").join(sides["b"], "b").select("a", "b", "x", "y", "n", "m")
    pairs = stored(close.mapInArrow(near, "a binary, b binary"), "close-pairs")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        for batch in batches:
            kept = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                total = len(x) + len(y)
                kept.append(
                    alike(min(len(x), len(y)), total)
                    and alike(len(np.intersect1d(x, y, assume_unique=True)), total)
                )
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    # Whole sets, which are larger than their texts, are made of those only that are left.
    found = texts_of(pairs, "sets-to-check").dropDuplicates(["key"])
    found = stored(found.mapInArrow(members, "key binary, members binary"), "members-to-check")
    both = pairs.join(found.select(F.col("key").alias("a"), F.col("members").alias("x")), "a")
    both = both.join(found.select(F.col("key").alias("b"), F.col("members").alias("y")), "b")
    return stored(both.select("a", "b", "x", "y").mapInArrow(judged, "a binary, b binary"), "links")


def likely_pairs(sets: DataFrame, radius: int, bits: int) -> DataFrame:
    """Pairs (a, b) of sets with equal fingerprints or near ones: what SimHash finds, few of each group."""
    first = stored(sets.groupBy("f").agg(F.min("key").alias("key")), "fingerprints")
    equal = sets.join(first.withColumnRenamed("key", "b"), "f").select(F.col("key").alias("a"), "b")
    links = stored(near_links(first.select("f"), radius, bits, picked), "near-fingerprints")
    near = links.join(first.select(F.col("f").alias("a"), F.col("key").alias("ka")), "a")
    near = near.join(first.select(F.col("f").alias("b"), F.col("key").alias("kb")), "b")
    return equal.where("a != b").union(near.select("ka", "kb"))


def in_prefix(count: int) -> int:
    """So many first members of a set, in any order that all sets share, that no set which is alike can do without all."""
    part, whole = ALIKE
    return count - -(-part * count // whole) + 1 if count else 0


#: Hashes that are ordered by how common they are, and how often a hash must be seen to be one of them.
COMMON, SEEN = 1 << 17, 8
#: Hashes of a task that are counted together.
HELD = 1 << 21


def common_hashes(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that stand in the prefixes of many different sets, ascending, and about how often they do.

    Only the order of prefixes depends on them, never the result, so what is rare within every task need not be counted,
    and their number is bounded.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        seen: set[int] = set()
        held: list[np.ndarray] = []

        def repeated() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(values[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["cell", "n"])

        for _, values in text_batches(batches, "text"):
            for text in values:
                members = shingle_set(text, size)
                key = xxhash.xxh3_64_intdigest(members.tobytes())
                if key not in seen:  # copies say nothing
                    seen.add(key)
                    # More than a prefix: what follows when common ones are put behind.
                    held.append(members[: 2 * in_prefix(len(members))])
            if sum(map(len, held)) > HELD:
                yield repeated()
        if held:
            yield repeated()

    found = texts.select("text").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    found = found.where(F.col("n") >= SEEN).orderBy(F.desc("n"), "cell").limit(COMMON).toArrow()
    cells = found.column("cell").to_numpy().view(np.uint64)
    order = np.argsort(cells)
    return cells[order], found.column("n").to_numpy()[order]


def prefix(members: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The first members of a set: uncommon ones by hash, then the others by how common they are."""
    n, (hashes, counts) = in_prefix(len(members)), common
    if not len(hashes):
        return members[:n]
    at = np.minimum(np.searchsorted(hashes, members), len(hashes) - 1)
    seen = np.where(hashes[at] == members, counts[at], 0)
    return members[np.lexsort((members, seen))[:n]] if seen.any() else members[:n]


def prefixes(texts: DataFrame, size: int, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """A row (cell, id) per text and each hash in the prefix of its shingle set."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        for _, values in text_batches(batches, "text"):
            sets = [shingle_set(t, size) for t in values]
            ids = [short_id(xxhash.xxh3_128_digest(s.tobytes(), SEED)) for s in sets]
            cells = [prefix(s, common) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(cells).view(np.int64)),
                    pa.array(np.repeat(np.array(ids, np.int64), [len(c) for c in cells])),
                ],
                names=["cell", "id"],
            )

    return texts.select("text").mapInArrow(made, "cell long, id long")


def possible(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) within the cells of a table that sizes and parity bits allow to be alike, of different roots."""
    cells, side = table.column("cell").to_numpy(), table.column("side").to_numpy()
    sizes = table.column("size").to_numpy().astype(np.int64)
    root, key = (table.column(c).combine_chunks().dictionary_encode() for c in ("root", "key"))
    if isinstance(root, pa.ChunkedArray):
        root, key = root.combine_chunks(), key.combine_chunks()
    roots, keys = root.indices.to_numpy(), key.indices.to_numpy().astype(np.int64)
    numbers = as_numbers(table.column("bits").to_pylist())
    part, whole = ALIKE
    found = []

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        total = sizes[a] + sizes[b]
        fits = (roots[a] != roots[b]) & alike(np.minimum(sizes[a], sizes[b]), total)
        a, b, total = a[fits], b[fits], total[fits]
        least = -(-part * total // (part + whole))
        fits = distances(numbers[a], numbers[b]) <= total - 2 * least
        a, b = keys[a[fits]], keys[b[fits]]
        found.append(np.unique(np.minimum(a, b) * len(cells) + np.maximum(a, b)))

    starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
    lengths = np.diff(np.append(starts, len(cells)))
    short = np.repeat(lengths <= SHORT_RUN, lengths) & (side == 0)
    at, lag = np.flatnonzero(short), 1
    while len(at):
        at = at[at + lag < len(cells)]
        at = at[(cells[at] == cells[at + lag]) & short[at + lag]]
        keep(at, at + lag)
        lag += 1
    for start, length in zip(starts.tolist(), lengths.tolist()):
        if short[start : start + length].all():
            continue
        two = bool(side[start : start + length].any())
        step = max(1, (BLOCK >> 2) // length)
        for i in range(start, start + length, step):
            a, b = np.meshgrid(np.arange(i, min(i + step, start + length)), np.arange(i, start + length), indexing="ij")
            a, b = a.ravel(), b.ravel()
            meet = (a < b) & ((side[a] != side[b]) if two else True)
            keep(a[meet], b[meet])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    for i in range(0, len(pairs), COUNTED):
        some = pairs[i : i + COUNTED]
        a, b = (key.dictionary.take(pa.array(k)) for k in (some // len(cells), some % len(cells)))
        yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"])


def missed_pairs(sets: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """All pairs (a, b) of sets of different ``root`` that may be alike: none that is alike is left out.

    Two sets that are alike share a hash of their prefixes in any common order; in the order taken here, hashes of passages
    that many texts share come last, so that few prefixes hold them. Hashes that only one set has are dropped by a
    count, and so are those whose sets all have one root already; of hashes that the same sets have, one is kept. The sets of a hash are compared in tiles, where the difference
    of sizes and of parity bits, which no pair that is alike exceeds, leaves few to be checked.
    """
    rows = prefixes(texts, size, common_hashes(texts, size))  # cheap to make again, large to keep
    shared = rows.groupBy("cell").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    members = stored(rows.join(stored(shared.select("cell"), "shared-cells"), "cell").distinct(), "shared-members")
    of_cell = members.join(sets.select("id", "root", "key"), "id").groupBy("cell")
    # Passages that the same texts share give many cells of the same sets, told by 128 bits and a count: one of them is enough.
    seal = {"x": F.bit_xor(F.xxhash64("key")), "y": F.bit_xor(F.xxhash64(F.lit(SEED), "key")), "n": F.count("*")}
    mixed = of_cell.agg(F.min("root").alias("low"), F.max("root").alias("high"), *[v.alias(k) for k, v in seal.items()])
    mixed = mixed.where("low < high").groupBy(*seal).agg(F.min("cell").alias("cell")).select("cell")
    # Sizes that are alike lie in one band or in two that follow each other.
    band = F.floor(F.log(F.col("size").cast("double")) / F.lit(float(np.log(ALIKE[1] / ALIKE[0]) * 1.0001))).cast("int")
    known = members.join(stored(mixed, "mixed-cells"), "cell").join(sets, "id")
    known = stored(known.select("cell", "key", "size", "bits", "root", band.alias("pc")), "mixed-members")
    tiles = in_tiles(known, "key", 1, "size", "bits", "root")
    return tiles.mapInArrow(in_runs(possible), "a binary, b binary")


def without_copies(
    documents: DataFrame, size: int = 5, radius: int = 50, words: int = 4, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """``documents`` with one row of each group of near copies: the one with the smallest doc_id.

    Near copies are texts whose sets of ``size``-word shingles have a Jaccard similarity of 0.8 or more, and groups are
    their components. SimHash tiles find likely pairs, the smallest hashes of the sets all others that may be alike, and
    every link is checked on the sets themselves before it counts: no two texts of the result are 0.8 alike.
    Null, empty and wordless texts are one group. Of rows with one doc_id and text, one stays; a null doc_id is larger
    than any other. All columns stay as they are.
    """
    own = documents.columns
    key, copy = fresh(documents, "copy_key"), fresh(documents, "copy_id")
    marked = documents.withColumns(
        {key: F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit(""))), copy: F.col(f"`{doc_id}`")}
    )
    texts = marked.select(F.col(copy).alias("id"), F.col(key).alias("h"), F.col(f"`{text}`").alias("text"))
    rows = with_set(texts, size, words)
    rows = stored(rows.groupBy("doc_id", "h", "key", "id", "f", "size", "bits").agg(F.count("*").alias("n")), "document-sets")
    # Structs compare nulls first; a flag puts a null id last.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")
    first = [F.min(c).alias(c) for c in ("f", "id", "size", "bits")]
    sets = stored(rows.groupBy("key").agg(F.min(order).alias("least"), *first), "shingle-sets")
    links = checked(likely_pairs(sets, radius, WORD_BITS * words), sets, texts, size)
    joined = stored(components(links), "likely-groups")
    rooted = sets.join(joined.withColumnRenamed("node", "key"), "key", "left")
    rooted = stored(rooted.select("key", "id", "size", "bits", F.coalesce("root", "key").alias("root")), "rooted-sets")
    more = checked(missed_pairs(rooted, texts, size), sets, texts, size)
    linked = components(more.union(joined)).select(F.col("node").alias("key"), "root")
    least = sets.join(linked, "key", "left").select("key", F.coalesce("root", "key").alias("root"), "least")
    least = stored(least, "least-by-set")
    of_root = least.groupBy("root").agg(F.min("least").alias("kept"))
    of_each = stored(least.join(of_root, "root").select("key", "kept"), "kept-by-set")
    gone_id, gone_key = fresh(marked, "gone_id"), fresh(marked, "gone_key")
    judged = rows.join(of_each, "key").select(
        F.col("doc_id").alias(gone_id), F.col("h").alias(gone_key), "n", (order == F.col("kept")).alias("stays")
    )
    judged = stored(judged.where("not stays or n > 1"), "judged")
    same = F.col(copy).eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key))
    gone = judged.select(gone_id, gone_key)
    repeated = judged.where("stays").select(gone_id, gone_key)
    columns = [F.col(f"`{c}`") for c in own]
    # Merged at every size: whether so many ids may be broadcast should not depend on how many there happen to be.
    single = marked.join(gone.hint("merge"), same, "left_anti").select(*columns)
    if repeated.isEmpty():
        return single
    once = marked.join(repeated, same, "left_semi").dropDuplicates([copy, key]).select(*columns)
    return single.unionByName(once)
