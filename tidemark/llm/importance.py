"""Importance resampling towards a target distribution of hashed n-grams.

Texts are lower-cased, split and dictionary-encoded by Arrow kernels a slice of rows at a time. Shifted dictionary indices
form n-grams; only the distinct ones of a slice are hashed. Counts per bucket are summed by Spark; the gains of the
buckets, a list of fixed length, go to the tasks that weigh whole texts. The draw is the highest scores with Gumbel noise of
the id, ranked by ranges of the score.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, ship, shuffle_partitions, stored

#: What stands between words, and the word itself for SQL.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches of about ``most_bytes`` of text; a longer text is a slice of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def words(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts in order, dictionary-encoded, and the number of words of each text."""
    # Lower-cased before the cast: on a cast slice of an array the kernel gives other bytes than the texts'.
    lower = pc.ascii_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    lists = pc.split_pattern_regex(lower, pattern=BETWEEN)
    flat, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.not_equal(pc.binary_length(flat), 0)  # a text may start or end between words
    counts = np.bincount(parents.filter(some).to_numpy(), minlength=len(texts))
    return pc.dictionary_encode(flat.filter(some)), counts.astype(np.int64)


def features(encoded: pa.DictionaryArray, counts: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of 1 to ``n`` words: checksums of the distinct runs, the run at each place, the texts' numbers of runs."""
    spelled = encoded.dictionary.cast(pa.large_binary()).to_pylist()
    word = encoded.indices.to_numpy().astype(np.int64)
    ends = np.repeat(np.cumsum(counts), counts)  # where the text of each word ends
    sums = np.array([zlib.crc32(w) for w in spelled], np.int64)
    run = word
    yield sums, run, counts
    for length in range(2, n + 1):
        keep = np.arange(len(word) - length + 1)
        keep = keep[keep + length <= ends[keep]] if len(keep) else keep
        # ``run`` holds one entry a place while it grows, so that shifts stay simple.
        pairs = run[keep] * max(1, len(spelled)) + word[keep + length - 1]
        distinct, code = np.unique(pairs, return_inverse=True)
        before, last = np.divmod(distinct, max(1, len(spelled)))
        sums = np.array([zlib.crc32(b" " + spelled[w], int(s)) for s, w in zip(sums[before], last)], np.int64)
        run = np.zeros(len(word), np.int64)
        run[keep] = code
        yield sums, code, np.maximum(0, counts - length + 1)


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """How often features of all texts fall into each bucket: bucket, count. Tasks sum before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            for sums, runs, _ in features(*words(batch.column("text")), n):
                total += np.bincount((sums % buckets)[runs], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "count"])

    found = texts.select("text").mapInArrow(counted, "bucket long, count long")
    return found.groupBy("bucket").agg(F.sum("count").alias("count"))


def gains(documents: DataFrame, target: DataFrame, n: int, buckets: int) -> np.ndarray:
    """A bucket's gain: its smoothed logarithmic share in the target against that in the documents, in thousandths."""
    both = bucket_counts(documents, n, buckets).withColumn("side", F.lit(0)).unionByName(
        bucket_counts(target, n, buckets).withColumn("side", F.lit(1))
    )
    counts = [[0] * buckets, [0] * buckets]
    for row in both.collect():  # at most two rows a bucket
        counts[row["side"]][row["bucket"]] = row["count"]
    all_s, all_t = (float(sum(c) + buckets) for c in counts)  # in doubles, also where a product exceeds 2^53
    return np.array(
        [math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t))) for s, t in zip(*counts)], np.int64
    )


def weighed(documents: DataFrame, gain: np.ndarray, n: int) -> DataFrame:
    """doc_id, n_words, n_features and weight, the sum of the gains of all features, of each whole text."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    buckets, gain = len(gain), pa.array(gain)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            encoded, counts = words(batch.column("text"))
            number, weight = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for sums, runs, sizes in features(encoded, counts, n):
                each = gain.take(pa.array(sums % buckets)).take(pa.array(runs)).to_numpy()
                starts = np.cumsum(sizes) - sizes
                some = sizes > 0
                if len(each):
                    weight[some] += np.add.reduceat(each, starts[some])
                number += sizes
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.array(number), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    rows = documents.select("doc_id", "text")
    return rows.mapInArrow(summed, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(seed: int, doc_id: Column) -> Column:
    """Gumbel noise in thousandths, a fixed function of seed and id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    drawn = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(-1000.0 * F.ln(-F.ln(drawn))).cast("long")


def ranked(rows: DataFrame, most: int, order: list[Column], into: str) -> DataFrame:
    """``rows`` with places 1, 2, 3... of the first ``most`` in this order; the place of others is null.

    Rows are written by ranges of the order, counted per range, and numbered only in ranges that hold a place. Equal rows
    are told apart by a number, so that even they are split.
    """
    tie, part, before = fresh(rows, "tie"), fresh(rows, "part"), fresh(rows, "before")
    numbered = rows.withColumn(tie, F.monotonically_increasing_id())
    ranges = numbered.repartitionByRange(max(1, shuffle_partitions(rows.sparkSession)), *order, tie)
    ranges = stored(ranges.withColumn(part, F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy(part).count().orderBy(part).collect()  # a row per range
    starts, total = {}, 0
    for number, size in sizes:
        starts[number] = total
        total += size
    inside = [p for p, start in starts.items() if start < most]
    has_place = F.col(part).isin(inside) if inside else F.lit(False)
    base = F.create_map(*[F.lit(x) for p in inside for x in (p, starts[p])]) if inside else F.create_map(F.lit(0), F.lit(0))
    place = F.row_number().over(Window.partitionBy(part).orderBy(*order, tie)) + base[F.col(part)]
    first = ranges.where(has_place).withColumn(before, place.cast("long"))
    first = first.withColumn(into, F.when(F.col(before) <= most, F.col(before)))
    others = ranges.where(~has_place).withColumn(into, F.lit(None).cast("long"))
    return first.select(*rows.columns, into).unionByName(others.select(*rows.columns, into))


def resample(
    documents: DataFrame,
    target: DataFrame,
    n: int = 1,
    buckets: int = 10_000,
    percent: int = 10,
    least_words: int = 20,
    seed: int = 2024,
) -> DataFrame:
    """Every document with its figures and its place in the draw: doc_id, n_features, weight, score, rank.

    ``documents``: doc_id, text; ``target``: text. ``percent`` of the documents of at least ``least_words`` words are drawn,
    rounded down, by descending score and ascending doc_id, null ids last; rank is null for all others. Null texts count
    as empty: no features, weight 0. Repeated rows are weighed and ranked each. Other columns are left out, whatever
    their names. Empty tables are allowed on either side.
    """
    ship(documents.sparkSession)
    gain = gains(documents, target, n, buckets)
    scored = weighed(documents, gain, n)
    scored = stored(scored.withColumn("score", F.col("weight") + noise(seed, F.col("doc_id"))), "importance")
    long_enough = F.col("n_words") >= least_words
    most = percent * scored.where(long_enough).count() // 100
    drawn = ranked(scored.where(long_enough), most, [F.desc("score"), F.asc_nulls_last("doc_id")], "rank")
    others = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank")
