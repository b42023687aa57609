"""Exact top-k inner products by an impact-ordered index, score at a time.

The index of a block of vectors has, for each dimension, posting segments: the vectors whose component falls into one
of a few levels. For a query, a segment's impact is the most that its level adds to a score above the least that its
dimension adds to any. Segments of all dimensions are processed by descending impact, and their bounds added to the
accumulators of their vectors. What is left to process bounds every score from above, so processing stops when, by
proof, few vectors can still be among the best; those are rescored exactly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

#: Levels per dimension. More of them bound scores closer and make shorter segments.
LEVELS = 32
#: Shares of all postings after which a proof is tried.
TRIES = (0.5, 0.65, 0.75, 0.82, 0.88, 0.92, 0.95, 0.975, 1.0)


class BlockIndex:
    """Posting segments of a block of vectors of whole numbers.

    Segment i has the rows ``rows[start[i] : start[i] + length[i]]``, whose component ``dim[i]`` lies between ``low[i]``
    and ``high[i]``. Levels are equally wide within a dimension, and empty ones are left out.
    """

    def __init__(self, vectors: np.ndarray, levels: int = LEVELS) -> None:
        self.vectors = vectors.astype(np.float64)
        n, dims = vectors.shape
        least, most = self.vectors.min(axis=0), self.vectors.max(axis=0)
        level = ((self.vectors - least) * (levels / (most - least + 1))).astype(np.int32)
        keys = (level + np.arange(dims, dtype=np.int32) * levels).T.ravel()
        order = np.argsort(keys, kind="stable")
        self.rows = (order % n).astype(np.int32)
        segments, self.start, self.length = np.unique(keys[order], return_index=True, return_counts=True)
        self.dim = segments // levels
        values = self.vectors.T.ravel()[order]
        self.low = np.minimum.reduceat(values, self.start)
        self.high = np.maximum.reduceat(values, self.start)

    def best(self, query: np.ndarray, k: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows and exact scores of all that can be among the k best, ties included; ``own`` rows take no part."""
        n, dims = self.vectors.shape
        q = query.astype(np.float64)
        ends = np.stack([q[self.dim] * self.low, q[self.dim] * self.high])
        base = np.full(dims, np.inf)
        np.minimum.at(base, self.dim, ends.min(axis=0))
        impact = ends.max(axis=0) - base[self.dim]
        middle = ends.mean(axis=0) - base[self.dim]
        # How far the middle of a segment may be from what its vectors really add, over all dimensions.
        error = np.zeros(dims)
        np.maximum.at(error, self.dim, impact - middle)
        slack = 2 * error.sum() + 1e-6
        order = np.argsort(-impact, kind="stable")
        ends_of = np.cumsum(self.length[order])
        score = np.zeros(n)
        if own is not None and len(own):
            score[own] = -np.inf
        taken = n - (len(own) if own is not None else 0)
        possible, done = np.arange(n), 0
        for share in TRIES:
            if taken <= k:
                break
            upto = int(np.searchsorted(ends_of, share * ends_of[-1])) + 1
            now = order[done:upto]
            if len(now):
                rows = np.concatenate([self.rows[a : a + m] for a, m in zip(self.start[now].tolist(), self.length[now].tolist())])
                score += np.bincount(rows, np.repeat(middle[now], self.length[now]), n)
            done = upto
            # A vector that is not yet met in a dimension adds no more there than the segment that comes next.
            remaining = np.zeros(dims)
            np.maximum.at(remaining, self.dim[order[done:]], impact[order[done:]])
            kth = np.partition(score, n - k)[n - k]
            possible = np.flatnonzero(score >= kth - slack - remaining.sum())
            if len(possible) <= max(4 * k, n // 64):
                break
        if own is not None and len(own):
            possible = np.setdiff1d(possible, own)
        scores = self.vectors[possible] @ q
        if len(possible) > k:
            bound = np.partition(scores, len(scores) - k)[len(scores) - k]
            possible, scores = possible[scores >= bound], scores[scores >= bound]
        return possible, scores


def whole(embedding: Column) -> Column:
    """Components x as floor(256 * x); null for a vector that is null, empty or holds a null or a non-finite one."""
    numbers = F.transform(embedding, lambda x: x.cast("double"))
    sound = (F.size(numbers) > 0) & F.forall(
        numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.when(sound, F.transform(numbers, lambda x: F.floor(x * 256).cast("long")))


def exact_best(vectors: np.ndarray, query: np.ndarray, k: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and scores of the k best with ties in whole numbers, for products that doubles cannot tell apart."""
    scores = vectors @ query
    rows = np.setdiff1d(np.arange(len(vectors)), own)
    if len(rows) > k:
        rows = rows[scores[rows] >= np.partition(scores[rows], len(rows) - k)[len(rows) - k]]
    return rows, scores[rows]


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 5,
    block_rows: int = 16_384,
    block_queries: int = 2_048,
) -> DataFrame:
    """For each query (query_id, v) its k best of ``vectors`` (vec_id, v): query_id, rank, vec_id, score.

    v holds whole numbers. Every row of ``queries`` asks for itself. If ``vectors`` has a column ``at`` with a number
    of each row, a query may name one as its ``own``, which is no candidate; nor are vectors with another number of
    dimensions. Fewer candidates than k are all returned; ties go to the smaller id, and repeated rows count each.
    Products beyond 2**53 are summed in whole numbers, those that 64 bits may not hold fail the job. Vectors are dealt by
    hash into blocks that are indexed whole, queries into blocks too, and each task searches one index block for one
    query block, so no task holds more than two blocks and only the k best of a block leave it.
    """
    ship(vectors.sparkSession)
    # The number in the written table spreads repeated rows, and stays the same however often it is read.
    number, none = F.monotonically_increasing_id(), F.lit(None).cast("long")
    at = F.col("at") if "at" in vectors.columns else number
    own = F.col("own") if "own" in queries.columns else none
    vectors = stored(vectors.select("vec_id", "v", F.size("v").alias("dims"), at.alias("at")), "vectors")
    queries = stored(queries.select("query_id", "v", F.size("v").alias("dims"), own.alias("own"), number.alias("q")), "queries")
    sizes = [df.count() for df in (vectors, queries)]
    index_blocks, query_blocks = (max(1, -(-n // m)) for n, m in zip(sizes, (block_rows, block_queries)))
    left = vectors.select(
        F.pmod(F.xxhash64("vec_id", "at"), F.lit(index_blocks)).cast("long").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("j"),
        "dims", F.lit(-1).cast("long").alias("q"), "at", F.col("vec_id").alias("id"), "v",
    )
    right = queries.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(index_blocks - 1).cast("long"))).alias("i"),
        F.pmod(F.xxhash64("query_id", "q"), F.lit(query_blocks)).cast("long").alias("j"),
        "dims", "q", F.coalesce("own", F.lit(-1)).alias("at"), F.col("query_id").alias("id"), "v",
    )

    def searched(rows):
        asks = rows["q"].to_numpy() >= 0
        known, asked = rows[~asks], rows[asks]
        columns = ["q", "query_id", "vec_id", "score"]
        if not len(known) or not len(asked):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in columns})
        known = known.sort_values("at")
        places, ids = known["at"].to_numpy(), known["id"].to_numpy()
        block = np.stack(known["v"].to_numpy())
        index, most = BlockIndex(block), float(np.abs(block.astype(np.float64)).max())
        out = []
        for q, query_id, at, v in zip(asked["q"].tolist(), asked["id"].tolist(), asked["at"].tolist(), asked["v"]):
            v = np.asarray(v)
            a, b = np.searchsorted(places, at, "left"), np.searchsorted(places, at, "right")
            bound = float(np.abs(v.astype(np.float64)).sum()) * most
            if bound >= 2.0**62:
                raise ValueError(f"products of query {query_id} may not fit 64 bits")
            if bound < 2.0**52:
                found, scores = index.best(v, k, np.arange(a, b))
            else:
                found, scores = exact_best(block, v, k, np.arange(a, b))
            best = np.lexsort((ids[found], -scores))[:k]
            figures = {"q": q, "query_id": query_id, "vec_id": ids[found[best]], "score": scores[best].astype(np.int64)}
            out.append(pd.DataFrame(figures))
        return pd.concat(out)[columns]

    pairs = left.unionByName(right).groupBy("i", "j", "dims")
    found = pairs.applyInPandas(searched, "q long, query_id long, vec_id long, score long")
    of_query = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def search_every(embeddings: DataFrame, divisor: int = 50, k: int = 5) -> DataFrame:
    """The k best of all rows of ``embeddings`` (vec_id, embedding) for those whose vec_id ``divisor`` divides.

    Every such row asks, also where several have one id, and only the row itself is no candidate of its own. Rows
    without an id and unsound vectors take no part.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding")).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()), "numbered-vectors")
    queries = rows.where(F.col("vec_id") % divisor == 0).select(F.col("vec_id").alias("query_id"), "v", F.col("at").alias("own"))
    return search(rows, queries, k)
