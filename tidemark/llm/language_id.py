"""Language identification by the nearest of several centroids per language.

A text is a vector of hashed letter n-grams (one to three letters), weighted by the root of their count and their
inverse document frequency, and normalised. Each language has several centroids, found by clustering the vectors of its
sampled texts by cosine. A text gets the language of the centroid with the highest cosine; one that is far from all of
them, measured against what its language's own texts reach, is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, only_own, ship, text_batches

UNKNOWN = "und"
BITS = 13
DIMENSIONS = 1 << BITS
# Odd multipliers that mix code points into one number.
MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
SLICE = 1 << 20
#: Texts of fewer characters say little of their language; they are rejected below this share of what others need.
SHORT, SHORT_SHARE = 60, 0.4


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Is the code point a letter?"""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def code_points(text: str) -> np.ndarray:
    """Lower-case letters of a text as numbers, all else as spaces, with a space at either end."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(letters()[points], points, np.uint32(32))


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed n-grams of the whole text, long ones in slices that overlap by what an n-gram needs."""
    points = code_points(text)
    counts = np.zeros(DIMENSIONS, np.int64)
    shift = np.uint32(32 - BITS)
    for start in range(0, len(points), SLICE):
        a = points[start : start + SLICE + 2]
        one = a * MIX[0]
        two = one[:-1] + (a[1:] * MIX[1])
        three = two[:-1] + (a[2:] * MIX[2])
        some = min(SLICE, len(points) - start)
        for grams in (one, two * MIX[2], three * MIX[1]):
            counts += np.bincount(grams[:some] >> shift, minlength=DIMENSIONS)
    return counts


def has_letter(text: str | None) -> bool:
    return text is not None and bool(letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any())


def normalised(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


@dataclass
class LanguageModel:
    """Languages, weights of n-grams, centroids with the language of each, and the least cosine per language."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    language_of: np.ndarray
    least: np.ndarray

    def vectors(self, texts: list[str]) -> np.ndarray:
        counts = np.stack([gram_counts(t) for t in texts]).astype(np.float32)
        return normalised(np.sqrt(counts) * self.idf)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Language, cosine and whether it is rejected. Ties go to the language that sorts first."""
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        known = [i for i, t in enumerate(texts) if self.languages and has_letter(t)]
        if known:
            cosines = self.vectors([texts[i] for i in known]) @ self.centroids.T
            best = cosines.argmax(axis=1)
            for i, row, c in zip(known, cosines, best):
                language = int(self.language_of[c])
                score = float(min(1.0, max(0.0, row[c])))
                least = float(self.least[language]) * (SHORT_SHARE if len(texts[i]) < SHORT else 1.0)
                out[i] = (self.languages[language], score, score < least)
        return out


def cluster(rows: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Centroids of normalised rows by cosine, started from rows far from each other: always the same for the same rows."""
    k = min(k, len(rows))
    chosen = [int(np.argmax(rows @ normalised(rows.mean(axis=0, keepdims=True))[0]))]
    nearest = rows @ rows[chosen[0]]
    while len(chosen) < k:
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    centroids = rows[chosen]
    for _ in range(rounds):
        owner = (rows @ centroids.T).argmax(axis=1)
        sums = np.stack([rows[owner == j].sum(axis=0) if (owner == j).any() else centroids[j] for j in range(k)])
        centroids = normalised(sums)
    return centroids


def document_frequencies(rows: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts with a letter, and how many of them have each hashed n-gram, over all rows.

    Tasks add up their own counts before the shuffle; place -1 holds the number of texts.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for _, texts in text_batches(batches, "text"):
            for text in texts:
                if has_letter(text):
                    total[:-1] += gram_counts(text) > 0
                    total[-1] += 1
        some = np.flatnonzero(total)
        places = np.where(some == DIMENSIONS, -1, some)
        yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(total[some])], names=["place", "n"])

    found = rows.select("text").mapInArrow(counted, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    seen = np.zeros(DIMENSIONS + 1, np.int64)
    for place, n in found.collect():  # a row per hashed n-gram at most
        seen[place] = n
    return int(seen[-1]), seen[:-1]


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    per_language: int = 300,
    most_languages: int = 2000,
    clusters: int = 4,
    rounds: int = 8,
    margin: float = 0.5,
) -> LanguageModel:
    """Learn from the rows of ``labelled`` that have a language and a letter in their text.

    Centroids are fitted on a bounded sample: about ``per_language`` whole texts of each language, chosen by a hash of
    the text, so that no language crowds out another. Equal texts of a language count once, so a large group of copies
    cannot fill the sample. Document frequencies are counted over all rows. Every language is learned; more than
    ``most_languages`` fail the job. Vectors are made on the executors; what reaches the driver is one vector per sampled
    text and one count per hashed n-gram. ``margin`` times the cosine that all but the lowest hundredth of a language's
    sample reach is the least that is accepted, less for short texts. No rows: no languages.
    """
    ship(labelled.sparkSession)
    rows = labelled.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang"))
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").agg(
        F.count("*").alias("rows"), F.greatest(F.approx_count_distinct("text"), F.lit(1)).alias("texts")
    )
    sizes = sizes.orderBy(F.desc("rows"), "lang").limit(most_languages + 1).collect()
    if len(sizes) > most_languages:
        raise ValueError(f"more than {most_languages} languages to learn")
    if not sizes:
        return LanguageModel([], np.ones(DIMENSIONS, np.float32), np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, int), np.zeros(0))
    shares = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], min(1.0, per_language / r["texts"]))))
    sample = rows.where(hash_share("text", "lang") < F.coalesce(F.element_at(shares, F.col("lang")), F.lit(0.0)))
    sample = sample.dropDuplicates(["lang", "text"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_own()
        for batch, texts in text_batches(batches, "text"):
            kept = [i for i, t in enumerate(texts) if has_letter(t)]
            counts = [gram_counts(texts[i]) for i in kept]
            at = [np.flatnonzero(c) for c in counts]
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([batch.column("lang")[i].as_py() for i in kept], pa.string()),
                    "at": pa.array([i.astype("<u2").tobytes() for i in at], pa.binary()),
                    "n": pa.array([c[i].astype("<u4").tobytes() for c, i in zip(counts, at)], pa.binary()),
                }
            )

    found = sorted((r["lang"], r["at"], r["n"]) for r in sample.mapInArrow(counted, "lang string, at binary, n binary").collect())
    languages = sorted({language for language, _, _ in found})
    counts = np.zeros((len(found), DIMENSIONS), np.float32)
    for row, (_, at, n) in zip(counts, found):
        row[np.frombuffer(at, "<u2")] = np.frombuffer(n, "<u4")
    documents, seen = document_frequencies(rows)
    idf = (np.log((1 + documents) / (1 + seen)) + 1).astype(np.float32)
    vectors = normalised(np.sqrt(counts) * idf)
    owner = np.array([languages.index(language) for language, _, _ in found], int)
    centroids, language_of, least = [], [], []
    for i in range(len(languages)):
        own = vectors[owner == i]
        centroids.append(cluster(own, clusters, rounds))
        language_of += [i] * len(centroids[-1])
        reached = (own @ centroids[-1].T).max(axis=1)
        least.append(margin * float(np.quantile(reached, 0.01)))
    return LanguageModel(
        languages,
        idf,
        np.concatenate(centroids) if centroids else np.zeros((0, DIMENSIONS), np.float32),
        np.array(language_of, int),
        np.array(least),
    )


def predicted(model: LanguageModel, text: Column) -> Column:
    """A struct (lang_pred, score, rejected) for each whole text.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; without any learned language all are.
    """

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        only_own()
        values = [None if t is None else t for t in texts.tolist()]
        found = [x for i in range(0, len(values), 256) for x in model.predict(values[i : i + 256])]
        return pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])

    return predict(text)


def held_out(doc_id: Column) -> Column:
    """Is the document kept from learning? Never for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
