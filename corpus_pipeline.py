"""The corpus pipeline: documents of a known language and good quality, one of each group of near copies, packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import language_id, packing, quality_classifier, simhash
from tidemark.llm.common import fresh, stored, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents but those far from every language that is learned from them; where none can be learned, all."""
    model = language_id.fit(docs)
    if not model.languages:
        return docs
    found = fresh(docs, "found")
    judged = docs.withColumn(found, language_id.predicted(model, F.col("text")))
    return judged.where(~F.col(f"{found}.rejected")).drop(found)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents but those that the classifier rejects; it learns from their labels."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    found = fresh(docs, "found")
    judged = docs.withColumn(found, quality_classifier.scored(model, F.col("text"), F.col("lang"), F.col("source")))
    return judged.where(F.col(f"{found}.kept")).drop(found)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return simhash.without_copies(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the documents with their sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("quality_classifier", good_quality),
    ("simhash_near_dedup", one_of_each),
    ("best_fit_packing", packed),
]

#: SQL can express none of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
