from __future__ import annotations

import pytest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def documents(spark: SparkSession):
    """Makes a table of documents from (doc_id, text) or (doc_id, text, lang, source), with columns that may clash."""

    def made(*rows) -> DataFrame:
        schema = "doc_id long, text string, lang string, source string, n_chars long, f string, quality string, score double"
        full = [(r + (None, None))[:4] + (None, "f", "q", 1.0) for r in (tuple(r) for r in rows)]
        return spark.createDataFrame(full, T.StructType.fromDDL(schema))

    return made
