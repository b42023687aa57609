"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: its lineage ends there and it is computed once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hash_share(*columns: str):
    """A number in [0, 1) that is a fixed function of the columns, to sample rows alike on every run."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) / float(1 << 30)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_batches(
    batches: Iterator[pa.RecordBatch], column: str, most_rows: int = 512, most_bytes: int = 4 << 20
) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches with the column's values, small enough that the work on one slice stays in bounds.

    Only one slice of a batch is held as Python values at a time; at the end of a task, freed memory goes back.
    """
    for batch in batches:
        values = batch.column(column)
        length = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
        lengths = pc.fill_null(length(values), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            size += n
            if i + 1 - start >= most_rows or size >= most_bytes or i + 1 == len(lengths):
                part = batch.slice(start, i + 1 - start)
                yield part, part.column(column).to_pylist()
                start, size = i + 1, 0
    give_back()


def give_back() -> None:
    """Hand memory that this process has freed back to the system; workers live on after their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


_KEPT: list = []


def kept_by_worker(function: Callable) -> Callable:
    """Mark a function with a cache that outlives the tasks of a worker; see ``only_own``."""
    _KEPT.append(function)
    return function


def only_own() -> None:
    """Drop what earlier tasks of other kinds left in this worker. For tasks that use none of these caches."""
    if any(f.cache_info().currsize for f in _KEPT):
        for function in _KEPT:
            function.cache_clear()
        give_back()


#: What a word is, here and in the SQL next to it.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the functions that run there in Python."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-py-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)
