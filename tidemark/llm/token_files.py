"""Files of token ids with one shared zstandard dictionary.

A dictionary is trained on serialised id arrays of sampled documents. Each document is compressed by itself, so a short
one can be read alone, yet gains from the dictionary. A file holds: a header with the hash of the dictionary, the
compressed documents, an index of (doc_id, offset, bytes, ids), and a footer that says where the index begins.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import scratch_path

from .common import hash_share, ship, shuffle_partitions, stored, text_batches
from .files import attempt_path, output, random_access
from .tokens import encoder

# Fixed values of the format: magic numbers, layout of header, index rows and footer.
MAGIC, END = b"TKZ1", b"1ZKT"
HEADER = struct.Struct("<4sB32s")
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("offset", "<u8"), ("bytes", "<u4"), ("ids", "<u4")])
FOOTER = struct.Struct("<QQ4s")
FILE_BYTES = 1 << 30


def packed(ids: bytes, width: int) -> bytes:
    """Unsigned 32-bit ids in ``width`` bytes each; ids that do not fit are refused."""
    if width == 4:
        return ids
    numbers = np.frombuffer(ids, "<u4")
    if len(numbers) and int(numbers.max()) >= 1 << 8 * width:
        raise ValueError(f"id {numbers.max()} does not fit {width} bytes")
    return numbers.astype("<u2").tobytes()


def id_width(tokenizer: str, end_id: int = 0) -> int:
    """Bytes that hold every id of the vocabulary and the end id: 2 or 4."""
    most = max(encoder(tokenizer, True).tokenizer.get_vocab_size() - 1, end_id)
    return 2 if most < 1 << 16 else 4


def unpacked(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, "<u2").astype("<u4").tobytes()


def train_dictionary(documents: DataFrame, tokenizer: str, width: int, rows: int = 1500, size: int = 64 << 10) -> bytes:
    """A dictionary from about ``rows`` whole documents chosen by a hash; empty where there is too little to learn from.

    The sample is bounded by ``rows``; nothing else is trained on it.
    """
    ship(documents.sparkSession)
    texts = documents.select("text").where(F.col("text").isNotNull())
    total = texts.count()
    if not total:
        return b""

    def serialised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True).encode
        for _, values in text_batches(batches, "text"):
            data = [packed(ids, width) for ids in encode(values)]
            yield pa.RecordBatch.from_arrays([pa.array(data, pa.binary())], names=["data"])

    sample = texts.where(hash_share("text") < min(1.0, rows / total)).limit(4 * rows)
    found = sorted(r["data"] for r in sample.mapInArrow(serialised, "data binary").collect())
    try:
        return zstandard.train_dictionary(size, [d for d in found if d]).as_bytes()
    except zstandard.ZstdError:  # too few or too short samples
        return b""


def compressor(dictionary: bytes, level: int) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=level, dict_data=shared, write_content_size=True)


def decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


class FileWriter:
    def __init__(self, path: str, dictionary: bytes, width: int, level: int) -> None:
        self.path, self.width = path, width
        self.stream, self.packer = output(path), compressor(dictionary, level)
        self.stream.write(HEADER.pack(MAGIC, width, hashlib.sha256(dictionary).digest()))
        self.size, self.ids, self.index = HEADER.size, 0, []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        data = self.packer.compress(packed(ids, self.width))
        self.stream.write(data)
        self.index.append((doc_id or 0, doc_id is None, self.size, len(data), len(ids) // 4))
        self.size += len(data)
        self.ids += len(ids) // 4

    def close(self) -> None:
        index = np.array(self.index, INDEX)
        self.stream.write(index.tobytes())
        self.stream.write(FOOTER.pack(self.size, len(index), END))
        self.stream.close()


class TokenFile:
    """Random access to one file: ``index`` and the ids of its k-th document."""

    def __init__(self, path: str, dictionary: bytes) -> None:
        self.file, self.path = random_access(path), path
        magic, self.width, known = HEADER.unpack(self.file.read_at(HEADER.size, 0))
        self.at, count, end = FOOTER.unpack(self.file.read_at(FOOTER.size, self.file.size() - FOOTER.size))
        if magic != MAGIC or end != END:
            raise ValueError(f"{path} is not a whole token file")
        if known != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} was written with another dictionary")
        self.index = np.frombuffer(self.file.read_at(count * INDEX.itemsize, self.at), INDEX)
        self.unpacker = decompressor(dictionary)

    def ids(self, k: int) -> bytes:
        row = self.index[k]
        data = self.file.read_at(int(row["bytes"]), int(row["offset"]))
        return self.decoded(data, row)

    def decoded(self, data: bytes, row: np.void) -> bytes:
        ids = unpacked(self.unpacker.decompress(data), self.width)
        if len(ids) != 4 * int(row["ids"]):
            raise ValueError(f"{self.path}: the index and a document differ")
        return ids

    def all(self) -> Iterator[tuple[np.void, bytes]]:
        """Every document in order, read in long stretches."""
        k, stretch = 0, 4 << 20
        offsets, sizes = self.index["offset"].astype(np.int64), self.index["bytes"].astype(np.int64)
        while k < len(self.index):
            last = max(k + 1, int(np.searchsorted(offsets, offsets[k] + stretch)))
            begin = int(offsets[k])
            data = self.file.read_at(int(offsets[last - 1] + sizes[last - 1]) - begin, begin)
            for i in range(k, last):
                at = int(offsets[i]) - begin
                yield self.index[i], self.decoded(data[at : at + int(sizes[i])], self.index[i])
            k = last


def write(
    documents: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    width: int | None = None,
    level: int = 3,
    file_bytes: int = FILE_BYTES,
) -> tuple[DataFrame, bytes]:
    """Write the ids of every document in ascending doc_id order; the files in order, and the dictionary.

    Files: file, part, seq, docs, ids. ``documents``: doc_id (a whole number) and text, null texts as empty, null ids
    first, repeated rows each. The order is made by ranges of doc_id, then of a hash of the text and a row number, so that
    rows of one id are split as well; a range is one task, which encodes and writes. ``width`` is the bytes of an id, by
    default as many as the vocabulary needs.
    """
    spark = documents.sparkSession
    ship(spark)
    width = width or id_width(tokenizer, end_id)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dictionary = train_dictionary(rows, tokenizer, width)
    path = f"{folder}/{hashlib.sha256(dictionary).hexdigest()}.dictionary"
    with output(path) as stream:
        stream.write(dictionary)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = encoder(tokenizer, True).encode
        end = np.array([end_id], "<u4").tobytes()
        writer, seq = None, 0

        def closed() -> pa.RecordBatch:
            writer.close()
            values = {"file": writer.path, "part": part, "seq": seq, "docs": len(writer.index), "ids": writer.ids}
            return pa.RecordBatch.from_pydict({k: pa.array([v]) for k, v in values.items()})

        for batch, texts in text_batches(batches, "text"):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                if writer is None:
                    writer = FileWriter(attempt_path(folder, ".tokens"), dictionary, width, level)
                writer.add(doc_id, ids + end)
                if writer.size >= file_bytes:
                    yield closed()
                    writer, seq = None, seq + 1
        if writer is not None:
            yield closed()

    numbered = rows.withColumns({"h": F.xxhash64("text"), "n": F.monotonically_increasing_id()})
    order = ("doc_id", "h", "n")
    ordered = numbered.repartitionByRange(max(1, shuffle_partitions(spark)), *order).sortWithinPartitions(*order)
    files = ordered.select("doc_id", "text").mapInArrow(work, "file string, part long, seq long, docs long, ids long")
    return stored(files, "token-files"), dictionary


def read(spark: SparkSession, files: DataFrame, dictionary: bytes) -> DataFrame:
    """Every document of the files: doc_id, start (ids before it in all files), n_tokens, ids (as bytes), ids_crc32."""
    ship(spark)
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("base", F.coalesce(F.sum("ids").over(before), F.lit(0)))  # a row per file
    placed = stored(placed.select("file", "base"), "token-file-starts")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                rows, size = [], 0
                for row, ids in TokenFile(file, dictionary).all():
                    n = len(ids) // 4
                    rows.append((None if row["null"] else int(row["doc_id"]), base, n, ids, zlib.crc32(ids)))
                    base += n
                    size += len(ids)
                    if size >= 8 << 20 or len(rows) >= 5000:
                        yield made(rows)
                        rows, size = [], 0
                if rows:
                    yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64())
        names = ["doc_id", "start", "n_tokens", "ids", "ids_crc32"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    spread = placed.repartition(max(1, min(files.count(), 100_000)), "file")
    return spread.mapInArrow(work, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")


def round_trip(documents: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Every document written to token files in the shared scratch folder and read back."""
    spark = documents.sparkSession
    files, dictionary = write(documents, scratch_path(spark, "tokens"), tokenizer, end_id)
    return read(spark, files, dictionary)
