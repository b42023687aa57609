"""WARC archives: a record per page, one gzip member per record, written and read by tasks.

The reader goes through a file from start to end: members are inflated chunk by chunk, headers end at the first empty
line, the content length frames the block, and block and payload digests are verified.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import scratch_path

from .common import ship, stored
from .files import attempt_path, chunks, output

# Names and values of the format.
VERSION = b"WARC/1.0"
END_OF_RECORD = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_DATE = "2000-01-01T00:00:00Z"
HTTP_TYPE = "application/http;msgtype=response"

#: Bytes after which a task begins a new file.
FILE_BYTES = 1 << 30


def digest(data: bytes) -> str:
    """Upper-case base32 SHA-1, without a prefix."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def record_id(page_id) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """A response record with its payload, or a revisit of the page ``refers_to`` without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", RECORD_DATE),
        ("WARC-Target-URI", clean(url or "")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Content-Type", HTTP_TYPE),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode("utf-8", "surrogatepass") + b"\r\n"
    return head + block + END_OF_RECORD


def member(data: bytes, level: int = 6) -> bytes:
    """One gzip member."""
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


class WarcError(ValueError):
    """An archive that breaks the format or a digest."""


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def members(data: Iterable[bytes]) -> Iterator[bytes]:
    """The inflated gzip members of a file given in chunks."""
    packer, parts, begun = zlib.decompressobj(31), [], False
    for chunk in data:
        while chunk:
            begun = True
            parts.append(packer.decompress(chunk))
            chunk = b""
            if packer.eof:
                chunk = packer.unused_data
                yield b"".join(parts)
                packer, parts, begun = zlib.decompressobj(31), [], False
    if begun:
        raise WarcError("the archive ends within a member")


def header_lines(data: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in data.decode("utf-8", "surrogatepass").split("\r\n") if line)
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parsed(data: bytes) -> Record:
    """A record from an inflated member; its frame and digests are verified."""
    head, found, rest = data.partition(b"\r\n\r\n")
    first, _, lines = head.partition(b"\r\n")
    if not found or first != VERSION:
        raise WarcError(f"no record starts with {first[:40]!r}")
    headers = header_lines(lines)
    length = int(headers.get("content-length", "-1"))
    block, end = rest[:length], rest[length:]
    if length < 0 or len(block) != length or end != END_OF_RECORD:
        raise WarcError(f"{headers.get('warc-record-id')}: the content length does not frame the block")
    if headers.get("warc-block-digest") != f"sha1:{digest(block)}":
        raise WarcError(f"{headers.get('warc-record-id')}: the block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    out = Record(headers, block, header_lines(http.partition(b"\r\n")[2]), payload)
    if headers["warc-type"] == "response" and headers.get("warc-payload-digest") != f"sha1:{digest(payload)}":
        raise WarcError(f"{headers.get('warc-record-id')}: the payload digest differs")
    return out


def records(data: Iterable[bytes]) -> Iterator[Record]:
    for inflated in members(data):
        yield parsed(inflated)


def with_responses(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) as page_id, url, payload and refers_to.

    Among equal payloads of ``least_bytes`` or more the largest page_id is the response, others refer to it; pages that
    share that page_id are all responses. The payloads meet as digests and lengths, so no shuffle carries html.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    key = F.sha1("payload")
    rows = rows.withColumn("same", F.when(F.octet_length("payload") >= least_bytes, key))
    heads = rows.groupBy("same").agg(F.max("page_id").alias("head"), F.count("*").alias("n"))
    heads = stored(heads.where("n > 1 and same is not null and head is not null").select("same", "head"), "warc-heads")
    ids = rows.select("page_id", "same").join(heads, "same").where(~F.col("page_id").eqNullSafe(F.col("head")))
    ids = stored(ids.select("page_id", "same", "head").distinct(), "warc-revisits")
    joined = rows.join(ids.withColumnRenamed("page_id", "id2").withColumnRenamed("same", "same2"),
                       F.col("page_id").eqNullSafe(F.col("id2")) & (F.col("same") == F.col("same2")), "left")
    return joined.select("page_id", "url", "payload", F.col("head").alias("refers_to"))


def write(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 6, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` below ``folder``; the list of files: file, records, bytes.

    Null html counts as an empty payload, a null url as an empty target. An empty table gives no file.
    """
    spark = pages.sparkSession
    ship(spark)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream, path, count, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            stream.close()
            return pa.RecordBatch.from_pydict(
                {"file": [path], "records": pa.array([count], pa.int64()), "bytes": pa.array([size], pa.int64())}
            )

        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "payload", "refers_to"))
            for values in zip(*columns):
                if stream is None:
                    path, count, size = attempt_path(folder, ".warc.gz"), 0, 0
                    stream = output(path)
                data = member(record(*(v.as_py() for v in values)), level)
                stream.write(data)
                count, size = count + 1, size + len(data)
                if size >= file_bytes:
                    yield closed()
                    stream = None
        if stream is not None:
            yield closed()

    rows = with_responses(pages, least_bytes)
    return stored(rows.mapInArrow(work, "file string, records long, bytes long"), "warc-files")


def read(spark: SparkSession, files: DataFrame, id_type: str = "bigint") -> DataFrame:
    """Records of the listed files: page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to.

    A revisit has a null payload; its length and digest are those it declares.
    """
    ship(spark)

    def page(name: str | None) -> str | None:
        value = name.removeprefix("<urn:page:").removesuffix(">") if name else None
        return None if value == "None" else value

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to")
        types = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.string())

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))

        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows, size = [], 0
                for r in records(chunks(file)):
                    kind = r.headers["warc-type"]
                    own = kind == "response"
                    rows.append(
                        (
                            page(r.headers["warc-record-id"]),
                            r.headers.get("warc-target-uri"),
                            r.payload if own else None,
                            len(r.payload) if own else int(r.http["content-length"]),
                            r.headers["warc-payload-digest"].removeprefix("sha1:"),
                            kind,
                            page(r.headers.get("warc-refers-to")),
                        )
                    )
                    size += len(r.block)
                    if len(rows) >= 1000 or size >= 8 << 20:
                        yield made(rows)
                        rows, size = [], 0
                if rows:
                    yield made(rows)

    found = files.select("file").repartition(max(1, min(files.count(), 100_000)), "file").mapInArrow(
        work,
        "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string",
    )
    return found.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Every page written to archives in the shared scratch folder and read back."""
    spark = pages.sparkSession
    files = write(pages, scratch_path(spark, "warc"), least_bytes)
    return read(spark, files, pages.schema["page_id"].dataType.simpleString())
