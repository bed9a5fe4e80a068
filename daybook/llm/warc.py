"""WARC archives: writing captures, reading records, assembling transactions.

A capture is three records: the response (or a revisit, if an earlier page has the
same payload), the request, and metadata with the page's key. The latter two name
the first in WARC-Concurrent-To, which is how they are put together again.

Every record is a gzip member of its own (several if it is very large), so that a reader
may stop or start at any. Archives are written by Spark's own text writer, so a failed task
leaves nothing behind. A line of it is a chunk of whole records of at most `chunk_bytes`, or one
larger record, and a file holds at most `chunks_per_file` of them, so files are bounded by their
bytes. The writer ends each line with a zero byte, which is the last byte of the
chunk's last member: the highest of its size, below 16 MB. Reading takes a file at a
time and unpacks it record by record.
"""

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from daybook.llm.common import column, ship_library, stored

_BREAK = "\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Rows handed to Spark at a time while reading.
_BATCH_RECORDS = 512
_BATCH_BYTES = 8 << 20
CHUNK_BYTES = 4 << 20
# A member of fewer bytes ends with a zero byte.
_MEMBER_BYTES = (1 << 24) - 1

RECORD_SCHEMA = (
    "record_id string, type string, date string, uri string, concurrent_to string, "
    "refers_to string, fields map<string,string>, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


def _urn(kind: str, row: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, repr((kind, row, digest)))}>"


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, without the algorithm's name."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers if v is not None)]
    lines.append(f"Content-Length: {len(block)}")
    return _BREAK.join([*lines, "", ""]).encode() + block + (_BREAK * 2).encode()


def members(record: bytes) -> bytes:
    """The record as one gzip member, or as many as keep each below _MEMBER_BYTES."""
    parts = []
    for start in range(0, len(record), _MEMBER_BYTES):
        packer = zlib.compressobj(wbits=31)
        parts += packer.compress(record[start : start + _MEMBER_BYTES]), packer.flush()
    return b"".join(parts)


def _one_line(value: str | None) -> str | None:
    return None if value is None else value.replace("\r", "%0D").replace("\n", "%0A")


def capture_records(
    key: str | None, uri: str | None, html: str, row: int, first_row: int, is_first: bool, date: str
) -> Iterator[bytes]:
    """The three records of a page; a revisit refers to the response of first_row."""
    payload = html.encode()
    content, digest = hashlib.sha256(payload).hexdigest(), payload_digest(payload)
    uri = _one_line(uri)
    own = _urn("response", row, content)
    head = _BREAK.join(
        ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
        + [f"Content-Length: {len(payload)}", "", ""]
    ).encode()
    common = [("WARC-Date", date), ("WARC-Target-URI", uri)]
    described = [("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha1:{digest}")]
    http = ("Content-Type", "application/http; msgtype=response")
    if is_first:
        yield _record([("WARC-Type", "response"), *described, http], head + payload)
    else:
        refers = [("WARC-Refers-To", _urn("response", first_row, content)), ("WARC-Profile", _PROFILE)]
        yield _record([("WARC-Type", "revisit"), *described, *refers, http], head)
    together = [*common, ("WARC-Concurrent-To", own)]
    place = (uri or "").partition("://")[2]
    host, _, path = place.partition("/")
    yield _record(
        [("WARC-Type", "request"), ("WARC-Record-ID", _urn("request", row, content)), *together]
        + [("Content-Type", "application/http; msgtype=request")],
        _BREAK.join([f"GET /{path} HTTP/1.1", f"Host: {host}", "", ""]).encode(),
    )
    yield _record(
        [("WARC-Type", "metadata"), ("WARC-Record-ID", _urn("metadata", row, content)), *together]
        + [("Content-Type", "application/warc-fields")],
        b"" if key is None else f"page-key: {key}{_BREAK}".encode(),
    )


def write_warc(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    min_revisit_bytes: int = 0,
    chunk_bytes: int = CHUNK_BYTES,
    chunks_per_file: int = 8,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """Write gzipped archives to path, which must not exist yet.

    Of pages with equal payloads of at least min_revisit_bytes the one with the
    smallest key is a response and the others revisit it; rows that repeat the smallest key
    are responses each. A null html is an empty payload. A null key is larger than any
    other, a null url leaves the target out. Other columns are ignored. An empty table
    gives an archive without records.
    """
    rows = pages.select(
        column(key).alias("key"),
        column(url).cast("string").alias("url"),
        F.coalesce(column(html), F.lit("")).alias("html"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("content", F.unhex(F.sha2("html", 256)))
    # A task run again must give a row the same number. Scans of files do, and both
    # uses of rows below are planned together; what comes out of a shuffle is stored first.
    if "Exchange" in pages._jdf.queryExecution().executedPlan().toString():
        rows = stored(rows)
    # Only digests and keys are grouped; the join then lets Spark split a payload
    # that very many pages share.
    smallest = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "url", "row"))
    first = rows.groupBy("content").agg(smallest.alias("first"))
    is_first = F.col("key").eqNullSafe(F.col("first.key")) | (
        F.octet_length("html") < min_revisit_bytes
    )
    planned = rows.join(first, "content").select(
        F.col("key").cast("string").alias("key"),
        "url",
        "html",
        "row",
        F.col("first.row").alias("first_row"),
        is_first.alias("is_first"),
    )

    ship_library(pages.sparkSession)

    def chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found, size = [], 0
        for batch in batches:
            for page in batch.itertuples(index=False):
                name = None if pd.isna(page.key) else page.key
                uri = None if pd.isna(page.url) else page.url
                for record in capture_records(
                    name, uri, page.html, page.row, page.first_row, page.is_first, date
                ):
                    packed = members(record)
                    if size + len(packed) > chunk_bytes and found:
                        yield pd.DataFrame({"value": [b"".join(found)[:-1]]})
                        found, size = [], 0
                    found.append(packed)
                    size += len(packed)
        if found:
            yield pd.DataFrame({"value": [b"".join(found)[:-1]]})

    (
        planned.mapInPandas(chunks, "value binary")
        .select(F.col("value").cast("string"))
        .write.option("lineSep", "\0")
        .option("compression", "none")
        .option("maxRecordsPerFile", chunks_per_file)
        .text(path)
    )


def parse_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record, plain or gzipped."""
    stream = io.BytesIO(archive)
    if archive[:2] == b"\x1f\x8b":
        stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record here: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError(f"archive ends within record {headers.get('warc-record-id')}")
        yield headers, block


def _fields(block: bytes) -> dict[str, str]:
    found = {}
    for line in block.decode("utf-8", "replace").split("\n"):
        name, colon, value = line.strip("\r").partition(":")
        if colon:
            found[name.strip().lower()] = value.strip()
    return found


def describe_record(headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    """A row of RECORD_SCHEMA. Digest and size are those of the full payload."""
    kind = headers.get("warc-type")
    fields, payload = {}, block
    size, digest = None, None
    if kind in ("response", "revisit"):
        head, _, payload = block.partition(b"\r\n\r\n")
        fields = _fields(head)
        if kind == "response":
            size, digest = len(payload), payload_digest(payload)
        else:
            size = int(fields["content-length"]) if "content-length" in fields else None
            digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
            payload = b""
    elif kind == "metadata":
        fields, payload = _fields(block), b""
    return (
        headers.get("warc-record-id"),
        kind,
        headers.get("warc-date"),
        headers.get("warc-target-uri"),
        headers.get("warc-concurrent-to"),
        headers.get("warc-refers-to"),
        fields,
        size,
        digest,
        payload if with_payload else None,
    )


def read_warc(
    spark: SparkSession, path: str, with_payload: bool = True, glob: str = "part-*"
) -> DataFrame:
    """One row per record of the archives below path.

    A file is one value of a row here, so a task needs memory for one file; files that write_warc
    made are bounded by their bytes.
    """
    ship_library(spark)
    names = [part.strip().split(" ")[0] for part in RECORD_SCHEMA.replace("string,string", "").split(",")]

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows, size = [], 0
                for headers, block in parse_records(content):
                    rows.append(describe_record(headers, block, with_payload))
                    size += len(block) if with_payload else 0
                    if len(rows) >= _BATCH_RECORDS or size > _BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("content").mapInPandas(records, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: response, request and metadata as nested columns.

    Records of other types are left out. A capture without request or metadata has
    null there. A record listed twice under one id counts once.
    """
    def of(name: str, *kinds: str) -> DataFrame:
        found = records.where(F.col("type").isin(*kinds)).dropDuplicates(["record_id"])
        link = "record_id" if name == "response" else "concurrent_to"
        return found.select(F.col(link).alias("capture"), F.struct("*").alias(name))

    return (
        of("response", "response", "revisit")
        .join(of("request", "request"), "capture", "left")
        .join(of("metadata", "metadata"), "capture", "left")
    )


def warc_roundtrip(
    pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", **options
) -> DataFrame:
    """Write pages as archives, read them back, and return one row per capture.

    Columns: the key, payload_bytes, payload_digest, record_type, and refers_to,
    the key of the response that a revisit repeats. Each row is a capture, also one that is
    repeated exactly. Very long pages are one record each; an empty table gives no rows.
    """
    write_warc(pages, path, key, url, html, **options)
    kind = pages.select(column(key)).schema[0].dataType
    records = stored(read_warc(pages.sparkSession, path, with_payload=False))
    captures = assemble(records).select(
        "capture",
        F.col("metadata.fields")["page-key"].cast(kind).alias("key"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("refers"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
    )
    responses = captures.where("record_type = 'response'")
    originals = responses.select(F.col("capture").alias("refers"), F.col("key").alias("refers_to"))
    revisits = captures.where("record_type = 'revisit'").join(originals, "refers", "left")
    columns = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return (
        responses.withColumn("refers_to", F.lit(None).cast(kind))
        .select(*columns)
        .unionByName(revisits.select(*columns))
        .withColumnRenamed("key", key)
    )
