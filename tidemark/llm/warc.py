"""WARC archives as a chunked record table, written and read back as streams.

An archive is a table of chunks: the bytes ``data`` of the rows of one
``serial`` in the order of ``chunk_no`` are one WARC/1.1 record, and records
after each other are a WARC file (``record_bytes`` puts a record together).  The table is written
with Spark's own writer, so it can lie in any store and survives lost tasks.

A payload is handed on in chunks of at most ``CHUNK_BYTES``; neither writer nor
reader puts a record together.  Digests are fed chunk by chunk.  Records of one
chunk, by far the most, are read where they lie; only those of several chunks
are brought together by record and ordered by chunk.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.runtime import ensure_checkpoint_dir

CHUNK_BYTES = 1 << 20
#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT_BYTES = 0
#: The archives hold no time of their own; a fixed one keeps a rewritten archive equal.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "serial long, record_id string, page_id {kind}, chunk_no int, chunks int, data binary"


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def urn(*parts) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(10).join(map(str, parts)))}>"


def _clean(value) -> str:
    """A header value: line breaks would end the header."""
    return "" if value is None else " ".join(str(value).split())


def _header(kind: str, record: str, url, length: int, payload: str, block: str, first) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {_clean(url)}", f"WARC-Payload-Digest: sha1:{payload}", f"WARC-Block-Digest: sha1:{block}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {urn('page', first, payload)}", f"X-Refers-To-Page: {first}"]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {length}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def records(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_bytes and ``first``: the page whose record holds the same payload, or null.

    Of pages with equal payloads of at least ``least`` bytes the largest
    page_id is the response.  Rows that repeat this page_id are responses too,
    and so are pages without a page_id, as nothing can refer to them or tell
    them apart.  Digests are counted before the shuffle; the pages are then
    looked up by page_id, which is even however many pages share a payload.
    """
    held = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    size = F.octet_length("html")
    marked = held.select("page_id", F.sha1(F.encode("html", "UTF-8")).alias("digest"), size.alias("n")).where((F.col("n") >= least) & F.col("page_id").isNotNull())
    firsts = marked.groupBy("digest", "n").agg(F.max("page_id").alias("first"))
    later = marked.join(firsts, ["digest", "n"]).where(F.col("page_id") < F.col("first"))
    later = later.groupBy("page_id", "digest").agg(F.max("first").alias("first"))
    return held.withColumn("digest", F.sha1(F.encode("html", "UTF-8"))).join(later, ["page_id", "digest"], "left").select("page_id", "url", "html", "first")


def chunked(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of ``records``: the header is in chunk 0, revisits have no payload."""
    def batches(stream: Iterator[pa.RecordBatch]):
        for batch in stream:
            ids, urls, first, serial = batch.column(0), batch.column(1), batch.column(3), batch.column(4)
            html = batch.column(2).cast(pa.binary())
            rows: list[tuple] = []
            held = 0
            for i in range(len(batch)):
                page, payload, revisit = ids[i].as_py(), memoryview(html[i].as_buffer()), first[i].as_py()
                digest = hashlib.sha1(payload)
                sha = base32(digest.digest())
                record = urn("page", page, sha)
                kind, length = ("response", len(payload)) if revisit is None else ("revisit", 0)
                block = sha if kind == "response" else base32(hashlib.sha1(b"").digest())
                head = _header(kind, record, urls[i].as_py(), length, sha, block, revisit)
                head = head.replace(b"\r\nContent-Length", b"\r\nX-Payload-Length: %d\r\nContent-Length" % len(payload), 1)
                many = max(1, -(-length // chunk_bytes))
                for k in range(many):
                    piece = bytes(payload[k * chunk_bytes : min((k + 1) * chunk_bytes, length)])
                    data = (head if k == 0 else b"") + piece + (b"\r\n\r\n" if k == many - 1 else b"")
                    rows.append((serial[i].as_py(), record, page, k, many, data))
                    held += len(data)
                    if held > 4 * chunk_bytes or len(rows) >= 2000:
                        yield emit(rows, ids.type)
                        rows, held = [], 0
            if rows:
                yield emit(rows, ids.type)

    def emit(rows, kind):
        serial, record, page, k, many, data = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(serial, pa.int64()), pa.array(record), pa.array(page, kind), pa.array(k, pa.int32()), pa.array(many, pa.int32()), pa.array(data, pa.binary())], names=["serial", "record_id", "page_id", "chunk_no", "chunks", "data"])

    numbered = pages.select("page_id", "url", "html", "first", F.monotonically_increasing_id().alias("serial"))
    return numbered.mapInArrow(batches, CHUNKS.format(kind=dict(pages.dtypes)["page_id"]))


def write(pages: DataFrame, path: str, least: int = LEAST_REVISIT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write a record for every row of pages (page_id, url, html); other columns are not read."""
    chunked(records(pages, least), chunk_bytes).write.option("compression", "zstd").parquet(path)


class Record:
    """What is known of a record while its chunks pass."""

    def __init__(self, data: bytes):
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        self.fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        self.left, self.digest, self.tail = int(self.fields["Content-Length"]), hashlib.sha1(), b""
        self.feed(rest)

    def feed(self, data: bytes) -> None:
        self.digest.update(data[: self.left])
        taken = min(self.left, len(data))
        self.left -= taken
        self.tail += data[taken:]

    def close(self) -> tuple:
        """payload bytes, payload digest, type, url; raises if the record is not whole."""
        own = base32(self.digest.digest())
        if self.left or self.tail != b"\r\n\r\n" or f"sha1:{own}" != self.fields["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {self.fields.get('WARC-Record-ID')}")
        digest = self.fields["WARC-Payload-Digest"].removeprefix("sha1:")
        kind = self.fields["WARC-Type"]
        first = self.fields.get("X-Refers-To-Page") if kind == "revisit" else None
        return int(self.fields["X-Payload-Length"]), digest, kind, first, self.fields["WARC-Target-URI"]


def read(spark, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and url of every record of an archive.

    The digest of each block is computed while its chunks pass and held
    against the header; a damaged or cut record is an error.  A revisit gives
    the length and digest of the payload it stands for.
    """
    table = spark.read.parquet(path)
    kind = dict(table.dtypes)["page_id"]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]

    def batches(stream: Iterator[pa.RecordBatch]):
        record, owner, done = None, None, []
        type_ = None
        for batch in stream:
            name, page, k, many, data = (batch.column(i) for i in range(5))
            type_ = page.type
            for i in range(len(batch)):
                number = k[i].as_py()
                if number == 0:
                    record, owner, awaited = Record(data[i].as_py()), name[i].as_py(), 1
                elif record is None or owner != name[i].as_py() or number != awaited:
                    raise ValueError(f"chunk {number} of {name[i].as_py()} is out of order")
                else:
                    record.feed(data[i].as_py())
                    awaited += 1
                if number == many[i].as_py() - 1:
                    done.append((page[i].as_py(), *record.close()))
                    record = None
                if len(done) >= 2000:
                    yield emit(done, type_)
                    done = []
        if record is not None:
            raise ValueError(f"record {owner} has no end")
        if done:
            yield emit(done, type_)

    def emit(rows, type_):
        page, size, digest, what, first, url = zip(*rows)
        to = pa.array(first, pa.string()).cast(type_)
        return pa.RecordBatch.from_arrays([pa.array(page, type_), pa.array(size, pa.int64()), pa.array(digest), pa.array(what), to, pa.array(url, pa.string())], names=names)

    schema = f"page_id {kind}, payload_bytes long, payload_digest string, record_type string, refers_to {kind}, url string"
    whole = table.where("chunks = 1").select("serial", "page_id", "chunk_no", "chunks", "data").mapInArrow(batches, schema)
    split = table.where("chunks > 1").select("serial", "page_id", "chunk_no", "chunks", "data")
    split = split.repartition("serial").sortWithinPartitions("serial", "chunk_no").mapInArrow(batches, schema)
    return whole.unionByName(split)


def record_bytes(spark, path: str, record_id: str) -> bytes:
    """The bytes of one record, for those that want a file."""
    rows = spark.read.parquet(path).where(F.col("record_id") == record_id).orderBy("chunk_no").select("data")
    return b"".join(r["data"] for r in rows.toLocalIterator())


def round_trip(pages: DataFrame, path: str | None = None, least: int = LEAST_REVISIT_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write the archive of ``pages`` (by default into the shared folder) and read it back."""
    spark = pages.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write(pages, path, least, chunk_bytes)
    return read(spark, path)
