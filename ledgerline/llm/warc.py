"""Operator 3: WARC archives over a chunked record table.

A record's payload is never held whole beside its row: it becomes rows
(record, chunk number, bytes) of bounded size, each with the running digest of
the payload up to its end.  Records of equal payload are found by digest, then
the chunks are streamed into gzip-per-record archives, and read back as streams.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.shared_files import reading, writing
from ledgerline.llm.tables import spill
from ledgerline.session import fresh_dir

CHUNK_BYTES = 64 << 10
#: Payloads below this many bytes are never revisits.
REVISIT_BYTES = 1000

CHUNK_SCHEMA = "record long, chunk int, page_id long, url string, bytes_so_far long, digest_so_far string, last boolean, data binary"
FILE_SCHEMA = "part int, path string, n_records long"
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _chunks(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = TaskContext.get().partitionId() << 40
        names = ["record", "chunk", "page_id", "url", "bytes_so_far", "digest_so_far", "last", "data"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
        out: list[list] = [[] for _ in names]
        held = 0
        for b in batches:
            ids, urls, payloads = b.column(0), b.column(1), b.column(2)
            for i in range(b.num_rows):
                value = payloads[i]
                payload = memoryview(value.as_buffer()) if value.is_valid else memoryview(b"")
                digest, at, chunk = hashlib.sha1(), 0, 0
                while True:
                    part = payload[at : at + size]
                    digest.update(part)
                    at += len(part)
                    last = at == len(payload)
                    row = (record, chunk, ids[i].as_py(), urls[i].as_py(), at, digest.hexdigest(), last, bytes(part))
                    for column, v in zip(out, row, strict=True):
                        column.append(v)
                    held += len(part) + 200
                    chunk += 1
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)
                        out, held = [[] for _ in names], 0
                    if last:
                        break
                record += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names)

    return run


def chunk_table(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunked record table of ``pages``, written to the shared folder.

    A record number is its task's number and a count; written once, it stays
    the same for everything that follows.
    """
    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(payload_col).cast("binary"))
    return spill(rows.mapInArrow(_chunks(chunk_bytes), CHUNK_SCHEMA), "warc-chunks", "zstd")


def decide_revisits(chunks: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """record, page_id, payload_bytes, payload_digest, record_type, refers_to of each record.

    Of equal payloads of ``revisit_bytes`` or more, the record with the largest
    page_id (then record number; null ids last) is the response.
    """
    records = (chunks.where("last").select("record", "page_id", F.col("bytes_so_far").alias("payload_bytes"), F.col("digest_so_far").alias("payload_digest")))
    order = F.struct(F.col("page_id").isNotNull(), "page_id", "record")
    # counted map-side, then only groups that have copies go on
    groups = (records.where(F.col("payload_bytes") >= revisit_bytes).groupBy("payload_digest", "payload_bytes")
              .agg(F.max(order).alias("w"), F.count(F.lit(1)).alias("n")).where("n > 1")
              .select("payload_digest", "payload_bytes", F.col("w.record").alias("winner"), F.col("w.page_id").alias("winner_id")))
    groups = spill(groups, "warc-copies")
    revisit = F.col("winner").isNotNull() & (F.col("winner") != F.col("record"))
    return (records.join(groups, ["payload_digest", "payload_bytes"], "left")
            .select("record", "page_id", "payload_bytes", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    F.when(revisit, F.col("winner_id")).alias("refers_to")))


def _uri(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _header(kind: str, page_id, url, size: int, digest: str, refers_to) -> tuple[bytes, bytes]:
    """(WARC header, HTTP header); the payload follows the latter."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = len(http) + (size if kind == "response" else 0)
    # line breaks cannot stand in a header field
    target = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_uri(page_id)}", "WARC-Date: 1970-01-01T00:00:00Z"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {target}")
    lines.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_uri(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {body}"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass"), http


def _write(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path, records, packer = f"{root}/part-{part:06d}.warc.gz", 0, None
        with writing(path) as out:
            for b in batches:
                for i in range(b.num_rows):
                    page_id, url, kind, refers_to, size, digest, last = (b.column(c)[i].as_py() for c in range(7))
                    if packer is None:
                        packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                        records += 1
                        for h in _header(kind, page_id, url, size, digest, refers_to):
                            out.write(packer.compress(h))
                    data = b.column(7)[i]
                    if data.is_valid:
                        out.write(packer.compress(memoryview(data.as_buffer())))
                    if last:
                        out.write(packer.compress(b"\r\n\r\n"))
                        out.write(packer.flush())
                        packer = None
        if records:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([path]), pa.array([records], pa.int64())], ["part", "path", "n_records"])

    return run


def write_archives(chunks: DataFrame, decided: DataFrame) -> list[tuple]:
    """Stream the chunk table into archives; (part, path, records) of each, one row per task.

    A revisit has no payload, so its later chunks don't travel.  The chunks of
    a record meet in one task in order; sorting spills, and a record is
    written as its chunks arrive.
    """
    root = fresh_dir(chunks.sparkSession, "warc")
    head = decided.select("record", "record_type", "refers_to", "payload_bytes", "payload_digest")
    kind = F.col("record_type")
    rows = (chunks.select("record", "chunk", "page_id", "url", "last", "data").join(head, "record")
            .where((kind == "response") | (F.col("chunk") == 0))
            .withColumn("last", F.col("last") | (kind == "revisit"))
            .withColumn("data", F.when(kind == "response", F.col("data")))
            .repartition("record").sortWithinPartitions("record", "chunk")
            .select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "last", "data"))
    return sorted(tuple(r) for r in rows.mapInArrow(_write(root), FILE_SCHEMA).collect())


class _Stream:
    """Decompressed bytes of concatenated gzip members, on demand."""

    def __init__(self, source, size: int = 1 << 18):
        self.source, self.size = source, size
        self.engine = zlib.decompressobj(31)
        self.packed, self.plain = b"", b""

    def fill(self) -> bool:
        while True:
            if self.engine.eof:
                self.packed, self.engine = self.engine.unused_data or self.packed, zlib.decompressobj(31)
            packed = self.packed or self.source.read(self.size)
            self.packed = b""
            if not packed:
                return False
            more = self.engine.decompress(packed, 1 << 20)
            self.packed = self.engine.unconsumed_tail
            if more:
                self.plain += more
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (i := self.plain.find(mark)) < 0:
            if not self.fill():
                if self.plain:
                    raise ValueError("archive cut short")
                return None
        head, self.plain = self.plain[:i], self.plain[i + len(mark):]
        return head

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.plain and not self.fill():
                raise ValueError("archive cut short")
            part, self.plain = self.plain[:n], self.plain[n:]
            n -= len(part)
            yield part


def _number(uri: str) -> int | None:
    value = uri.removeprefix("<urn:page:").removesuffix(">")
    return None if value == "null" else int(value)


def read_records(source) -> Iterator[tuple]:
    """Records of an open archive as they stream by; the payload's digest is checked on the way."""
    stream = _Stream(source)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        lines = head.decode("utf-8", "surrogatepass").split("\r\n")
        fields = dict(x.split(": ", 1) for x in lines[1:])
        http = stream.until(b"\r\n\r\n") or b""
        size = int(http.rpartition(b"Content-Length: ")[2])
        left = int(fields["Content-Length"]) - len(http) - 4
        claimed = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        digest = hashlib.sha1()
        for part in stream.take(left):
            digest.update(part)
        response = fields["WARC-Type"] == "response"
        if response and (left != size or digest.hexdigest() != claimed):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
        if b"".join(stream.take(4)) != b"\r\n\r\n":
            raise ValueError("record end missing")
        url = fields.get("WARC-Target-URI")
        url = url if url is None else url.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")
        refers = None if response else _number(fields["WARC-Refers-To"])
        yield _number(fields["WARC-Record-ID"]), size, claimed, fields["WARC-Type"], refers, url


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    for b in batches:
        for path in b.column(1).to_pylist():
            with reading(path) as source:
                rows = []
                for r in read_records(source):
                    rows.append(r)
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def read_archives(spark: SparkSession, files: list[tuple]) -> DataFrame:
    """One row per record of the archives, one archive per task."""
    if not files:
        return spark.createDataFrame([], RECORD_SCHEMA)
    listed = spark.createDataFrame([f[:2] for f in files], "part int, path string")
    return listed.repartitionByRange(len(files), "part").mapInArrow(_read, RECORD_SCHEMA)


def archive_pages(pages: DataFrame, **columns) -> DataFrame:
    """Write every page to archives and read the records back.

    Null payloads are empty; null ids and repeated rows are records of their
    own; other columns are ignored; no pages, no rows.
    """
    chunks = chunk_table(pages, **columns)
    return read_archives(pages.sparkSession, write_archives(chunks, decide_revisits(chunks)))
