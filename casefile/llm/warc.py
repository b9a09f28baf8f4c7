"""WARC archives: written in parallel, read back sequentially.

Each record is a gzip member of its own. The reader inflates a file piece by piece, frames every
record by its Content-Length and checks its digests, so it holds one record and one piece at a time.
"""

from __future__ import annotations

import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.session import durable, scratch_folder

PIECE = 1 << 18
SMALLEST_REVISIT = 100
READ_SCHEMA = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary, block_ok boolean"
)


class BrokenArchive(ValueError):
    """The file is cut short or does not hold what its headers say."""


def record_bytes(headers: dict[str, str], block: bytes) -> bytes:
    """One record as a gzip member."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}", "", ""]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n") + squeeze.flush()


class _Member:
    """Reads the bytes of one gzip member from an open file."""

    def __init__(self, source: io.RawIOBase, pending: bytes):
        self.source, self.raw, self.ready, self.inflate = source, pending, bytearray(), zlib.decompressobj(31)

    def _more(self) -> bool:
        if self.inflate.eof:
            return False
        if not self.raw:
            self.raw = self.source.read(PIECE)
            if not self.raw:
                raise BrokenArchive("the file ends inside a record")
        try:
            self.ready += self.inflate.decompress(self.raw, PIECE)
        except zlib.error as error:
            raise BrokenArchive(str(error)) from error
        self.raw = self.inflate.unused_data if self.inflate.eof else self.inflate.unconsumed_tail
        return True

    def line(self) -> bytes:
        while (end := self.ready.find(b"\r\n")) < 0:
            if not self._more():
                raise BrokenArchive("a header line has no end")
        got = bytes(self.ready[:end])
        del self.ready[: end + 2]
        return got

    def take(self, n: int) -> bytes:
        while len(self.ready) < n:
            if not self._more():
                raise BrokenArchive("a record is shorter than its Content-Length")
        got = bytes(self.ready[:n])
        del self.ready[:n]
        return got

    def close(self) -> bytes:
        """Skip to the end of the member; what follows it in the file so far."""
        while self._more():
            pass
        if bytes(self.ready) != b"\r\n\r\n":
            raise BrokenArchive("a record is longer than its Content-Length")
        return self.raw


def read_records(source: io.RawIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of every record of an open archive."""
    pending = source.read(PIECE)
    while pending:
        member = _Member(source, pending)
        if not member.line().startswith(b"WARC/"):
            raise BrokenArchive("a record does not begin with WARC/")
        headers = {}
        while line := member.line():
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        block = member.take(int(headers["content-length"]))
        pending = member.close() or source.read(PIECE)
        yield headers, block


def _digest(data: bytes) -> str:
    return "sha256:" + hashlib.sha256(data).hexdigest()


def _header_safe(value: str) -> str:
    """A URL on one line: control characters and spaces at the ends are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in value)


def write_archives(pages: DataFrame, folder: str | None = None, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """(path, records): archives in the shared folder that hold a record per row of `pages`.

    Needs page_id, url and html; a null html is an empty payload. Of rows with equal payloads of
    at least `smallest` bytes those with the smallest page_id become responses and the others
    revisits of it; rows without page_id are responses. A task that is run again writes a new
    file; only files of the returned list, which is itself written out, count.
    """
    folder = folder or scratch_folder(pages.sparkSession)
    payload = F.coalesce(pages["html"].cast("string").cast("binary"), F.lit(b""))
    rows = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    keyed = rows.select("digest", "page_id", F.octet_length("payload").alias("n")).filter(F.col("n") >= smallest)
    firsts = keyed.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("held")).filter("held > 1").select("digest", "first")
    marked = rows.join(firsts, "digest", "left").select("page_id", "url", "payload", "digest", "first")
    run = uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        store.create_dir(root, recursive=True)
        name, records, sink = f"{root}/{run}-{uuid.uuid4().hex}.warc.gz", 0, None
        for batch in batches:
            for page_id, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                revisit = first is not None and page_id is not None and page_id != first
                headers = {
                    "WARC-Type": "revisit" if revisit else "response",
                    "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>",
                    "WARC-Date": "1970-01-01T00:00:00Z",
                    "WARC-Payload-Digest": f"sha256:{digest}",
                    "WARC-Block-Digest": _digest(b"" if revisit else payload),
                    "X-Payload-Length": str(len(payload)),
                }
                if page_id is not None:
                    headers["X-Page-ID"] = str(page_id)
                if url is not None:
                    headers["WARC-Target-URI"] = _header_safe(url)
                if revisit:
                    headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    headers["X-Refers-To-Page-ID"] = str(first)
                sink = sink or store.open_output_stream(name, compression=None)
                sink.write(record_bytes(headers, b"" if revisit else payload))
                records += 1
        if sink is not None:
            sink.close()
            yield pa.RecordBatch.from_pydict({"path": [name], "records": [records]}, pa.schema([("path", pa.string()), ("records", pa.int64())]))

    return durable(marked.mapInArrow(write, "path string, records long"))


def read_archives(files: DataFrame, folder: str, keep_payload: bool = True) -> DataFrame:
    """A row per record of the listed archives; `folder` only tells which store they are in.

    payload_bytes and payload_digest are those of the full payload, also for revisits, whose own
    block is empty (payload null). A block that differs from its digest, or a response whose
    payload does, stops the job: the archive is broken. No files give no rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        types = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("block_ok", pa.bool_())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as source:
                    for headers, block in read_records(source):
                        revisit = headers["warc-type"] == "revisit"
                        if _digest(block) != headers["warc-block-digest"]:
                            raise BrokenArchive(f"{path}: block digest of {headers['warc-record-id']}")
                        digest = headers["warc-payload-digest"]
                        if not revisit and _digest(block) != digest:
                            raise BrokenArchive(f"{path}: payload digest of {headers['warc-record-id']}")
                        page, first = headers.get("x-page-id"), headers.get("x-refers-to-page-id")
                        length = int(headers["x-payload-length"]) if revisit else len(block)
                        payload = block if keep_payload and not revisit else None
                        rows.append((page and int(page), length, digest.removeprefix("sha256:"), headers["warc-type"], first and int(first), headers.get("warc-target-uri"), payload, True))
                        size += len(block)
                        if size > 1 << 24 or len(rows) >= 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], schema=types)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), types, strict=True)], schema=types)

    n = max(files.sparkSession.sparkContext.defaultParallelism, files.count())
    return files.select("path").repartition(n).mapInArrow(read, READ_SCHEMA)
