"""WARC archives with revisit records, and their chunked record table.

Archives are gzip files with one member per record, cut at ``FILE_BYTES``. A record whose payload another record with
a smaller id has already is a ``revisit`` that names it. Payloads go through in pieces of ``CHUNK`` bytes both ways:
reading an archive gives a row per record and chunk, with the digest and size of all bytes so
far, so the row of the last chunk holds the digest of the whole payload and no task ever holds
a whole decompressed record or file.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldtally.llm import shared_files
from fieldtally.llm.scratch import Scratch

CHUNK = 1 << 16
FILE_BYTES = 1 << 30
LEAST_REVISIT = 0  #: payloads of fewer bytes are always written as responses
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


class Member:
    """One gzip member that takes bytes piecewise."""

    def __init__(self, out):
        self.out, self.packer, self.size = out, zlib.compressobj(1, zlib.DEFLATED, 31), 0

    def write(self, data) -> None:
        self._put(self.packer.compress(data))

    def close(self) -> int:
        self._put(self.packer.flush())
        return self.size

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.size += len(data)


def header(record: str, kind: str, url: str | None, digest: str, payload: int, refers: str | None, length: int) -> bytes:
    clean = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{record}>", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {clean}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {payload}",
    ]
    if refers is not None:
        lines.append(f"WARC-Refers-To: <urn:page:{refers}>")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines.append(f"Content-Length: {length}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode()


def base32(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def _write(folder: str) -> Callable:
    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, uri, size, records = None, None, 0, 0
        done = []
        try:
            for batch in batches:
                columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "sha1", "refers_to")]
                payloads = batch.column("payload")
                for i, (page, url, sha1, refers) in enumerate(zip(*columns, strict=True)):
                    if out is not None and size >= FILE_BYTES:
                        out.close()
                        done.append((uri, records, size))
                        out = None
                    if out is None:
                        (uri, out), size, records = shared_files.create(folder, ".warc.gz"), 0, 0
                    body = memoryview(payloads[i].as_buffer()) if payloads[i].is_valid else memoryview(b"")
                    full = len(body)
                    body = body if refers is None else body[:0]
                    member = Member(out)
                    name = "" if page is None else str(page)
                    kind = "response" if refers is None else "revisit"
                    member.write(header(name, kind, url, base32(sha1), full, None if refers is None else str(refers), len(body)))
                    for at in range(0, len(body), CHUNK):
                        member.write(body[at : at + CHUNK])
                    member.write(b"\r\n\r\n")
                    size += member.close()
                    records += 1
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((uri, records, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64())],
            ["file", "records", "bytes"],
        )

    return run_batches


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Writes ``pages`` as archives below ``folder``; returns their manifest (file, records, bytes).

    Of rows with equal payloads (NULL is empty) of at least ``LEAST_REVISIT`` bytes the one with the smallest id is the response. A row that
    has the same id as the response is a response too; NULL ids are revisits unless all are NULL. An empty table gives no file.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    # ids by digest first, without payloads; only digests that occur twice are joined back
    first = rows.select("page_id", "sha1", F.octet_length("payload").alias("n")).where(F.col("n") >= LEAST_REVISIT)
    first = first.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    first = scratch.written(first.select("sha1", "first"), "repeated")
    rows = rows.join(first, "sha1", "left")
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    rows = rows.select("page_id", "url", "payload", "sha1", refers.alias("refers_to"))
    return scratch.written(rows.mapInArrow(_write(folder), "file string, records long, bytes long"), "manifest")


class _Reader:
    """Bytes of a gzip file with many members, decompressed piece by piece."""

    def __init__(self, source):
        self.source, self.unpacker, self.rest, self.ready = source, zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        while True:
            if self.unpacker.eof:
                self.rest = self.unpacker.unused_data or self.rest
                self.unpacker = zlib.decompressobj(31)
            if not self.rest:
                self.rest = self.source.read(CHUNK)
                if not self.rest:
                    return False
            data = self.unpacker.decompress(self.rest, CHUNK)
            self.rest = self.unpacker.unconsumed_tail if not self.unpacker.eof else b""
            if data:
                self.ready += data
                return True

    def line(self) -> bytes | None:
        while (end := self.ready.find(b"\r\n")) < 0:
            if not self._more():
                return None
        line, self.ready = self.ready[:end], self.ready[end + 2 :]
        return line

    def some(self, most: int) -> bytes:
        """At most ``most`` bytes, fewer only at the end of the file."""
        while len(self.ready) < most and self._more():
            pass
        data, self.ready = self.ready[:most], self.ready[most:]
        return data


def record_chunks(source) -> Iterator[tuple[dict[str, str], int, bytes, str, int, bool]]:
    """(headers, chunk number, data, SHA-1 so far in hex, bytes so far, last) of all records of an open archive."""
    reader = _Reader(source)
    while (line := reader.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        headers = {}
        while line := reader.line():
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        left, number, so_far, digest = int(headers["Content-Length"]), 0, 0, hashlib.sha1()
        while True:
            data = reader.some(min(CHUNK, left))
            if left and not data:
                raise ValueError("an archive ends inside a record")
            digest.update(data)
            left, so_far = left - len(data), so_far + len(data)
            yield headers, number, data, digest.hexdigest(), so_far, not left
            number += 1
            if not left:
                break


CHUNKS = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("file", "record_id", "record_type", "url", "refers_to", "declared_digest")]
    + [T.StructField("declared_bytes", T.LongType()), T.StructField("chunk", T.LongType()), T.StructField("data", T.BinaryType())]
    + [T.StructField("sha1_so_far", T.StringType()), T.StructField("bytes_so_far", T.LongType()), T.StructField("last", T.BooleanType())]
)


def _read(with_data: bool) -> Callable:
    def plain(value: str | None) -> str | None:
        return value.removeprefix("<urn:page:").removesuffix(">") if value is not None else None

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}[f.dataType.simpleString()]) for f in CHUNKS])
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                rows = []
                with shared_files.open_file(uri) as source:
                    for h, number, data, digest, so_far, last in record_chunks(source):
                        rows.append({
                            "file": uri, "record_id": plain(h["WARC-Record-ID"]), "record_type": h["WARC-Type"], "url": h["WARC-Target-URI"],
                            "refers_to": plain(h.get("WARC-Refers-To")), "declared_digest": h["WARC-Payload-Digest"].removeprefix("sha1:"),
                            "declared_bytes": int(h["X-Payload-Length"]), "chunk": number, "data": data if with_data else None,
                            "sha1_so_far": digest, "bytes_so_far": so_far, "last": last,
                        })
                        if len(rows) == 256:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run_batches


def read_chunks(manifest: DataFrame, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives in ``manifest``, one row per record and chunk."""
    return manifest.select("file").mapInArrow(_read(with_data), CHUNKS)


def base32_column(hexadecimal):
    """Upper-case base32 of a 40-digit hexadecimal column, with Spark's functions alone."""
    bits = F.lpad(F.conv(F.substring(hexadecimal, 1, 10), 16, 2), 40, "0")
    for at in (11, 21, 31):
        bits = F.concat(bits, F.lpad(F.conv(F.substring(hexadecimal, at, 10), 16, 2), 40, "0"))
    five = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.conv(F.substring(bits, i * 5 + 1, F.lit(5)), 2, 10).cast("int"))
    return F.concat_ws("", F.transform(five, lambda v: F.substring(F.lit(_ALPHABET), v + 1, F.lit(1))))


def page_digests(chunks: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the chunk table's records."""
    last = chunks.where("last")
    own = F.col("record_type") == "response"
    digest = F.when(own, base32_column(F.col("sha1_so_far"))).otherwise(F.col("declared_digest"))
    return last.select(
        F.expr("try_cast(record_id AS BIGINT)").alias("page_id"), F.when(own, F.col("bytes_so_far")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        digest.alias("payload_digest"), "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )
