"""WARC archives: writer, and sequential reader.

An archive is a row of gzip members, one for each record.  The reader goes
through it once with incremental decompression: it holds one record at a time,
takes its length from Content-Length, and checks the block and payload digests
and that each member ends with its record.

Of pages with equal payloads the one with the largest page_id is stored; the
others become revisit records that refer to it.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundalake.llm.common import cut, fresh_path

MIN_REVISIT = 1000
ARCHIVE_BYTES = 64 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = 1 << 18
_PENDING = 8 << 20
_END = b"\r\n\r\n"


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None, is_revisit: bool) -> bytes:
    """One record, not compressed.  A revisit has the HTTP header, which tells the payload's size, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,#%[]!~*()-._')}"] if url is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}",
        *([f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"] if is_revisit else []),
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + _END + block + _END


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class Broken(ValueError):
    """An archive that does not say what it should."""


class Reader:
    """The records of an open archive, one after the other: (headers, block)."""

    def __init__(self, source) -> None:
        self.source, self.raw = source, b""

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        while self.raw or self._more():
            yield self._record()

    def _more(self) -> bool:
        self.raw = self.source.read(_READ)
        return bool(self.raw)

    def _record(self) -> tuple[dict[str, str], bytes]:
        z, data = zlib.decompressobj(31), bytearray()

        def fill(n: int) -> None:
            while len(data) < n:
                if z.eof or (not self.raw and not z.unconsumed_tail and not self._more()):
                    raise Broken("an archive ends within a record")
                data.extend(z.decompress(z.unconsumed_tail or self.raw, max(n - len(data), 4096)))
                self.raw = z.unused_data if z.eof else b"" if z.unconsumed_tail else b""

        head = -1
        while head < 0:
            fill(len(data) + 1)
            head = data.find(_END, 0)
        lines = data[:head].decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise Broken(f"no record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start, size = head + len(_END), int(headers["content-length"])
        fill(start + size + len(_END))
        if bytes(data[start + size :]) != _END:
            raise Broken("a record's length is not its Content-Length")
        while not z.eof:  # the member's trailer
            if not z.unconsumed_tail and not self.raw and not self._more():
                raise Broken("a member is cut off")
            if z.decompress(z.unconsumed_tail or self.raw, 1):
                raise Broken("a member holds more than a record")
            self.raw = z.unused_data if z.eof else b""
        self.raw = z.unused_data
        return headers, bytes(data[start : start + size])


def parse(headers: dict[str, str], block: bytes) -> dict:
    """Fields of a record, after its digests are checked."""
    if f"sha1:{hashlib.sha1(block).hexdigest()}" != headers["warc-block-digest"]:
        raise Broken(f"wrong block digest in {headers['warc-record-id']}")
    http, _, payload = block.partition(_END)
    size = int(next(x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")))
    digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
        raise Broken(f"wrong payload digest in {headers['warc-record-id']}")
    number = lambda x: int(x) if (x := x.removeprefix("<urn:page:").removesuffix(">")) else None
    return {"page_id": number(headers["warc-record-id"]), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": number(headers["warc-refers-to"]) if "warc-refers-to" in headers else None, "payload": payload if kind == "response" else None}


_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _write(batches: Iterator[pa.RecordBatch], folder: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    store, base = fs.FileSystem.from_uri(folder)
    path, out, done, n = "", None, [], 0
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if out is None:  # a name of its own: what a failed attempt leaves is never read
                path, n = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                store.create_dir(base)
                out = store.open_output_stream(path, compression=None)
            page_id, url, html, digest, refers_to, is_revisit = row
            payload = (html or "").encode()
            out.write(member(record(page_id, url, payload, len(payload), digest, refers_to, is_revisit)))
            n += 1
            if out.tell() >= archive_bytes:
                out.close()
                done.append((path, n))
                out = None
    if out is not None:
        out.close()
        done.append((path, n))
    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())], names=["path", "records"])


def write(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Archives of ``pages`` in ``folder``; gives their manifest (path, records).

    The manifest is written once its archives are complete and names only
    those, so tasks may be repeated or run twice.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", "html", F.sha1(html.cast("binary")).alias("digest"), F.octet_length(html).alias("size"))
    groups = rows.filter(F.col("size") >= min_revisit).groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("refers_to")).filter("n > 1").drop("n")
    typed = rows.join(groups, "digest", "left").withColumn("is_revisit", F.coalesce((F.col("size") >= min_revisit) & ~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull(), F.lit(False)))
    return cut(typed.select("page_id", "url", "html", "digest", "refers_to", "is_revisit").mapInArrow(lambda it: _write(it, folder, archive_bytes), "path string, records long"))


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    store, _ = fs.FileSystem.from_uri(folder)
    for batch in batches:
        for path in batch.column(0).to_pylist():
            with store.open_input_stream(path, compression=None) as source:
                rows, held = [], 0
                for headers, block in Reader(source):
                    rows.append(parse(headers, block))
                    held += len(block) + 200
                    if held > _PENDING:
                        yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _SCHEMA)


def read(manifest: DataFrame, folder: str) -> DataFrame:
    """The records of the archives of a manifest, with their payloads (null for a revisit); a broken archive raises Broken."""
    n = max(1, manifest.count())
    return manifest.select("path").repartition(n).mapInArrow(lambda it: _read(it, folder), "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame) -> DataFrame:
    """``pages`` written to archives in the shared folder and read back, a record for each row.

    A null html is an empty payload; a very long one is a record like any other.
    Repeated rows are records of their own, and an empty table gives an empty
    result.  Payloads under ``MIN_REVISIT`` bytes are
    always stored.  Rows that share the largest page_id of their group are all
    stored; null page_ids are stored too if the whole group has none, and
    otherwise revisit.  Other columns are ignored.
    """
    folder = fresh_path(pages.sparkSession, "warc")
    return read(write(pages, folder), folder)
