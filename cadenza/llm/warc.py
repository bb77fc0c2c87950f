"""WARC archives: one gzip member per record, read back sequentially.

``write`` gives every page a record.  Pages of equal payload of at least ``REVISIT_BYTES`` bytes
share one response, that of the largest page id; the others are revisits without payload.
``read`` opens each archive as a stream, inflates member by member, frames the block by its
content length and verifies block and payload digests.  Neither holds more than one record.

Archives lie in the shared folder, one or more per task under a name of that attempt; the
manifest lists those of attempts that succeeded, so a repeated task leaves no doubt.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm.common import columns, ship
from cadenza.session import shared_folder, stored

REVISIT_BYTES = 1000
FILE_BYTES = 256 << 20
CHUNK = 1 << 16
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"


def planned(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, html, digest, refers_to) with ``refers_to`` null for responses.

    Of equal payloads the rows of the largest page id are responses; a null id is below all others.
    """
    rows = columns(pages, page_id="bigint", url="string", html="string").withColumn("html", F.coalesce("html", F.lit("")))
    rows = rows.withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long = rows.where(F.octet_length("html") >= revisit_bytes).select("digest", "page_id")
    shared = long.groupBy("digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    shared = shared.where("n > 1").select("digest", "kept")
    revisit = ~F.col("page_id").eqNullSafe(F.col("kept"))
    return rows.join(shared, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(F.col("kept").isNotNull() & revisit, F.col("kept")).alias("refers_to")
    )


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, html: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record; a revisit keeps the head of the response with the length of its payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    block = head + html if refers_to is None else head
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{ID}{'' if page_id is None else page_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": quote(url or "", safe="%/:?#[]@!$&'()*+,;=~"),
        "WARC-Payload-Digest": _sha1(html),
        "WARC-Block-Digest": _sha1(block),
        "Content-Type": "application/http; msgtype=response",
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<{ID}{refers_to}>"}
    fields["Content-Length"] = str(len(block))
    top = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return top.encode() + block + b"\r\n\r\n"


def _gzipped(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(pages: DataFrame, folder: str | None = None, revisit_bytes: int = REVISIT_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write all pages as archives; the manifest (path, records, bytes) is stored and returned.

    Null html is an empty payload, a null url an empty one; repeated rows are repeated records;
    an empty table gives an empty manifest.  Other columns are not read.
    """
    folder = folder or f"{shared_folder(pages.sparkSession)}/cadenza/warc-{uuid.uuid4().hex}"
    schema = "path string, records bigint, bytes bigint"

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        out, path, records, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records], "bytes": [size]})

        for batch in batches:
            fields = (batch.column(c) for c in ("page_id", "url", "html", "refers_to"))
            for page_id, url, html, refers_to in zip(*fields, strict=True):
                if out is None:
                    system.create_dir(base, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    # The name ends in .gz, but the members are made here: the stream is written as it is.
                    out, path, records, size = system.open_output_stream(f"{base}/{name}", compression=None), f"{folder}/{name}", 0, 0
                member = _gzipped(record(page_id.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py()))
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return stored(planned(pages, revisit_bytes).mapInArrow(archive, schema))


class _Block:
    """Sequential bytes of the members of one archive."""

    def __init__(self, stream) -> None:
        self.stream, self.raw, self.held, self.member = stream, b"", b"", None

    def opened(self) -> bool:
        """Begin the next member; False at the end of the archive."""
        if not self.raw:
            self.raw = self.stream.read(CHUNK)
        self.member, self.held = zlib.decompressobj(31), b""
        return bool(self.raw)

    def more(self) -> bool:
        """Inflate some more of this member; False at its end."""
        while not self.member.eof:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    raise ValueError("the archive ends within a member")
            data = self.member.decompress(self.raw, CHUNK)
            self.raw = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if data:
                self.held += data
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """Up to and without ``mark``, which is passed over."""
        while (at := self.held.find(mark)) < 0:
            if not self.more():
                raise ValueError("a head does not end")
        out, self.held = self.held[:at], self.held[at + len(mark) :]
        return out

    def take(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.held and not self.more():
                raise ValueError("a record is shorter than its length")
            part, self.held = self.held[:size], self.held[size:]
            size -= len(part)
            yield part


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _page(reference: str | None) -> int | None:
    number = (reference or "").strip("<>").removeprefix(ID)
    return int(number) if number else None


def records(stream, with_payload: bool = False) -> Iterator[dict]:
    """The records of an open archive in order; ValueError where framing or a digest is wrong."""
    block = _Block(stream)
    while block.opened():
        fields = _fields(block.until(b"\r\n\r\n"))
        size, whole, payload, kept, head = int(fields["content-length"]), hashlib.sha1(), hashlib.sha1(), [], b""
        seen, in_head = 0, True
        for part in block.take(size):
            whole.update(part)
            if in_head:
                head += part
                at = head.find(b"\r\n\r\n")
                if at < 0:
                    continue
                in_head, part, head = False, head[at + 4 :], head[:at]
            payload.update(part)
            seen += len(part)
            if with_payload:
                kept.append(part)
        if b"".join(block.take(4)) != b"\r\n\r\n" or block.held or block.more():
            raise ValueError("a member is not one record")
        named = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:"))
        own = base64.b32decode(fields["warc-block-digest"].removeprefix("sha1:"))
        length = int(_fields(head).get("content-length", seen))
        response = fields["warc-type"] == "response"
        if own != whole.digest() or response and (named != payload.digest() or length != seen):
            raise ValueError(f"digest or length of {fields['warc-record-id']} is wrong")
        yield {
            "page_id": _page(fields["warc-record-id"]), "url": unquote(fields["warc-target-uri"]), "payload_bytes": length,
            "payload_digest": named.hex(), "record_type": fields["warc-type"], "refers_to": _page(fields.get("warc-refers-to")),
            "payload": b"".join(kept) if with_payload and response else None,
        }


def read(spark: SparkSession, archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the archives named by ``path``, digests verified.

    The payload, if asked for, is null for revisits.
    """
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_stream(place, compression=None) as stream:
                    rows, size = [], 0
                    for row in records(stream, with_payload):
                        rows.append(row)
                        size += len(row["payload"] or b"")
                        if len(rows) >= 1000 or size >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, schema)

    files = max(1, archives.count())
    return archives.select("path").repartition(files).mapInArrow(
        follow, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    )


ship(__name__)
