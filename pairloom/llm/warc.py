"""WARC archives: one gzip member per record, read back sequentially."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import BinaryIO

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import whole
from pairloom.scratch import broadcast_if_small, scratch_folder, stage

# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_DATE = "1970-01-01T00:00:00Z"

_CHUNK = 1 << 16
_MANIFEST = "path string, records long"
_RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


class ArchiveError(ValueError):
    """An archive that breaks the format or a digest."""


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_id(name: str | None) -> int | None:
    if name is None:
        return None
    number = name.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def _one_line(value: str) -> str:
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def _many_lines(value: str) -> str:
    return value.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """A record as one gzip member. A revisit keeps the HTTP header, whose length is that of the payload it stands for."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if revisit:
        fields += [("WARC-Refers-To", _name(refers_to)), ("WARC-Profile", REVISIT_PROFILE)]
    head = VERSION + b"\r\n" + b"".join(f"{name}: {value}\r\n".encode() for name, value in fields) + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def _fields(lines: list[bytes]) -> dict[str, str]:
    found = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ArchiveError(f"a header line without a colon: {line[:80]!r}")
        found[name.decode().strip().lower()] = value.decode().strip()
    return found


class _Members:
    """Decompressed bytes of one gzip member after another, a chunk at a time."""

    def __init__(self, stream: BinaryIO):
        self._stream, self._rest, self._ended = stream, b"", True
        self._unpack = None
        self._ready = b""

    def next_member(self) -> bool:
        """Step to the next member; false at the end of the archive."""
        if not self._ended or self._ready:
            raise ArchiveError("a member goes on after its record")
        if not self._rest:
            self._rest = self._stream.read(_CHUNK)
        if not self._rest:
            return False
        self._unpack, self._ended = zlib.decompressobj(31), False
        return True

    def _more(self) -> bool:
        while not self._ended and not self._ready:
            if self._unpack.eof:
                self._rest, self._ended = self._unpack.unused_data, True
                return False
            data = self._unpack.unconsumed_tail or self._rest or self._stream.read(_CHUNK)
            if not data:
                raise ArchiveError("the archive ends inside a member")
            self._rest = b""
            self._ready = self._unpack.decompress(data, _CHUNK)
        return bool(self._ready)

    def line(self) -> bytes:
        parts = []
        while self._more():
            end = self._ready.find(b"\n")
            if end >= 0:
                parts.append(self._ready[: end + 1])
                self._ready = self._ready[end + 1 :]
                line = b"".join(parts)
                if not line.endswith(b"\r\n"):
                    raise ArchiveError("a header line without CR LF")
                return line[:-2]
            parts.append(self._ready)
            self._ready = b""
        raise ArchiveError("a member ends inside a header")

    def take(self, length: int) -> Iterator[bytes]:
        while length > 0:
            if not self._more():
                raise ArchiveError("a member ends inside a block")
            part, self._ready = self._ready[:length], self._ready[length:]
            length -= len(part)
            yield part

    def finish(self) -> None:
        if b"".join(self.take(4)) != b"\r\n\r\n" or self._more():
            raise ArchiveError("a record does not end where its member ends")


@dataclass
class Record:
    page_id: int | None
    url: str | None
    payload_bytes: int
    payload_digest: str
    record_type: str
    refers_to: int | None
    payload: bytes | None


def read_records(stream: BinaryIO, keep_payload: bool = False) -> Iterator[Record]:
    """Records of an archive in order. Frames by Content-Length; checks block and payload digests.

    Holds a chunk of a block at a time unless the payload is asked for.
    """
    members = _Members(stream)
    while members.next_member():
        if members.line() != VERSION:
            raise ArchiveError("a member that does not begin a record")
        lines = []
        while line := members.line():
            lines.append(line)
        fields = _fields(lines)
        left = int(fields["content-length"])
        block_hash, payload_hash, head, kept, size = hashlib.sha256(), hashlib.sha256(), b"", [], 0
        in_payload = False
        for part in members.take(left):
            block_hash.update(part)
            if not in_payload:
                head += part
                end = head.find(b"\r\n\r\n")
                if end < 0:
                    continue
                head, part, in_payload = head[:end], head[end + 4 :], True
            payload_hash.update(part)
            size += len(part)
            if keep_payload:
                kept.append(part)
        members.finish()
        if not in_payload:
            raise ArchiveError("a block without an HTTP header")
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        length = int(_fields(head.split(b"\r\n")[1:])["content-length"])
        if block_hash.hexdigest() != fields["warc-block-digest"].removeprefix("sha256:"):
            raise ArchiveError(f"block digest of {fields['warc-record-id']}")
        revisit = fields["warc-type"] == "revisit"
        if not revisit and (payload_hash.hexdigest() != digest or size != length):
            raise ArchiveError(f"payload digest of {fields['warc-record-id']}")
        url = fields.get("warc-target-uri")
        yield Record(
            _page_id(fields["warc-record-id"]),
            None if url is None else _many_lines(url),
            length,
            digest,
            fields["warc-type"],
            _page_id(fields.get("warc-refers-to")),
            b"".join(kept) if keep_payload and not revisit else None,
        )


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_bytes: int = 100,
    archive_bytes: int = 64 << 20,
    date: str = NO_DATE,
) -> DataFrame:
    """Write a record per row of ``pages`` and return the manifest ``(path, records)``.

    Of rows with equal payloads of at least ``least_bytes`` bytes, the one with the smallest id is
    a response and the others revisit it; smaller payloads are all responses. A null payload is
    empty. A null id is larger than any other and stays null; rows that repeat the id of a response
    are responses, too. Other columns are not read. An empty table gives no archives.

    Tasks stream their rows into archives of about ``archive_bytes`` below ``folder``, by default
    in the shared scratch folder, through the file system that its address names. Names are new for
    each attempt; only archives in the manifest, which Spark commits, count, so a task that ran
    twice leaves no record twice. Payload copies are found by digest with narrow rows; the pages
    themselves move only when the list of shared payloads is too large to broadcast.
    """
    spark = pages.sparkSession
    folder = folder or scratch_folder(spark, "warc")
    payload = whole(F.col(html_col)).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.filter(F.octet_length("payload") >= least_bytes)
    shared = large.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    shared = stage(shared.filter("n > 1").select("digest", "first"), "warc-shared")
    rows = rows.join(broadcast_if_small(shared.df, shared.count(), 128), "digest", "left")
    rows = rows.withColumn("revisit", F.coalesce(F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first")), F.lit(False)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, path, records, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [records]})

        for batch in batches:
            columns = [batch.column(name) for name in ("id", "url", "payload", "digest", "first", "revisit")]
            for id_, url, body, digest, first, revisit in zip(*columns, strict=True):
                if out is None:
                    path = f"{uuid.uuid4().hex}.warc.gz"
                    out, records, size = store.open_output_stream(f"{base}/{path}", compression=None), 0, 0
                again = revisit.as_py()
                data = record_bytes(id_.as_py(), url.as_py(), body.as_py(), digest.as_py(), first.as_py(), again, date)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    manifest = rows.select("id", "url", "payload", "digest", "first", "revisit").mapInArrow(write, _MANIFEST)
    manifest = manifest.select(F.concat(F.lit(folder.rstrip("/") + "/"), "path").alias("path"), "records")
    return stage(manifest, "warc-manifest").df


def read_archives(manifest: DataFrame, *, with_payload: bool = False) -> DataFrame:
    """``(page_id, url, payload_bytes, payload_digest, record_type, refers_to[, payload])`` of all archives of a manifest.

    Tasks read whole archives, each as one stream. A broken frame or digest, or a count of records
    other than the manifest's, fails the query. A revisit has no payload of its own.
    """
    schema = _RECORD + (", payload binary" if with_payload else "")
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = dict(zip(names, [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()], strict=False))

        def packed(rows: list[Record]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([getattr(r, n) for r in rows], types[n]) for n in names], names=names)

        for batch in batches:
            for path, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, place = FileSystem.from_uri(path)
                seen, rows, held = 0, [], 0
                with store.open_input_stream(place, compression=None) as stream:
                    for record in read_records(stream, with_payload):
                        seen += 1
                        rows.append(record)
                        held += len(record.payload or b"")
                        if len(rows) >= 1000 or held >= 8 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                if seen != records:
                    raise ArchiveError(f"{path} has {seen} records, not {records}")
                if rows:
                    yield packed(rows)

    # Archives are dealt one by one, not by the size of the manifest's rows.
    archives = manifest.count()
    return manifest.repartition(max(1, archives), "path").mapInArrow(read, schema)
