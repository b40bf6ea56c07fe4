"""WARC archives: written by tasks, read back record by record.

Each record is a gzip member of its own. The reader goes through an archive once, in blocks: it
inflates one member after the other, frames the record by its Content-Length and checks the
payload's digest as it goes, so it holds a block at a time (and one payload, where payloads are asked for).

A payload that occurs again becomes a revisit of the record with the smallest id. Which one that is
is found on narrow rows, ids and digests, by a partial aggregation; a page's text travels once.

Archives lie below the shared folder. A task that is run again writes archives under new names, and
only those listed in the written manifest are read, so lost tasks leave no trace in results.

A null payload is an empty one. A null id never revisits nor is revisited. Rows that repeat both id
and payload are all responses if that id is the smallest. Any kind of URL is written, percent-encoded where it
would break a header; a null URL leaves the header out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jsonflow.llm.common import stored
from jsonflow.session import shared_dir

# Bytes after which a task opens the next archive, and that the reader takes at a time.
ARCHIVE, READ = 256 << 20, 1 << 16
DATE = "1970-01-01T00:00:00Z"
_ID = "urn:page:"


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def _member(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n") + deflate.compress(block) + deflate.compress(b"\r\n\r\n") + deflate.flush()


def _uri(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """A gzip member: a response, or a revisit if it refers to another record."""
    own = str(page_id) if page_id is not None else f"none:{uuid.uuid4()}"
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{_ID}{own}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", _uri(url)))
    fields += [("Content-Type", "application/http;msgtype=response"), ("WARC-Payload-Digest", f"sha1:{base32(hashlib.sha1(payload).digest())}")]
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return _member(fields, block + payload)
    fields += [("WARC-Refers-To", f"<{_ID}{refers_to}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return _member(fields, block)


# --- reading ------------------------------------------------------------------------


class Damaged(ValueError):
    """An archive that breaks its framing or a digest."""


class _Members:
    """The inflated bytes of an archive, one gzip member after the other."""

    def __init__(self, source: BinaryIO) -> None:
        self._source, self._rest = source, b""

    def next(self) -> Iterator[bytes] | None:
        if not self._rest:
            self._rest = self._source.read(READ)
        return self._inflate() if self._rest else None

    def _inflate(self) -> Iterator[bytes]:
        inflate = zlib.decompressobj(31)
        while not inflate.eof:
            data = inflate.unconsumed_tail or self._rest or self._source.read(READ)
            if not data:
                raise Damaged("the archive ends inside a member")
            if not inflate.unconsumed_tail:
                self._rest = b""
            out = inflate.decompress(data, READ)
            if out:
                yield out
        self._rest = inflate.unused_data or self._rest


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


class _Member:
    """One member's bytes, taken up to a mark or by count."""

    def __init__(self, parts: Iterator[bytes]) -> None:
        self._parts, self._have = parts, b""

    def head(self) -> bytes:
        """Bytes up to an empty line, which is taken too."""
        while (at := self._have.find(b"\r\n\r\n")) < 0:
            more = next(self._parts, b"")
            if not more:
                raise Damaged("a header has no end")
            self._have += more
        out, self._have = self._have[:at], self._have[at + 4 :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self._have:
                self._have = next(self._parts, b"")
                if not self._have:
                    raise Damaged("a record is shorter than its Content-Length")
            out, self._have = self._have[:n], self._have[n:]
            n -= len(out)
            yield out

    def drain(self) -> Iterator[bytes]:
        """All that is left, part by part."""
        if self._have:
            yield self._have
            self._have = b""
        yield from self._parts


def records(source: BinaryIO, with_payload: bool = False) -> Iterator[dict]:
    """Records of an archive in order; raises ``Damaged`` on broken framing or digests."""
    members = _Members(source)
    while (parts := members.next()) is not None:
        member = _Member(parts)
        start = member.head()
        if not start.startswith(b"WARC/1."):
            raise Damaged("a member is no WARC record")
        fields = _fields(start)
        block = _Member(member.take(int(fields["content-length"])))
        if fields.get("warc-type") not in ("response", "revisit"):
            for _ in block.drain():
                pass
        else:
            http = _fields(block.head())
            sha1, size, kept = hashlib.sha1(), 0, []
            for piece in block.drain():
                sha1.update(piece)
                size += len(piece)
                if with_payload:
                    kept.append(piece)
            said = fields["warc-payload-digest"].removeprefix("sha1:")
            if fields["warc-type"] == "response" and (said != base32(sha1.digest()) or size != int(http["content-length"])):
                raise Damaged(f"{fields['warc-record-id']}: the payload does not match its digest")
            yield {
                "record_id": fields["warc-record-id"].strip("<>"),
                "record_type": fields["warc-type"],
                "url": fields.get("warc-target-uri"),
                "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
                "payload_bytes": int(http["content-length"]),
                "payload_digest": said,
                "payload": b"".join(kept) if with_payload and fields["warc-type"] == "response" else None,
            }
        if b"".join(member.drain()) != b"\r\n\r\n":
            raise Damaged("a record is longer than its Content-Length")


# --- as Spark jobs ------------------------------------------------------------------


def _open(uri: str, write: bool):
    from pyarrow.fs import FileSystem

    fs, path = FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")
    if write:
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        return fs.open_output_stream(path, compression=None)
    return fs.open_input_stream(path, compression=None)


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    out, path, n, size, done = None, "", 0, 0, []
    for batch in batches:
        for page_id, url, html, refers_to in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if out is None:
                path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                out = _open(path, write=True)
                out.write(_member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
            member = record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers_to)
            out.write(member)
            n, size = n + 1, size + len(member)
            if size >= ARCHIVE:
                out.close()
                done.append((path, n))
                out = None
    if out is not None:
        out.close()
        done.append((path, n))
    yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in done], pa.string()), pa.array([k for _, k in done], pa.int64())], ["path", "records"])


def _read(batches: Iterator[pa.RecordBatch], with_payload: bool) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "record_type", "url", "refers_to", "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
    for batch in batches:
        for path in batch.column(0).to_pylist():
            rows, held = [], 0
            with _open(path, write=False) as source:
                for r in records(source, with_payload):
                    rows.append(r)
                    held += 200 + len(r["payload"] or b"")
                    if held > 1 << 23:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(names, kinds))))
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, pa.schema(list(zip(names, kinds))))


def write_archives(pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Writes every row (``page_id, url, html``) as a record; ``path, records`` of each archive.

    Payloads of ``least`` bytes or more that occur again are written as revisits.
    """
    folder = folder or f"{shared_dir(pages.sparkSession)}/warc"
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    payload = F.coalesce("html", F.lit("")).cast("binary")
    known = rows.where("page_id IS NOT NULL").select("page_id", F.unhex(F.sha1(payload)).alias("digest"), F.octet_length(payload).alias("n"))
    known = known.where(F.col("n") >= least).select("page_id", "digest")
    firsts = known.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first <> last")
    again = known.join(firsts.select("digest", "first"), "digest").where("page_id <> first").select("page_id", "digest", "first").distinct()
    again = again.select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "first")
    rows = rows.withColumn("digest", F.unhex(F.sha1(payload)))
    joined = rows.join(again, (F.col("page_id") == F.col("again_id")) & (F.col("digest") == F.col("again_digest")), "left")
    return stored(joined.select("page_id", "url", "html", "first").mapInArrow(lambda b: _write(b, folder), "path string, records long"))


def read_archives(archives: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of the archives listed in ``path``, each archive read by one task from start to end."""
    schema = "record_id string, record_type string, url string, refers_to string, payload_bytes long, payload_digest string, payload binary"
    paths = archives.select("path")
    paths = paths.repartition(max(1, paths.count()), "path")
    return paths.mapInArrow(lambda b: _read(b, with_payload), schema)


def page_of(column: str):
    """The page id in a record id; null where the page had none."""
    return F.expr(f"try_cast(substring({column}, {len(_ID) + 1}) AS BIGINT)")
