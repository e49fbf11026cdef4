"""WARC archives: a writer with revisit records, and a sequential reader.

Every record is one gzip member. The reader takes an archive as a stream: it decompresses member after member with zlib as
bytes come in, reads the header block, frames the content by Content-Length, and verifies the block digest and, where the payload
is there, the payload digest. Neither holds more than one record.

Archives lie in the shared folder. Each task writes archives named by its attempt and lists them in the manifest, a written table: of a task
that runs twice the manifest names the archives of the attempt that Spark committed, and no attempt touches those of another.

Of pages with equal payloads the one with the smallest page_id is a ``response``, the others are ``revisit`` records of
it, which keep the stored response's HTTP header but no payload. Equal payloads are found by digest: one partial aggregate and one join
on (page_id, digest) rows without payloads, which leaves the rows of hot digests where they are; pages then move once, by page_id.

Defined cases: null html is an empty payload; rows with the smallest page_id and equal payloads are all responses; a row without
page_id is written with an empty id, after all others; extra columns are ignored.
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
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import columns, hot_join, run_dir, stored, temporary

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An archive of more bytes is closed and the next one begun.
ROTATE = 256 << 20
CHUNK = 1 << 16
FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, verified boolean, archive string"


def digest(data: bytes) -> str:
    """Bare upper-case base32 of SHA-1."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str, refers_to: int | None) -> bytes:
    """One WARC record as one gzip member. With ``refers_to`` it is a revisit and carries no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    uri = "".join(c for c in url or "" if c > " ")
    head = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", uri),
        ("Content-Type", "application/http;msgtype=response"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
    ]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    head.append(("Content-Length", str(len(block))))
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def members(stream: BinaryIO, chunk: int = CHUNK) -> Iterator[bytes]:
    """Decompressed gzip members of a stream, one at a time, as bytes come in."""
    rest, unpacker, parts = b"", None, []
    while True:
        data = rest or stream.read(chunk)
        rest = b""
        if not data:
            if unpacker is not None:
                raise ValueError("the archive ends within a record")
            return
        unpacker = unpacker or zlib.decompressobj(31)
        parts.append(unpacker.decompress(data))
        if unpacker.eof:
            yield b"".join(parts)
            rest, unpacker, parts = unpacker.unused_data, None, []


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and block of a record; the block is framed by Content-Length."""
    head, sep, body = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not re.fullmatch(r"\d+", fields.get("content-length", "")):
        raise ValueError("a record without content length")
    n = int(fields["content-length"])
    if body[n:] != b"\r\n\r\n" or len(body) != n + 4:
        raise ValueError("content length and record don't agree")
    return fields, body[:n]


def _page(urn: str | None) -> int | None:
    """The page of a record id of this writer; ids of others name no page."""
    found = re.fullmatch(r"<?urn:page:(-?\d+)>?", urn or "")
    return int(found[1]) if found else None


def _agrees(named: str | None, data: bytes) -> bool | None:
    """Whether a named digest is that of the data; None if there is none, or one by another algorithm."""
    kind, _, value = (named or "").partition(":")
    return value.upper() == digest(data) if kind.lower() == "sha1" and len(value) == 32 else None


def read_records(stream: BinaryIO) -> Iterator[dict]:
    """Records of one archive in order, of any kind and any writer, with the payload where the record holds it.

    ``verified`` is false if a digest or the HTTP length doesn't agree, null if the record names no digest that can be checked. The payload is what
    follows the HTTP header, or the whole block of records of other contents. A revisit has the length that its HTTP header states."""
    for member in members(stream):
        fields, block = parse(member)
        kind = fields.get("warc-type", "")
        http, payload = b"", block
        if fields.get("content-type", "").lower().replace(" ", "").startswith("application/http"):
            http, _, payload = block.partition(b"\r\n\r\n")
        lengths = [int(x.split(b":")[1]) for x in http.split(b"\r\n") if re.fullmatch(rb"content-length: *\d+ *", x.lower())]
        whole, named = kind != "revisit", fields.get("warc-payload-digest")
        checks = [_agrees(fields.get("warc-block-digest"), block)]
        if whole:
            checks += [_agrees(named, payload), False if lengths and lengths != [len(payload)] else None]
        known = [x for x in checks if x is not None]
        yield {
            "page_id": _page(fields.get("warc-record-id")), "payload_bytes": len(payload) if whole or not lengths else lengths[0], "payload_digest": named.rpartition(":")[2] if named else None,
            "record_type": kind, "refers_to": _page(fields.get("warc-refers-to")), "target_uri": fields.get("warc-target-uri") or None, "verified": all(known) if known else None,
            "payload": payload if whole else None,
        }


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def decided(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, refers_to): refers_to is null for responses."""
    rows = columns(pages, page_id="long", url="string", html="string").withColumn("html", F.coalesce("html", F.lit("")))
    sha = F.sha1(F.col("html").cast("binary"))
    small = stored(rows.select("page_id", sha.alias("sha"), F.octet_length("html").alias("n")), "page-digests").filter(F.col("n") >= min_bytes)  # html is read here and when it is written
    first = small.groupBy("sha").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
    refers = hot_join(small.select("page_id", "sha"), first, "sha", "n").filter("page_id is null or page_id <> first").select(F.col("page_id").alias("_page"), "sha", "first").distinct()
    keyed = rows.withColumn("sha", sha)
    joined = keyed.join(refers, keyed["page_id"].eqNullSafe(refers["_page"]) & (keyed["sha"] == refers["sha"]), "left")
    return joined.select("page_id", "url", "html", F.col("first").alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, rotate: int = ROTATE) -> DataFrame:
    """Write all pages; the result is the manifest (archive, records, bytes), a table in the same folder."""
    archives = f"{folder}/archives"
    schema = pa.schema([("archive", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, attempt, serial = TaskContext.get().partitionId(), uuid.uuid4().hex, 0
        fs, base = _file_system(archives)
        fs.create_dir(base, recursive=True)
        out, name, records, size = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"archive": name, "records": records, "bytes": size}], schema=schema)

        for batch in batches:
            for page, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if out is None:
                    name, records, size = f"part-{task:06d}-{serial:04d}-{attempt}.warc.gz", 0, 0
                    out, serial = fs.open_output_stream(f"{base}/{name}", compression=None), serial + 1
                payload = html.encode()
                data = record(page, url, payload, digest(payload), refers)
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= rotate:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    decided(pages, min_bytes).mapInArrow(run, "archive string, records long, bytes long").write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema("archive string, records long, bytes long").parquet(f"{folder}/manifest")


def read_archives(manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Records of all archives of a manifest, read in sequence within each archive."""
    archives = f"{folder}/archives"
    types = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    schema = pa.schema([(f.split()[0], types[f.split()[1]]) for f in FIELDS.split(", ")] + ([("payload", pa.binary())] if payloads else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _file_system(archives)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for r in read_records(stream):
                        r["archive"] = name
                        rows.append({k: r[k] for k in schema.names})
                        held += r["payload_bytes"] if payloads else 0
                        if len(rows) >= 4096 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # A count of its own, so that the short names of the manifest aren't coalesced into one task that reads all archives.
    dealt = manifest.select("archive").repartition(max(1, manifest.count()), "archive")
    return dealt.mapInArrow(run, FIELDS + (", payload binary" if payloads else ""))


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages as archives in the shared folder, then read them back."""
    folder = run_dir(spark, "warc")
    temporary(spark, folder)  # archives and manifest go when the application ends
    return read_archives(write_archives(pages, folder, min_bytes), folder)
