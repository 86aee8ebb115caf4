"""WARC (5): records of web pages, and a normaliser of monolithic gzip archives.

``write`` puts pages into archives compressed as one gzip stream per file, as
many crawlers leave them.  ``normalise`` inflates such a file once, as a
stream, rewrites every record as a gzip member of its own and writes a sidecar
index of member offsets; ``read`` then opens any record by its offset.
Archives lie in the shared folder; a row per file or record is all that leaves
a task, and only files named in a written manifest are read.

Of records with equal payloads of ``least`` bytes or more the one with the
largest page id is the response and the others are revisits that refer to it.

Defined cases: null html is the empty payload; rows that repeat the largest
page id of a payload are responses each; a null page id is a response only
where no row of its payload has an id; line breaks in a URL are escaped; empty
tables write no file.  A file that breaks off, or a payload whose digest
differs from its header's, raises.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_path
from .common import cut, delete_path, drop, only, open_fs, tune

CRLF = b"\r\n"


@dataclass(frozen=True)
class Archive:
    least: int = 1000              # bytes from which equal payloads are revisits
    file_bytes: int = 32 << 20     # of records in a monolithic file
    level: int = 6                 # of the members
    rough_level: int = 1           # of the monolithic stream, which is inflated once and dropped
    date: str = "2024-01-01T00:00:00Z"


# --- records -----------------------------------------------------------------------------------

def record_id(page: int | None) -> str:
    return f"<urn:page:{'none' if page is None else page}>"


def build(page: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, is_revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record."""
    b32 = base64.b32encode(bytes.fromhex(digest)).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {date}",
            "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{b32}", f"Content-Length: {len(block)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(refers)}"]
    return "\r\n".join(head).encode() + CRLF + CRLF + block + CRLF + CRLF


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """(lower-cased header fields, block)"""
    end = record.index(b"\r\n\r\n")
    lines = record[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = {k.strip().lower(): v.strip() for k, v in (x.split(":", 1) for x in lines[1:])}
    n = int(head["content-length"])
    block = record[end + 4:end + 4 + n]
    if len(block) != n or record[end + 4 + n:] != CRLF + CRLF:
        raise ValueError("record of another length than its header says")
    return head, block


def inflate(source, most: int = 1 << 20) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or many, as a stream."""
    z = zlib.decompressobj(31)
    begun = False
    while data := source.read(most):
        while data:
            begun = True
            out = z.decompress(data)
            if out:
                yield out
            data = z.unused_data
            if z.eof:
                z, begun = zlib.decompressobj(31), False
            else:
                break
    if begun:
        raise ValueError("gzip stream breaks off")


def records(stream: Iterator[bytes]) -> Iterator[bytes]:
    """Whole records of an inflated stream; holds one record at a time."""
    buf, at = bytearray(), 0
    for piece in stream:
        buf += piece
        while True:
            end = buf.find(b"\r\n\r\n", at)
            if end < 0:
                break
            n = None
            for line in bytes(buf[at:end]).split(CRLF):
                if line.lower().startswith(b"content-length:"):
                    n = int(line.split(b":", 1)[1])
            if n is None:
                raise ValueError("record without a length")
            stop = end + 4 + n + 4
            if len(buf) < stop:
                break
            yield bytes(buf[at:stop])
            at = stop
        del buf[:at]
        at = 0
    if buf:
        raise ValueError("archive breaks off inside a record")


# --- files ---------------------------------------------------------------------------------------

def _write(folder: str, a: Archive):
    def run(batches):
        fs, path = open_fs(folder)
        fs.create_dir(path, recursive=True)
        made, z, out, name, size = [], None, None, None, 0

        def close():
            nonlocal z, out
            if z is not None:
                out.write(z.flush())
                out.close()
                made.append((name, size))
                z = out = None
        for batch in batches:
            for page, url, html, digest, revisit, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if z is None:
                    name, size = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out, z = fs.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(a.rough_level, zlib.DEFLATED, 31)
                rec = build(page, url, (html or "").encode(), digest, refers, revisit, a.date)
                out.write(z.compress(rec))
                size += len(rec)
                if size >= a.file_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], names=["file", "bytes"])
    return run


def _normalise(folder: str, a: Archive):
    def run(batches):
        fs, path = open_fs(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                name = f"{file.removesuffix('.warc.gz')}-{uuid.uuid4().hex[:8]}.members.warc.gz"
                offs, sizes, at = [], [], 0
                with fs.open_input_stream(f"{path}/{file}", compression=None) as src, fs.open_output_stream(f"{path}/{name}", compression=None) as out:
                    for rec in records(inflate(src)):
                        member = gzip.compress(rec, a.level, mtime=0)
                        out.write(member)
                        offs.append(at)
                        sizes.append(len(member))
                        at += len(member)
                with fs.open_output_stream(f"{path}/{name}.idx") as out:
                    out.write("".join(json.dumps({"offset": o, "length": n}) + "\n" for o, n in zip(offs, sizes, strict=True)).encode())
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(offs)], pa.int64()), pa.array([at], pa.int64())], names=["file", "records", "bytes"])
    return run


def _page(rid: str | None) -> int | None:
    return None if rid in (None, "<urn:page:none>") else int(rid.removeprefix("<urn:page:").removesuffix(">"))


def _read(folder: str, with_payload: bool):
    def run(batches):
        fs, path = open_fs(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{path}/{file}.idx") as src:
                    index = [json.loads(x) for x in src.read().decode().splitlines()]
                rows = []

                def flush():
                    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
                    names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
                    k = 7 if with_payload else 6
                    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds[:k])], names=list(names[:k]))
                with fs.open_input_file(f"{path}/{file}") as src:
                    for x in index:
                        src.seek(x["offset"])
                        head, block = parse(gzip.decompress(src.read(x["length"])))
                        http, payload = block.split(b"\r\n\r\n", 1)
                        digest = base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex()
                        kind = head["warc-type"]
                        full = int(next(v for k, v in (y.split(b":", 1) for y in http.split(CRLF)[1:]) if k.lower() == b"content-length"))
                        if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != full):
                            raise ValueError(f"payload of {head['warc-record-id']} differs from its digest")
                        rows.append((_page(head["warc-record-id"]), head.get("warc-target-uri"), full, digest, kind, _page(head.get("warc-refers-to")),
                                     payload if kind == "response" else None))
                        if len(rows) == 2000:
                            yield flush()
                            rows = []
                yield flush()
    return run


# --- operator ---------------------------------------------------------------------------------------

def write(pages: DataFrame, a: Archive = Archive(), folder: str | None = None) -> tuple[str, DataFrame]:
    """(folder, manifest of monolithic files) of all pages (page_id, url, html)."""
    spark = pages.sparkSession
    tune(spark)
    folder = folder or shared_path(spark, f"warc-{uuid.uuid4().hex}")
    d = only(pages, page_id="page_id", url="url", html="html").withColumn("page_id", F.col("page_id").cast("long"))
    raw = F.coalesce("html", F.lit("")).cast("binary")
    seen = cut(d.select("page_id", F.sha1(raw).alias("digest"), F.octet_length(raw).alias("n")), "warc-digests")
    keep = cut(seen.where(F.col("n") >= a.least).groupBy("digest").agg(F.max("page_id").alias("top"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k"), "warc-top")
    e = d.withColumn("digest", F.sha1(raw)).join(keep, "digest", "left")
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    rows = e.select("page_id", "url", "html", "digest", revisit.alias("revisit"), F.when(revisit, F.col("top")).alias("refers"))
    m = cut(rows.mapInArrow(_write(folder, a), "file string, bytes long"), "warc-manifest")
    drop(seen, keep)
    return folder, m


def normalise(folder: str, manifest: DataFrame, a: Archive = Archive(), remove: bool = False) -> DataFrame:
    """Manifest of the rewritten files (file, records, bytes); each has its index beside it as file + '.idx'."""
    spark = manifest.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    m = cut(manifest.select("file").repartition(parts).mapInArrow(_normalise(folder, a), "file string, records long, bytes long"), "warc-members")
    if remove:
        for r in manifest.select("file").toLocalIterator():  # a name per file
            delete_path(spark, f"{folder}/{r.file}")
    return m


def read(folder: str, members: DataFrame, with_payload: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (and the responses' payload)."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return members.select("file").repartition(parts).mapInArrow(
        _read(folder, with_payload), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
        + (", payload binary" if with_payload else ""))
