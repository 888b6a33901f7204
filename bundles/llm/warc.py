"""Writing and reading WARC archives (operator 9).

An archive is a sequence of gzip members, one record each, so that a reader
can stop and start at record bounds.  The reader walks an archive front to
back: members are inflated in steps, a record's header block ends at the
first empty line, its Content-Length says how many bytes its block has, and
the payload's SHA-1 is held against the record's digest.

Records whose payload another record holds already are ``revisit`` records:
HTTP headers without the payload, naming the record they refer to.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: Compressed bytes after which a new archive is begun.
ARCHIVE_BYTES = 16 << 20
STEP = 1 << 16
CRLF = b"\r\n"
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:page:"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(page_id, url, payload: bytes, digest: str, refers_to=None, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One WARC/1.1 record as a gzip member; a revisit if it refers to another page."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{ID}{'' if page_id is None else page_id}>"),
            ("WARC-Date", date), ("WARC-Target-URI", "" if url is None else "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in url)),
            ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{ID}{refers_to}>")]
    raw = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + CRLF + block + CRLF + CRLF
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def members(stream):
    """The inflated bytes of each gzip member of a stream, read and decompressed step by step."""
    data = stream.read(STEP)
    while data:
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            if not data:
                raise ValueError("the archive ends inside a record")
            out.append(z.decompress(data))
            data = z.unused_data or stream.read(STEP)
        yield b"".join(out)


def headers(block: bytes) -> dict[str, str]:
    lines = block.split(CRLF)
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode().partition(":") for x in lines[1:] if x)}


def parse(raw: bytes) -> tuple:
    """The columns of ``RECORD``; raises ValueError if framing or digest is wrong."""
    head, gap, rest = raw.partition(CRLF + CRLF)
    if not gap or not head.startswith(b"WARC/1."):
        raise ValueError("no WARC header")
    warc = headers(head)
    size = int(warc["content-length"])
    block, tail = rest[:size], rest[size:]
    if len(block) != size or tail != CRLF + CRLF:
        raise ValueError("the record's block isn't as long as it says")
    http, _, payload = block.partition(CRLF + CRLF)
    digest, kind = warc["warc-payload-digest"].removeprefix("sha1:"), warc["warc-type"]
    length = int(headers(http)["content-length"])
    if kind == "response" and (len(payload) != length or base32(hashlib.sha1(payload).hexdigest()) != digest):
        raise ValueError("the payload isn't what its digest says")

    def page(name: str):
        own = warc.get(name, "").strip("<>").removeprefix(ID)
        return int(own) if own else None

    return (page("warc-record-id"), warc.get("warc-target-uri"), kind, page("warc-refers-to"), length, digest,
            payload if kind == "response" else None)


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write rows ``(page_id, url, payload, sha1, refers_to)`` as archives; returns ``(path, records)``, to be written.

    Each attempt of a task uses names of its own and reports them when it ends,
    so what a lost attempt left behind is in no written list.
    """
    from pyarrow import fs

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        paths, counts, sink, size = [], [], None, 0
        for b in batches:
            for page_id, url, payload, sha1, refers_to in zip(*[b.column(i).to_pylist() for i in range(5)]):
                if sink is None or size >= archive_bytes:
                    if sink is not None:
                        sink.close()
                    paths.append(f"{name}-{len(paths):05d}.warc.gz")
                    counts.append(0)
                    sink, size = store.open_output_stream(f"{base}/{paths[-1]}", compression=None), 0
                data = record(page_id, url, payload, base32(sha1), refers_to)
                sink.write(data)
                size += len(data)
                counts[-1] += 1
        if sink is not None:
            sink.close()
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64())], names=["path", "records"])

    return pages.select("page_id", "url", "payload", "sha1", "refers_to").mapInArrow(run, "path string, records long")


def read_archives(paths: DataFrame) -> DataFrame:
    """All records of the archives listed in the column ``path`` (URIs), one row each, digests verified.

    Archives are streamed, so a task holds one record and a batch of rows.  A
    broken record fails the read with the archive's name.
    """
    from pyarrow import fs

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                store, own = fs.FileSystem.from_uri(path)
                rows, size, at = [], 0, 0
                with store.open_input_stream(own, compression=None) as stream:
                    for raw in members(stream):
                        try:
                            rows.append(parse(raw))
                        except (ValueError, KeyError) as e:
                            raise ValueError(f"{path}, record {at}: {e}") from e
                        at, size = at + 1, size + len(raw)
                        if size > 8 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return paths.select("path").mapInArrow(run, RECORD)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])


def archive(df: DataFrame, min_revisit_bytes: int = 0, key: str = "page_id", url: str = "url", html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Write a record per row and read the archives back: ``(records, manifest)``.

    The payload is the html in UTF-8; null html is an empty payload.  Of rows
    with equal payloads of at least ``min_revisit_bytes`` bytes, the one with
    the smallest non-null key is the response and the others revisit it; rows
    that repeat that key, and groups of null keys only, are responses.  Null
    urls are written as empty.  Other columns are ignored.  An empty table
    gives no archive and no record.
    """
    scratch = Scratch(df.sparkSession, "warc")
    payload = F.encode(F.coalesce(F.col(f"`{html}`"), F.lit("")), "UTF-8")
    pages = df.select(F.col(f"`{key}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), payload.alias("payload"))
    pages = pages.withColumn("sha1", F.sha1("payload"))
    first = scratch.write(pages.where(F.length("payload") >= min_revisit_bytes).groupBy("sha1")
                          .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "first")
    refers = F.when((F.length("payload") >= min_revisit_bytes) & (~F.col("first").eqNullSafe(F.col("page_id"))), F.col("first"))
    told = pages.join(first, "sha1", "left").withColumn("refers_to", refers)
    folder = scratch.path("archives")
    manifest = scratch.write(write_archives(told, folder), "manifest")
    listed = manifest.select(F.concat(F.lit(f"{folder}/"), "path").alias("path"))
    archives = listed.count()  # a read task per archive
    return read_archives(listed.repartition(max(1, archives))), manifest
