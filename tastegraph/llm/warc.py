"""WARC archives: one gzip member per record, written by tasks and read back as a stream.

Pages with equal payloads of at least 1000 bytes are stored once: the largest
page id is the response, the others are revisits that refer to it. Each task
writes archives of bounded size under another name and moves them when
complete; only archives named by a finished task's row are read. The reader
decompresses piece by piece, frames a record by its Content-Length, and checks
the digests of block and payload, so its memory grows with a record's header only, not with its payload.

Edge cases
* null html: an empty payload; null url: no target header;
* very long url: written and read whole, in a header of at most 1 GB (escaped); a longer one raises an error;
* null page id: kept as null, never the response of a group that has an id;
* rows with one page id and one payload: both are what that page id is;
* an empty table writes no archive and gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import Scratch, write_whole
from tastegraph.session import open_fs

LEAST_BYTES = 1000  # payloads below are stored each time
ARCHIVE_BYTES = 64 << 20  # compressed size at which a task starts another archive
CHUNK = 1 << 16
HEADER_BYTES = 1 << 30  # a longer header counts as damage
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
FILE_SCHEMA = "path string, n_records long, n_bytes long"
RECORD_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
                 "refers_to long")


def record_plan(pages: DataFrame, scratch: Scratch, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(page, url, payload, digest, response): response is the page id that holds the payload, if it isn't this row's."""
    rows = pages.select(pages["page_id"].cast("long").alias("page"), pages["url"].cast("string").alias("url"),
                        F.coalesce(pages["html"], F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    copies = (rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
              .agg(F.count(F.lit(1)).alias("n"), F.max("page").alias("keeper"))
              .where("n > 1 and keeper is not null").select("digest", "keeper"))
    copies = scratch.keep(copies, "copies")  # a plain table, so that AQE can split the shuffle at a hot digest
    return rows.join(copies, "digest", "left").select(
        "page", "url", "payload", "digest",
        F.when(~F.col("page").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("response"))


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}/{digest}')}>"


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, response: int | None,
                 date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record, uncompressed."""
    head = HTTP.format(len(payload)).encode()
    block = head if response is not None else head + payload
    fields = [("WARC-Type", "response" if response is None else "revisit"), ("WARC-Record-ID", _record_id(page, digest)),
              ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if response is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _record_id(response, digest)),
                   ("X-Refers-To-Page", str(response))]
    if page is not None:
        fields.append(("X-Page-ID", str(page)))
    fields += [("X-Payload-Length", str(len(payload))), ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Block-Digest", f"sha1:{hashlib.sha1(block).hexdigest()}"),
               ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def write_archives(plan: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """A lazy frame of FILE_SCHEMA whose tasks write the archives. Store it before use."""
    def run(batches):
        rows = (row for b in batches for i in range(b.num_rows)
                for row in zip(*(c.to_pylist() for c in b.slice(i, 1).columns)))
        context = TaskContext.get()
        name = f"{folder}/pages-{context.partitionId():06d}-{context.taskAttemptId()}"

        def members(row, told):
            size = 0
            while row is not None:
                data = _member(record_bytes(*row))
                size += len(data)
                told["n"] += 1
                yield data
                row = next(rows, None) if size < archive_bytes else None

        part = 0
        while (row := next(rows, None)) is not None:
            told, path = {"n": 0}, f"{name}-{part:04d}.warc.gz"
            size = write_whole(path, members(row, told))
            part += 1
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [told["n"]], "n_bytes": [size]})

    return plan.select("page", "url", "payload", "digest", "response").mapInArrow(run, FILE_SCHEMA)


class Members:
    """The decompressed bytes of a file of gzip members, a member at a time."""

    def __init__(self, stream):
        self.stream, self.rest, self.z, self.out = stream, b"", None, bytearray()

    def next_member(self) -> bool:
        """Goes to the next member; False at the end of the file."""
        if self.z is not None and not self.z.eof:
            raise ValueError("a gzip member was left before its end")
        self.rest = self.rest or self.stream.read(CHUNK)
        self.z = zlib.decompressobj(31)
        self.out.clear()
        return bool(self.rest)

    def _more(self) -> bool:
        """Decompresses at most CHUNK more bytes; False at the end of the member."""
        if self.z.eof:
            return False
        data = self.z.unconsumed_tail or self.rest or self.stream.read(CHUNK)
        if not data:
            raise ValueError("the file ends inside a gzip member")
        if not self.z.unconsumed_tail:
            self.rest = b""
        self.out += self.z.decompress(data, CHUNK)
        if self.z.eof:
            self.rest = self.z.unused_data
        return True

    def until(self, mark: bytes, most: int = HEADER_BYTES) -> bytes:
        """The bytes up to and with the mark."""
        seen = 0
        while (at := self.out.find(mark, max(0, seen - len(mark) + 1))) < 0:
            seen = len(self.out)
            if seen > most or not self._more():
                raise ValueError("a header has no end")
        got = bytes(self.out[:at + len(mark)])
        del self.out[:at + len(mark)]
        return got

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes, piece by piece."""
        while n:
            if not self.out and not self._more():
                raise ValueError("a record is shorter than its Content-Length")
            got = bytes(self.out[:n])
            del self.out[:n]
            n -= len(got)
            if got:
                yield got

    def rest_of_member(self) -> bytes:
        while self._more():
            if len(self.out) > 4:
                break
        return bytes(self.out)


def _fields(head: bytes) -> dict[str, str]:
    first, *lines = head.decode().rstrip("\r\n").split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def read_records(stream, with_payload: bool = False) -> Iterator[dict]:
    """The records of an archive in order, framed by Content-Length, digests verified.

    Yields the header fields (lower case) with "payload_bytes" and "payload_digest"
    of the full payload; with_payload adds "payload" (None for revisits).
    """
    members = Members(stream)
    while members.next_member():
        fields = _fields(members.until(b"\r\n\r\n"))
        left = int(fields["content-length"])
        block, payload, size = hashlib.sha1(), hashlib.sha1(), 0
        http, body, kept = bytearray(), False, []
        for piece in members.take(left):
            block.update(piece)
            if not body:
                http += piece
                if (at := http.find(b"\r\n\r\n")) < 0:
                    continue
                body, piece = True, bytes(http[at + 4:])
            payload.update(piece)
            size += len(piece)
            if with_payload:
                kept.append(piece)
        if members.rest_of_member() != b"\r\n\r\n":
            raise ValueError("a record is longer than its Content-Length")
        told = fields["warc-payload-digest"].removeprefix("sha1:")
        if fields["warc-block-digest"].removeprefix("sha1:") != block.hexdigest():
            raise ValueError(f"block digest of {fields['warc-record-id']} differs")
        revisit = fields["warc-type"] == "revisit"
        if not revisit and (told != payload.hexdigest() or size != int(fields["x-payload-length"])):
            raise ValueError(f"payload digest of {fields['warc-record-id']} differs")
        fields |= {"payload_bytes": int(fields["x-payload-length"]) if revisit else size, "payload_digest": told}
        if with_payload:
            fields["payload"] = None if revisit else b"".join(kept)
        yield fields


def read_archives(files: DataFrame) -> DataFrame:
    """RECORD_SCHEMA of every record of the archives named by stored rows of FILE_SCHEMA; one task per few archives."""
    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                f, p = open_fs(path)
                with f.open_input_stream(p, compression=None) as stream:  # members are told apart here
                    rows: list[tuple] = []
                    for r in read_records(stream):
                        number = lambda k, r=r: int(r[k]) if k in r else None
                        rows.append((number("x-page-id"), r.get("warc-target-uri"), r["payload_bytes"],
                                     r["payload_digest"], r["warc-type"], number("x-refers-to-page")))
                        if len(rows) >= 5000:
                            yield _records(rows)
                            rows = []
                    if rows:
                        yield _records(rows)

    paths = files.select("path")
    return paths.repartition(max(1, files.count())).mapInArrow(run, RECORD_SCHEMA)


def _records(rows: list[tuple]) -> pa.RecordBatch:
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, k, c in zip(names, kinds, zip(*rows))})


def digest(pages: DataFrame) -> DataFrame:
    scratch = Scratch(pages.sparkSession, "warc")
    files = scratch.keep(write_archives(record_plan(pages, scratch), scratch.path("archives")), "manifest")
    return read_archives(files).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to FROM k"""
