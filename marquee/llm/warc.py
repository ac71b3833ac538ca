"""WARC archives: a writer with identical-payload revisits and a splittable reader.

Every record is a gzip member of its own.  The reader splits files into byte
ranges; a task looks for the gzip magic from the start of its range, takes the
first candidate that decodes to a WARC header, and from there on follows the
members one after another.  It owns the records that start inside its range,
so every record is read by exactly one task wherever the ranges are cut.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import saved
from marquee.llm.tokenfile import open_uri

GZIP = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPLIT_BYTES = 16 << 20
CHUNK = 256 << 10
MANIFEST = "path string, n_bytes long, n_records long"
RECORDS = ("path string, record_offset long, record_type string, record_id string, refers_to string, target_uri string, "
           "payload_bytes long, payload_digest string, payload binary")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member with one record."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))])
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n") + deflate.flush()


def page_member(page_id: int | None, url: str | None, payload: bytes, keeper: int | None, revisit: bool, date: str) -> bytes:
    """A response record, or the revisit of the record of page ``keeper`` (its block keeps the HTTP header, with the full length)."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", date),
               ("WARC-Payload-Digest", "sha1:" + digest(payload)), ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(keeper))]
    return member(headers, http if revisit else http + payload)


def write_warc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               revisit_from: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One record per row, one archive per task; returns the manifest of the committed archives.

    Of rows with equal payloads of at least ``revisit_from`` bytes, the one
    with the largest id is written whole and the others as its revisits.  Null
    payloads are empty; a null id is smaller than any other; rows that repeat
    the largest id are all written whole.  Files have a new name for each
    attempt, and only those of committed tasks are in the manifest.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload")) \
        .withColumn("digest", F.sha1("payload")).withColumn("large", F.length("payload") >= revisit_from)
    # Digests only: the widest table is shuffled once, by (id, digest), however hot a payload is.
    marks = rows.filter("large").select("page_id", "digest")
    keepers = marks.groupBy("digest").agg(F.max("page_id").alias("keeper"))
    plan = marks.distinct().join(keepers, "digest").filter(~F.col("page_id").eqNullSafe(F.col("keeper")))
    same = [F.col("p.page_id").eqNullSafe(F.col("k.page_id")), F.col("p.digest") == F.col("k.digest"), F.col("large")]
    marked = rows.alias("p").join(plan.alias("k"), same, "left") \
        .select("p.page_id", "url", "payload", "keeper", F.col("k.digest").isNotNull().alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = path = None
        n = size = 0
        for batch in batches:
            for page_id, url, payload, keeper, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if stream is None:
                    path = f"{folder}/part-{uuid.uuid4().hex}.warc.gz"
                    stream = open_uri(path, write=True)
                    info = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", date),
                                   ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    size += stream.write(info)
                size += stream.write(page_member(page_id, url, payload, keeper, revisit, date))
                n += 1
        if stream is not None:
            stream.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_bytes": [size], "n_records": [n]})

    return saved(marked.mapInArrow(write, MANIFEST), "archives")


class Members:
    """The gzip members of a file that start in [first, last)."""

    def __init__(self, stream, first: int, last: int) -> None:
        self.stream, self.size, self.last = stream, stream.size(), last
        self.at, self.held = first, b""  # held: bytes of the file from ``at`` on

    def _more(self) -> bool:
        self.stream.seek(self.at + len(self.held))
        got = self.stream.read(CHUNK)
        self.held += got
        return bool(got)

    def _drop(self, n: int) -> None:
        self.held, self.at = self.held[n:], self.at + n

    def _candidate(self) -> bool:
        """Move to the next gzip magic that starts before ``last``."""
        while self.at < self.last:
            k = self.held.find(GZIP)
            if k >= 0:
                self._drop(k)
                return self.at < self.last
            self._drop(max(0, len(self.held) - 2))
            if not self._more():
                return False
        return False

    def _inflate(self, head_only: bool) -> tuple[bytes, bytes, int] | None:
        """(header, block, compressed length) of the member here; None if it is no WARC record."""
        inflate, data, used = zlib.decompressobj(31), bytearray(), 0
        where = self.at
        self.stream.seek(where + len(self.held))
        part = self.held
        while not inflate.eof:
            if not part:
                part = self.stream.read(CHUNK)
                if not part:
                    return None
            try:
                data += inflate.decompress(part)
            except zlib.error:
                return None
            used += len(part) - len(inflate.unused_data)
            if len(data) >= 5 and data[:5] != b"WARC/":
                return None
            if head_only and b"\r\n\r\n" in data:
                return bytes(data), b"", 0
            part = b""
        cut = data.find(b"\r\n\r\n")
        return None if cut < 0 else (bytes(data[:cut]), bytes(data[cut + 4:]), used)

    def __iter__(self) -> Iterator[tuple[int, dict[str, str], bytes]]:
        synced = False
        while self.at < self.last and self.at < self.size:
            if not synced:
                if not self._candidate():
                    return
                if self._inflate(head_only=True) is None:  # the magic by chance, inside compressed data
                    self._drop(1)
                    continue
            elif not self.held and not self._more():
                return
            got = self._inflate(head_only=False) if self.held[:3] == GZIP or len(self.held) < 3 else None
            if got is None:
                if synced:  # a damaged member: look for the next one
                    synced = False
                self._drop(1)
                continue
            synced = True
            head, block, used = got
            headers = {}
            for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
                name, _, value = line.partition(":")
                headers[name.strip().lower()] = value.strip()
            yield self.at, headers, block[:int(headers.get("content-length", len(block)))]
            if used <= len(self.held):
                self._drop(used)
            else:
                self.at, self.held = self.at + used, b""


def read_warc(files: DataFrame, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """The records of the archives in ``files`` (path, n_bytes), whoever wrote them.

    ``payload`` is the HTTP body of a response (null for others, or when
    ``with_payload`` is off); ``payload_bytes`` and ``payload_digest`` are
    computed from it, for revisits taken from the record's headers.  A damaged
    member is skipped and the scan goes on at the next valid one.
    """
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for batch in batches:
            for row in batch.to_pylist():
                out, size = [], 0
                with open_uri(row["path"]) as stream:
                    for at, h, block in Members(stream, row["first"], row["last"]):
                        http, _, body = block.partition(b"\r\n\r\n")
                        kind, payload, length, sha = h.get("warc-type"), None, None, None
                        if kind == "response":
                            payload, length, sha = body, len(body), digest(body)
                        elif kind == "revisit":
                            m = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
                            length, sha = int(m[1]) if m else None, h.get("warc-payload-digest", "").partition(":")[2] or None
                        out.append((row["path"], at, kind, h.get("warc-record-id"), h.get("warc-refers-to"), h.get("warc-target-uri"),
                                    length, sha, payload if with_payload else None))
                        size += len(block)
                        if size > 4 << 20 or len(out) >= 1000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    ranges = files.select("path", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(split_bytes))).alias("first")) \
        .select("path", "first", F.least(F.col("first") + split_bytes, "n_bytes").alias("last"))
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(n).mapInArrow(read, RECORDS)


def page_records(records: DataFrame) -> DataFrame:
    """Per page: the digest columns of its record, from the archives alone."""
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return records.filter(F.col("record_type").isin("response", "revisit")) \
        .select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))
