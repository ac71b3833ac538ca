import base64
import gzip
import hashlib
import io
import random
import zlib

from marquee.llm import warc
from marquee.llm.common import scratch


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def brute(rows, least=0):
    best = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= least:
            best.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        ids = [x for x in best.get(h or "", []) if x is not None]
        keep = max(ids, default=None)
        revisit = (h or "") in best and i != keep and keep is not None
        out.append((i, len((h or "").encode()), b32(h or ""), "revisit" if revisit else "response", keep if revisit else None))
    return out


ROWS = [(1, "http://a/ b\r\nX: y", "<p>é</p>"), (2, None, None), (3, "u", ""), (None, "n", "<p>é</p>"), (5, "v", "<p>é</p>"),
        (6, "w", "x" * 400_000), (7, "w2", "x" * 400_000), (8, "q", "tail\r\n\r\nWARC/1.1\r\n"), (9, "r", "once"), (9, "r", "once"), (-4, "m", "")]


def key(r):
    return tuple((x is not None, x or 0) for x in r)


def test_round_trip(spark):
    df = spark.createDataFrame([(*r, "clash", 1) for r in ROWS], "page_id long, url string, html string, digest string, keeper int")
    for least in (0, 5, 100):
        files = warc.write_warc(df.repartition(3), scratch(spark, "w"), revisit_from=least)
        records = warc.read_warc(files, split_bytes=97)
        got = sorted((tuple(r) for r in warc.page_records(records).collect()), key=key)
        assert got == sorted(brute(ROWS, least), key=key)
        texts = {r.record_id: bytes(r.payload).decode() for r in records.collect() if r.record_type == "response"}
        assert texts["<urn:page:8>"] == ROWS[7][2] and texts["<urn:page:7>"] == ROWS[6][2]
    assert warc.page_records(warc.read_warc(warc.write_warc(df.limit(0), scratch(spark, "w")))).count() == 0


def test_archives_are_plain_gzip(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    for r in warc.write_warc(df, scratch(spark, "w")).collect():
        data = gzip.open(r.path.removeprefix("file:")).read()
        assert data.count(b"WARC/1.1\r\nWARC-Type: ") == r.n_records + 1


def test_ranges_partition_the_records():
    """Whatever the cuts, each record is read once; false magic inside members, garbage and a cut tail are passed over."""
    rng = random.Random(5)
    body, starts = b"", []
    for k in range(80):
        starts.append(len(body))
        block = b"HTTP/1.1 200 OK\r\n\r\n" + rng.randbytes(rng.choice([5, 300])) + warc.GZIP * rng.randint(0, 30)
        head = f"WARC/1.1\r\nWARC-Type: response\r\nX: {k}\r\nContent-Length: {len(block)}\r\n\r\n".encode()
        c = zlib.compressobj(rng.choice([0, 6]), zlib.DEFLATED, 31)
        body += c.compress(head + block + b"\r\n\r\n") + c.flush()
        if k == 40:
            body += b"garbage \x1f\x8b\x08 garbage"
    body += body[:20]

    class File(io.BytesIO):
        def size(self):
            return len(body)

    for step in (64, 333, 1000, len(body)):
        got = [at for a in range(0, len(body), step) for at, _, _ in warc.Members(File(body), a, min(a + step, len(body)))]
        assert got == starts
