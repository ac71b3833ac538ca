"""Removal of long repeated substrings across documents, by suffix arrays over the places that can repeat.

Every window of ``LENGTH`` bytes picks its minimizer, the gram of ``GRAM`` bytes
with the least hash, leftmost among equals; equal windows pick equal grams.

1. Grams that are picked at one place only cannot lie in a repeated window.
   One shuffle of the picked hashes tells the others, by document.
2. Consecutive windows of a document with the same repeated gram form a short
   segment.  Segments meet by the hash of their gram.  A task that has seen the
   same segment before marks the later one at once and ships the first only.
   Grams that very many places pick are split further: their windows go
   one by one, by the hash of the whole window.
3. In each partition equal segments are reduced to the first; over the others
   a suffix array is built, and neighbours that share ``LENGTH`` bytes are equal
   windows, of which all but the first are marked.
4. Marks and texts meet by document, and marked bytes are cut.

A step holds a batch of texts (or the longest text, about 90 bytes a byte), the
segments of HOT_PLACES places at most, or one suffix array of SORT_BYTES and
the segments of one gram; no step compares pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import saved
from marquee.llm.shingles import batches_of, mix, parts_of, powers
from marquee.llm.suffixes import adjacent_common_prefixes, suffix_array, word_keys

LENGTH, GRAM = 100, 32
# A gram that more places pick than this has its windows sent one by one.
HOT_PLACES = 20_000
SORT_BYTES = 1 << 20  # text per suffix array
SEPARATOR = 255  # no byte of UTF-8

# Values of the bytes (case is not folded).
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _prefix_hash(blob: np.ndarray) -> np.ndarray:
    total = np.empty(len(blob) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[blob] * powers(0, len(blob)), out=total[1:])
    return total


def _span_hash(total: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix((total[b] - total[a]) * powers(1, len(total))[a])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` consecutive ones: blockwise running minima from both sides."""
    n = len(values)
    blocks = -(-n // width)
    full = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = values
    grid = full.reshape(blocks, width)
    from_left = np.minimum.accumulate(grid, axis=1).ravel()
    from_right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(from_right[:n - width + 1], from_left[width - 1:n])


class Picked:
    """The picked grams of some texts: runs of windows with the same gram."""

    def __init__(self, texts: list[bytes], length: int, gram: int) -> None:
        self.blob_bytes = b"".join(texts)
        blob = np.frombuffer(self.blob_bytes, np.uint8)
        size = np.array([len(t) for t in texts])
        self.base = np.cumsum(size) - size
        empty = np.empty(0, np.int64)
        self.first = self.count = self.text = empty
        self.hash = np.empty(0, np.uint64)
        if len(blob) < length:
            return
        self.total = _prefix_hash(blob)
        at = np.arange(len(blob) - gram + 1)
        grams = _span_hash(self.total, at, at + gram)
        # High half: hash, low half: place; the least is the least hash, leftmost.
        least = window_minima((grams & np.uint64(0xFFFFFFFF00000000)) | at.astype(np.uint64), length - gram + 1)
        place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
        own = np.repeat(np.arange(len(texts)), size)
        inside = np.zeros(len(blob), bool)  # windows that do not cross into the next text
        for a, n in zip(self.base.tolist(), size.tolist()):
            inside[a:max(a, a + n - length + 1)] = True
        w = np.flatnonzero(inside[:len(place)])
        if not len(w):
            return
        p = place[w]
        new = np.append(True, (p[1:] != p[:-1]) | (w[1:] != w[:-1] + 1))
        k = np.flatnonzero(new)
        self.first, self.text = w[k], own[w[k]]  # first window of each run
        self.count = np.diff(np.append(k, len(w)))
        self.hash = grams[p[k]]


def _postings(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, did, places): each document's distinct picked hashes with the number of windows that picked them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts_of(batches, 500):
            dids = batch.column(0).to_numpy()
            texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
            for a, b in batches_of(texts):
                got = Picked(texts[a:b], length, gram)
                if not len(got.hash):
                    continue
                order = np.lexsort((got.hash, got.text))
                h, d = got.hash[order], got.text[order]
                first = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])))
                places = np.diff(np.append(first, len(h)))
                yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(dids[a:b][d[first]]), pa.array(places.astype(np.int32))],
                                                 names=["h", "did", "places"])

    return rows.mapInArrow(run, "h long, did long, places int")


def _repeated(postings: DataFrame, hot_places: int) -> DataFrame:
    """(did, hs, hot): per document the hashes that are picked at two places or more, those picked at very many apart."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = np.empty(0, np.int64)
        held = (empty, empty, empty)
        hot_run = None  # the hash of a run that has been found hot and is passed on

        def out(h: np.ndarray, d: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(d), pa.array(h), pa.array(hot)], names=["did", "h", "hot"])

        def settled(h: np.ndarray, d: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
            start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            n = np.repeat(np.add.reduceat(places, start), np.diff(np.append(start, len(h))))
            twice = np.append(False, (h[1:] == h[:-1]) & (d[1:] == d[:-1]))  # one row per document is enough
            keep = (n > 1) & ~twice
            return out(h[keep], d[keep], n[keep] > hot_places)

        for batch in batches:
            if not batch.num_rows:
                continue
            h, d, places = (np.append(x, batch.column(k).to_numpy()) for k, x in enumerate(held))
            if hot_run is not None:
                k = int(np.searchsorted(h != hot_run, True)) if (h != hot_run).any() else len(h)
                if k:
                    yield out(h[:k], d[:k], np.ones(k, bool))
                h, d, places = h[k:], d[k:], places[k:]
                if not len(h):
                    held = (empty, empty, empty)
                    continue
                hot_run = None
            cut = len(h) - int(np.argmax(h[::-1] != h[-1])) if (h != h[-1]).any() else 0  # the last run may go on
            if cut:
                yield settled(h[:cut], d[:cut], places[:cut])
            held = (h[cut:], d[cut:], places[cut:])
            if held[2].sum() > hot_places:
                hot_run = held[0][0]
                yield out(held[0], held[1], np.ones(len(held[0]), bool))
                held = (empty, empty, empty)
        if len(held[0]):
            yield settled(*held)

    found = postings.repartition("h").sortWithinPartitions("h", "did").mapInArrow(run, "did long, h long, hot boolean")
    return found.groupBy("did").agg(F.collect_list(F.when(~F.col("hot"), F.col("h"))).alias("hs"), F.collect_list(F.when(F.col("hot"), F.col("h"))).alias("hot"))


SEGMENT = "r long, seg binary, did long, th int, start long, stop long"


def _segments(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments to compare (seg set), and marks of segments that this task has met before (seg null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in parts_of(batches, 2000):
            dids, ths, hs, hots = (batch.column(k).to_pylist() for k in (0, 1, 3, 4))
            texts = [unpack(z) for z in batch.column(2).to_pylist()]
            first: dict[bytes, list[tuple]] = {}  # segment -> (did, start, th, r) of its first places
            marks: list[tuple] = []

            def meet(seg: bytes, did: int, start: int, th: int, r: int) -> None:
                had = first.setdefault(seg, [])
                if not had or (did, start) < had[0][:2]:
                    marks.extend((d, t, s, s + len(seg)) for d, s, t, _ in had)
                    first[seg] = [(did, start, th, r)]
                elif (did, start) > had[0][:2]:
                    marks.append((did, th, start, start + len(seg)))
                elif all(th != x[2] for x in had):
                    had.append((did, start, th, r))

            for lo, hi in batches_of(texts):
                got = Picked(texts[lo:hi], length, gram)
                wanted = np.zeros(len(got.hash), bool)
                hot = np.zeros(len(got.hash), bool)
                bounds = np.searchsorted(got.text, np.arange(hi - lo + 1))
                signed = got.hash.view(np.int64)
                for k in range(hi - lo):
                    a, b = bounds[k], bounds[k + 1]
                    if a < b:
                        hot[a:b] = np.isin(signed[a:b], hots[lo + k])
                        wanted[a:b] = np.isin(signed[a:b], hs[lo + k])
                blob, base = got.blob_bytes, got.base.tolist()
                for k in np.flatnonzero(wanted).tolist():
                    t, a = int(got.text[k]), int(got.first[k])
                    meet(blob[a:a + int(got.count[k]) + length - 1], dids[lo + t], a - base[t], ths[lo + t], int(signed[k]))
                for k in np.flatnonzero(hot).tolist():
                    t, n = int(got.text[k]), int(got.count[k])
                    at = np.arange(int(got.first[k]), int(got.first[k]) + n)
                    own = _span_hash(got.total, at, at + length).view(np.int64).tolist()
                    for a, r in zip(at.tolist(), own):
                        meet(blob[a:a + length], dids[lo + t], a - base[t], ths[lo + t], r)
            # Marks go on under random keys, merged to runs.
            out = [(r, seg, d, t, s, s + len(seg)) for seg, places in first.items() for d, s, t, r in places]
            out += [(d ^ a, None, d, t, a, b) for d, t, a, b in merged(marks)]
            for k in range(0, len(out), 20_000):
                part = list(zip(*out[k:k + 20_000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(part, (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                                 names=[c.split()[0] for c in SEGMENT.split(", ")])

    return rows.mapInArrow(run, SEGMENT)


def merged(marks: list[tuple]) -> list[tuple]:
    """(did, th, start, stop) with overlapping and touching ranges of a document joined."""
    out: list[tuple] = []
    for d, t, a, b in sorted(marks):
        if out and out[-1][:2] == (d, t) and a <= out[-1][3]:
            if b > out[-1][3]:
                out[-1] = (d, t, out[-1][2], b)
        else:
            out.append((d, t, a, b))
    return out


def later_windows(segs: list[tuple], length: int) -> list[tuple]:
    """Marks of the windows in distinct segments (bytes, did, th, start) that an earlier place also holds, by a suffix array."""
    text = np.frombuffer(b"".join(s[0] + b"\xff" for s in segs), np.uint8)
    size = np.array([len(s[0]) + 1 for s in segs])
    own = np.repeat(np.arange(len(segs)), size)
    base = np.cumsum(size) - size
    off = np.arange(len(text)) - base[own]
    whole = off <= size[own] - 1 - length
    order = suffix_array(text, length)
    order = order[whole[order]]
    lcp = adjacent_common_prefixes(word_keys(text), order, length)
    group = np.append(0, np.cumsum(lcp < length))
    pair = np.append(lcp >= length, False) | np.append(False, lcp >= length)
    at, group = order[pair], group[pair]
    if not len(at):
        return []
    did = np.array([s[1] for s in segs], np.int64)[own[at]]
    start = np.array([s[3] for s in segs], np.int64)[own[at]] + off[at]
    by = np.lexsort((start, did, group))
    at, group, did, start = at[by], group[by], did[by], start[by]
    head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    n = np.diff(np.append(head, len(at)))
    later = (did != np.repeat(did[head], n)) | (start != np.repeat(start[head], n))
    flags = np.zeros(len(text) + 1, np.int8)
    flags[at[later]] = 1
    edge = np.flatnonzero(np.diff(flags, prepend=np.int8(0)))
    out = []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):  # a run never leaves its segment: the last bytes start no window
        _, d, t, s = segs[own[a]]
        out.append((d, t, s + int(off[a]), s + int(off[a]) + b - a - 1 + length))
    return out


def _marks(segments: DataFrame, length: int) -> DataFrame:
    """(did, th, start, stop): byte ranges that earlier places also hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []  # distinct segments: bytes, did, th, start
        size, key, last = 0, None, None

        def rows(marks: list[tuple]) -> pa.RecordBatch:
            part = list(zip(*merged(marks))) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["did", "th", "start", "stop"])

        for batch in batches:
            marks: list[tuple] = []
            for r, seg, did, th, start, stop in zip(*(c.to_pylist() for c in batch.columns)):
                if seg is None:
                    marks.append((did, th, start, stop))
                    continue
                if r != key:  # segments of one key are compared in one suffix array
                    if size >= SORT_BYTES:
                        marks += later_windows(waiting, length)
                        waiting, size = [], 0
                    key, last = r, None
                if last is not None and seg == last[0]:
                    if (did, start) != (last[1], last[3]):
                        marks.append((did, th, start, stop))
                        continue
                    if th == last[2]:
                        continue
                last = (seg, did, th, start) if last is None or seg != last[0] else last
                waiting.append((seg, did, th, start))
                size += len(seg)
            yield rows(marks)
        if waiting:
            yield rows(later_windows(waiting, length))

    return segments.repartition("r").sortWithinPartitions("r", "seg", "did", "start", "th").mapInArrow(run, "did long, th int, start long, stop long")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), as_text: bool = False, length: int = LENGTH,
                   gram: int = GRAM, hot_docs: int = HOT_PLACES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept, and the columns ``carry`` in the struct extra, for every row.

    ``kept`` are the bytes left, or with ``as_text`` the text that they make,
    without the parts of characters that were cut through.

    A byte goes if a ``length``-byte string that covers it also starts earlier:
    in a row with a smaller id, or at a smaller offset of the same id.  Null
    texts are empty; null ids come before all others; rows that repeat an id do
    not remove each other's bytes at the same offset.  ``hot_docs``: places (of all
    documents) from which on the windows of a gram go one by one.
    """
    did = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(did.alias("did"), F.hash(text).alias("th"), text.alias("text"), F.struct(F.lit(0).alias("_"), *carry).alias("extra"))
    extra = rows.schema["extra"].dataType.simpleString()

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pack = zstandard.ZstdCompressor(level=3, write_content_size=True, write_checksum=False).compress
            for k in range(0, batch.num_rows, 1000):
                z = [pack(t.encode("utf-8", "surrogatepass")) for t in batch.column(2).slice(k, 1000).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1000), batch.column(1).slice(k, 1000), pa.array(z, pa.binary()), batch.column(3).slice(k, 1000)],
                                                 names=["did", "th", "z", "extra"])

    small = rows.mapInArrow(squeeze, f"did long, th int, z binary, extra {extra}")
    repeated = _repeated(_postings(rows, length, gram), hot_docs)
    # The texts of documents with repeated grams; rows that repeat an id with the same text are one.
    meeting = small.drop("extra").join(repeated, "did").select("did", "th", "z", "hs", "hot")
    marks = saved(_marks(_segments(meeting, length, gram), length), "marks")
    cuts = marks.groupBy("did", "th").agg(F.collect_list(F.struct("start", "stop")).alias("cuts"))
    result = f"doc_id long, n_bytes long, n_removed long, n_spans long, kept {'string' if as_text else 'binary'}, extra {extra}"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                out = []
                for z, cuts in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    raw = unpack(z)
                    spans = [m[2:] for m in merged([(0, 0, c["start"], c["stop"]) for c in cuts or ()])]
                    ends = [0, *(x for s in spans for x in s), len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2]))
                    out.append((len(raw), len(raw) - len(kept), len(spans), kept.decode("utf-8", "ignore") if as_text else kept))
                cols = list(zip(*out))
                ids = part.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([None if i == -(1 << 63) else i for i in ids], pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:3]],
                                                  pa.array(cols[3], pa.string() if as_text else pa.binary()), part.column(3)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "extra"])

    return small.join(cuts, ["did", "th"], "left").select("did", "z", "cuts", "extra").mapInArrow(cut, result)
