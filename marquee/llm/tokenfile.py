"""Token-id files: Simple-8b words, escapes, block offsets; written and read by Spark tasks.

File layout (little endian)::

    magic | block ... block | footer | footer length (u64) | magic
    block  = n_ids u32, n_words u32, n_escapes u32, 0 u32, words u64[], escapes u64[]
    footer = n_blocks u64, n_docs u64, block offset u64[], ids before block u64[],
             doc id i64[], ids of doc u64[], doc id is null u8[]

A word's top four bits select how many ids of how many bits its 60 other bits
hold.  Selector 0 is a run of one id (32 bits id, 28 bits count), selector 15
an escape: one id of over 60 bits, whose value is the block's next escape.
Blocks decode on their own, each selector's words in one vector operation.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.chunks import library_encoder
from marquee.llm.common import keyed, saved, scratch

MAGIC = b"S8BTOK01"
BLOCK_IDS = 1 << 16
RANGE_BLOCKS = 64  # blocks that one reading row stands for
COUNTS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 1])
WIDTHS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0])
SELECTOR = np.zeros(61, np.uint64)  # by count; 0 is a run
SELECTOR[COUNTS[1:15]] = np.arange(1, 15)
MANIFEST = "path string, first_doc long, n_docs long, n_ids long, n_blocks long"


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words and escaped values of one block of unsigned ids."""
    n = len(ids)
    ids = np.concatenate([ids.astype(np.uint64), np.zeros(60, np.uint64)])
    if ids.max() < 1 << 52:
        bits = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    else:
        bits = np.searchsorted(np.uint64(1) << np.arange(64, dtype=np.uint64), ids, side="right").astype(np.uint8)
    high = {1: bits}  # most bits among the c ids from here on
    for c in (2, 4, 8, 16, 32):
        prev = high[c // 2]
        high[c] = np.maximum(prev[:-(c // 2)], prev[c // 2:])
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    step = np.ones(n, np.uint8)
    for s in range(13, 0, -1):
        c = int(COUNTS[s])
        p = 1 << (c.bit_length() - 1)
        fits = np.maximum(high[p][:n], high[p][c - p:c - p + n]) <= WIDTHS[s]
        np.maximum(step, fits.view(np.uint8) * np.uint8(c), out=step)
    change = np.append(np.flatnonzero(ids[1:n] != ids[:n - 1]), n - 1)
    run = np.repeat(change, np.diff(change, prepend=-1)) - np.arange(n) + 1
    step[(run > step) & (bits[:n] <= 32)] = 0  # a run
    jumps, starts, at = step.tobytes(), [], 0
    while at < n:
        starts.append(at)
        at += jumps[at] or int(run[at])
    starts = np.array(starts, dtype=np.int64)
    select = SELECTOR[step[starts]]
    select[(step[starts] == 1) & (bits[starts] > 60)] = 15
    words = select << np.uint64(60)
    for s in range(1, 15):
        own = np.flatnonzero(select == s)
        if len(own):
            lanes = np.lib.stride_tricks.sliding_window_view(ids, COUNTS[s])[starts[own]]
            words[own] |= lanes @ (np.uint64(1) << (np.arange(COUNTS[s]) * WIDTHS[s]).astype(np.uint64))
    own = select == 0
    words[own] |= ids[starts[own]] | (run[starts[own]].astype(np.uint64) << np.uint64(32))
    return words, ids[starts[select == 15]]


def unpack(words: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a block."""
    select = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[select]
    runs = select == 0
    counts[runs] = (words[runs] >> np.uint64(32)) & np.uint64((1 << 28) - 1)
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in range(1, 15):
        own = np.flatnonzero(select == s)
        if len(own):
            lanes = np.arange(COUNTS[s])
            out[at[own][:, None] + lanes] = (words[own][:, None] >> (lanes * WIDTHS[s]).astype(np.uint64)) & np.uint64((1 << int(WIDTHS[s])) - 1)
    for k in np.flatnonzero(runs):
        out[at[k]:at[k] + counts[k]] = words[k] & np.uint64(0xFFFFFFFF)
    out[at[select == 15]] = escapes
    return out[:n]


class Writer:
    """Appends documents' ids to one file; holds at most a block of ids and the document table."""

    def __init__(self, stream) -> None:
        self.stream, self.waiting, self.n_waiting = stream, [], 0
        self.offsets, self.before, self.docs, self.lengths = [], [], [], []
        self.n_ids, self.pos = 0, len(MAGIC)
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        if self.n_waiting >= BLOCK_IDS:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // BLOCK_IDS * BLOCK_IDS
            for k in range(0, whole, BLOCK_IDS):
                self._block(ids[k:k + BLOCK_IDS])
            self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        words, escapes = pack(ids)
        body = np.array([len(ids), len(words), len(escapes), 0], "<u4").tobytes() + words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()
        self.offsets.append(self.pos)
        self.before.append(self.n_ids)
        self.stream.write(body)
        self.pos += len(body)
        self.n_ids += len(ids)

    def close(self) -> None:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        footer = b"".join([np.array([len(self.offsets), len(self.docs)], "<u8").tobytes(),
                           np.array(self.offsets, "<u8").tobytes(), np.array(self.before, "<u8").tobytes(),
                           np.array([d or 0 for d in self.docs], "<i8").tobytes(), np.array(self.lengths, "<u8").tobytes(),
                           bytes(d is None for d in self.docs)])
        self.stream.write(footer + len(footer).to_bytes(8, "little") + MAGIC)


class Reader:
    """Random access to the blocks of one file through its footer."""

    def __init__(self, stream) -> None:
        self.stream = stream
        size = stream.size()
        stream.seek(size - 16)
        tail = stream.read(16)
        if tail[8:] != MAGIC:
            raise ValueError("not a token file, or cut short")
        self.end = size - 16 - int.from_bytes(tail[:8], "little")
        stream.seek(self.end)
        footer = stream.read(size - 16 - self.end)
        blocks, docs = np.frombuffer(footer, "<u8", 2).astype(int)
        cut = np.cumsum([16, 8 * blocks, 8 * blocks, 8 * docs, 8 * docs, docs])
        part = [footer[a:b] for a, b in zip(cut, cut[1:])]
        self.offsets, self.before = (np.frombuffer(p, "<u8").astype(np.int64) for p in part[:2])
        self.docs, self.lengths = np.frombuffer(part[2], "<i8"), np.frombuffer(part[3], "<u8").astype(np.int64)
        self.null = np.frombuffer(part[4], np.uint8).astype(bool)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def block(self, k: int) -> np.ndarray:
        a = self.offsets[k]
        b = self.offsets[k + 1] if k + 1 < len(self.offsets) else self.end
        self.stream.seek(int(a))
        body = self.stream.read(int(b - a))
        n, words, escapes, _ = np.frombuffer(body, "<u4", 4).astype(int)
        return unpack(np.frombuffer(body, "<u8", words, 16), np.frombuffer(body, "<u8", escapes, 16 + 8 * words), n)

    def documents(self, first: int, last: int) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(id, ids before it in the file, ids) of the documents that start in blocks first .. last - 1."""
        low = self.before[first]
        high = self.before[last] if last < len(self.before) else np.iinfo(np.int64).max
        block, held, base = first, np.empty(0, np.uint64), int(low)
        for k in range(*np.searchsorted(self.starts, [low, high])):
            a = int(self.starts[k])
            b = a + int(self.lengths[k])
            parts, end = [held], base + len(held)
            while end < b:
                parts.append(self.block(block))
                end += len(parts[-1])
                block += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield None if self.null[k] else int(self.docs[k]), a, held[a - base:b - base]
            held, base = held[b - base:], b


def open_uri(uri: str, write: bool = False):
    """A stream on any file system that Arrow knows (local, HDFS, S3 ...)."""
    from pyarrow import fs
    system, path = fs.FileSystem.from_uri(uri)
    if write:
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(path, compression=None)
    return system.open_input_file(path)


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = 0) -> DataFrame:
    """Encode every text, append ``end_id``, write one file per range of ids; returns the manifest.

    Null texts are empty (the end id alone); null ids sort first; equal ids
    sort by text.  Each task attempt writes a file of a new name; only files
    whose task Spark committed are in the manifest, so a retried or speculative
    task leaves nothing that is read.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer_path, keep_space=True, entries=800_000)
        writer = stream = path = None
        first = None
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for k in range(0, len(ids), 256):
                part = ids[k:k + 256]
                for doc, tokens in zip(part, encoder(batch.column(1).slice(k, 256).to_pylist()), strict=True):
                    if writer is None:
                        path, first = f"{folder}/part-{uuid.uuid4().hex}.s8b", doc
                        stream = open_uri(path, write=True)
                        writer = Writer(stream)
                    writer.add(doc, np.append(np.frombuffer(tokens, "<u4"), np.uint32(end_id)))
        if writer is not None:
            writer.close()
            stream.close()
            row = [path, first, len(writer.docs), writer.n_ids, len(writer.offsets)]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.string()] + [pa.int64()] * 4)],
                                             names=[c.split()[0] for c in MANIFEST.split(", ")])

    rows = keyed(docs, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return saved(rows.mapInArrow(write, MANIFEST), "manifest")


def read_token_files(manifest: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, start, ids binary): every document of the files, its ids as little-endian u32; start counts over all files.

    With ``digest``, (doc_id, start, n_tokens, ids_crc32) of the ids read instead of the ids.
    """
    schema = "doc_id long, start long, " + ("n_tokens long, ids_crc32 long" if digest else "ids binary")
    types = [pa.int64()] * 4 if digest else [pa.int64(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_uri(row["path"]) as stream:
                    out: list[tuple] = []
                    for doc, at, ids in Reader(stream).documents(row["first_block"], row["last_block"]):
                        raw = ids.astype("<u4").tobytes()
                        out.append((doc, row["base"] + at, *((len(ids), zlib.crc32(raw)) if digest else (raw,))))
                        if len(out) == 256:
                            yield rows(out)
                            out = []
                    if out:
                        yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[c.split()[0] for c in schema.split(", ")])

    # One row per file: the running sum over the files is small however many documents there are.
    order = Window.orderBy(F.col("first_doc").asc_nulls_first(), "path").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    ranges = based.select("path", "base", "n_blocks", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1, F.lit(RANGE_BLOCKS))).alias("first_block")) \
        .select("path", "base", "first_block", F.least(F.col("first_block") + RANGE_BLOCKS, "n_blocks").alias("last_block"))
    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(n).mapInArrow(read, schema)


def token_digests(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files, read them back, digest each document's ids."""
    folder = scratch(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, tokenizer_path, folder, id_col, text_col), digest=True)
