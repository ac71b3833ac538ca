"""Best-fit decreasing packing of documents into sequences of bounded length.

Every piece of a document is a row (length, document, piece).  Pieces are
spread over shards so that each shard gets the same mixture of lengths, and
each shard packs its own pieces by best-fit decreasing.  What the shards leave
partly empty, a few sequences each, is packed again together, so the number of
sequences does not grow with that of the shards, and a lost task repeats one
shard only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.chunks import library_encoder
from marquee.llm.common import keyed, saved

SHARD_DOCS = 32_768
SPARE = 1 / 32  # a sequence with so much room left is packed again


class Bins:
    """Open bins under a segment tree over remaining capacities.

    Leaf c holds the bins with c tokens left; an inner node tells whether any
    leaf below it has a bin.  The tightest fitting bin is the first non-empty
    leaf at or right of the wanted length: a climb and a descent, logarithmic
    in the number of capacities.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.used: list[int] = []

    def _change(self, left: int, by: int) -> None:
        k = left + self.size
        while k:
            self.count[k] += by
            k >>= 1

    def tightest(self, length: int) -> int:
        """The least remaining capacity of at least ``length`` among the open bins, or -1."""
        k = length + self.size
        if self.count[k]:
            return length
        while k > 1:
            if not k & 1 and self.count[k + 1]:
                k += 1
                while k < self.size:
                    k <<= 1
                    if not self.count[k]:
                        k += 1
                return k - self.size
            k >>= 1
        return -1

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of the next piece."""
        left = self.tightest(length)
        if left < 0:
            left = self.capacity
            self.used.append(0)
            number = len(self.used) - 1
        else:
            number = self.bins[left].pop()
            self._change(left, -1)
        at = self.used[number]
        self.used[number] += length
        if left > length:
            self.bins[left - length].append(number)
            self._change(left - length, 1)
        return number, at


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, placed in decreasing order (ties: in the given order)."""
    number, at = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    bins = Bins(capacity)
    for k in np.argsort(-lengths, kind="stable").tolist():
        number[k], at[k] = bins.put(int(lengths[k]))
    return number, at


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, id_col: str = "doc_id",
           text_col: str = "text", end_id: int = 0) -> DataFrame:
    """Token pieces of every document: ids of the whole text and the end id, cut only beyond ``max_tokens``.

    Null texts are empty: one piece that holds the end id.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        encoder = library_encoder(tokenizer_path, keep_space=False)
        for batch in batches:
            out: list[tuple] = []
            texts = batch.column(1)
            for k in range(0, len(texts), 256):
                ids = batch.column(0).slice(k, 256).to_pylist()
                for doc, tokens in zip(ids, encoder(texts.slice(k, 256).to_pylist()), strict=True):
                    tokens += end_id.to_bytes(4, "little")
                    step = 4 * max_tokens
                    out += [(doc, n, a // 4, min(step, len(tokens) - a) // 4, zlib.crc32(tokens[a:a + step]))
                            for n, a in enumerate(range(0, len(tokens), step))]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=[c.split()[0] for c in PIECES.split(", ")])

    return keyed(docs, id_col, text_col).mapInArrow(cut, PIECES)


def _packed(rest: DataFrame, max_tokens: int, shard_docs: int, first: int) -> tuple[DataFrame, int]:
    """Pieces with their sequence (numbers from ``first`` on), packed in shards of about ``shard_docs`` pieces; the number of shards."""
    shards = max(1, -(-rest.count() // shard_docs))

    def place(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("doc_id", "piece", "start", "ids_crc32")])
        number, at = best_fit(table["length"].to_numpy(), max_tokens)
        return pa.table([*table.drop_columns(["shard"]).columns, pa.array(first + number * shards + key[0].as_py()), pa.array(at)],
                        names=[*table.column_names[:-1], "sequence_id", "offset"])

    placed = rest.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("int")) \
        .groupBy("shard").applyInArrow(place, PIECES + ", sequence_id long, offset long")
    return placed, shards


def pack_sequences(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, id_col: str = "doc_id",
                   text_col: str = "text", end_id: int = 0, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for every piece.

    Repeated rows and null ids are packed like any other row.  A shard holds
    the pieces of about ``shard_docs`` documents, drawn by a hash of the row
    number, whatever the size of the input.  The sequences that the shards have
    left with room for ``SPARE`` of their tokens or more are taken apart and
    packed once more together, in shards of their own, while that makes fewer shards.
    """
    cut = saved(pieces(docs, tokenizer_path, max_tokens, id_col, text_col, end_id), "pieces")
    full = cut.filter(F.col("length") == max_tokens)  # a full piece is a sequence of its own
    rest, out, first = cut.filter(F.col("length") < max_tokens), None, 0
    while True:
        placed, shards = _packed(rest, max_tokens, shard_docs, first)
        if shards == 1:
            break
        placed, first = saved(placed, "placed"), first + (1 << 40)
        used = placed.groupBy("sequence_id").agg(F.sum("length").alias("used")).filter(F.col("used") <= max_tokens * (1 - SPARE)).select("sequence_id")
        again = saved(placed.join(used, "sequence_id", "left_semi").drop("sequence_id", "offset"), "open")
        done = placed.join(used, "sequence_id", "left_anti").select(*placed.columns)
        out = done if out is None else out.unionByName(done)
        if -(-again.count() // shard_docs) >= shards:  # most sequences have room that no piece fits: another round would change little
            placed, _ = _packed(again, max_tokens, shard_docs, first)
            break
        rest = again
    out = placed if out is None else out.unionByName(placed)
    alone = full.withColumn("sequence_id", -F.monotonically_increasing_id() - 1).withColumn("offset", F.lit(0).cast("long"))
    return out.unionByName(alone)
