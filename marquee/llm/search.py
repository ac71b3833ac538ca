"""Ranked lexical search over an index in shards, with range-maximum tables on posting lists.

``build_index`` turns tables of texts into shards of some thousand documents;
a shard has one row per term with its documents and counts.  Documents stay in the
shard of the task that read them, so building shuffles nothing, and a term
that is in every document has one short list per shard.

``search`` takes the items in blocks of a bounded number of terms.  For a block
it sums the corpus counts that scores need, picks the block's terms from the
index, and looks for each item's best documents in every shard:

* all the lists of a shard stand one after another in arrays; a sparse table
  (maxima of windows of 1, 2, 4 ... postings) gives the greatest impact of a term
  between two documents in one step,
* the sum of these maxima over an item's terms bounds the score of every document
  of an interval.  The interval with the greatest bound is taken first and split at
  the document with the greatest single impact in it, whose score is computed;
  intervals whose bound cannot enter the best k are never opened,
* an interval of few documents is not split any more; its postings are added up at once.

The best k of each shard hold the best k of all, which windows pick in two rounds.

A document is a row: repeated rows count, and are listed, as often as they are
there.  Null and empty texts have no terms.  Items are told apart by id and
text; repeated rows of items count once.  Equal scores rank by id (null last).
A shard ends after SHARD_DOCS documents or SHARD_BYTES of text, so memory is
bounded by that or by the longest text, about 60 bytes a byte.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.common import saved, word_slices
from marquee.llm.runs import Numbers

SHARD_DOCS = 8192
SHARD_BYTES = 1 << 25
LEAF = 128  # documents of an interval that are scored together
BLOCK_TERMS = 1 << 16  # terms of items searched together; the last item of a block may exceed it
INDEX = "shard string, term binary, n long, total long, docs binary, counts binary"
HITS = "shard string, item long, doc_id long, score long"

# Separators (ASCII other than letters and digits) become blanks, A-Z small letters; other bytes stay.
_FOLD = bytes(b + 32 if 65 <= b < 91 else b if b > 127 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes) -> Iterator[bytes]:
    for part in word_slices(text.translate(_FOLD)):
        yield from part.split()


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard and term: the numbers of its documents in the shard (u32, ascending) and how often each has it
    (u32); ``n`` counts the documents, ``total`` the occurrences.

    The row without term lists the shard's documents, those without id last: ids (i64, ascending, as far as there are
    ids) and the numbers of terms of all (i64); ``n`` counts the documents with a term, ``total`` their terms.
    """
    def shard_rows(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k] or 0))
        vocabulary, flat, lengths = Numbers(), [], []
        for k in order:
            own = np.fromiter(map(vocabulary.__getitem__, terms(texts[k])), np.int64)
            flat.append(own)
            lengths.append(len(own))
        keys, counts = np.unique(np.concatenate(flat) * len(ids) + np.repeat(np.arange(len(ids)), lengths), return_counts=True)
        term, doc = np.divmod(keys, len(ids))
        cut = np.append(np.flatnonzero(np.diff(term, prepend=-1)), len(term))
        totals = np.add.reduceat(counts, cut[:-1]) if len(term) else []
        doc, counts = doc.astype("<u4").tobytes(), counts.astype("<u4").tobytes()
        spans = [slice(4 * a, 4 * b) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        names = [None, *vocabulary]
        listed = np.array([ids[k] for k in order if ids[k] is not None], "<i8").tobytes()
        return pa.RecordBatch.from_arrays([
            pa.array([uuid.uuid4().hex] * len(names)), pa.array(names, pa.binary()), pa.array([sum(n > 0 for n in lengths), *np.diff(cut)], pa.int64()),
            pa.array([sum(lengths), *totals], pa.int64()),
            pa.array([listed, *[doc[s] for s in spans]], pa.binary()),
            pa.array([np.array(lengths, "<i8").tobytes(), *[counts[s] for s in spans]], pa.binary())],
            names=[c.split()[0] for c in INDEX.split(", ")])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for rows in batches:
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                ids.append(doc)
                texts.append(text.as_py())
                size += len(texts[-1])
                if len(ids) == SHARD_DOCS or size > SHARD_BYTES:
                    yield from sliced(shard_rows(ids, texts))
                    ids, texts, size = [], [], 0
        if ids:
            yield from sliced(shard_rows(ids, texts))

    def sliced(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(0, rows.num_rows, 20_000):
            yield rows.slice(k, 20_000)

    rows = docs.select(F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    return saved(rows.mapInArrow(build, INDEX), "index")


class Shard:
    """The posting lists of a shard's terms, one after another, with the range maxima of their impacts."""

    def __init__(self, lists: list[tuple[np.ndarray, np.ndarray, int]], factor: np.ndarray) -> None:
        """``lists``: documents, counts and weight of each term; ``factor``: 12 m of each document."""
        self.n = len(factor)
        self.cut = np.cumsum([0] + [len(d) for d, _, _ in lists])
        self.doc = np.concatenate([d for d, _, _ in lists]).astype(np.int64)
        count = np.concatenate([c for _, c, _ in lists]).astype(np.int64)
        weight = np.repeat(np.array([w for _, _, w in lists], np.int64), np.diff(self.cut))
        self.keys = self.doc + np.repeat(np.arange(len(lists)), np.diff(self.cut)) * self.n
        self.impact = weight * ((1_000_000_000 * count) // (1000 * count + factor[self.doc]))
        self.maxima = [self.impact]  # of 1, 2, 4 ... postings from each one on; windows that reach into the next list are never asked for
        longest, width = int(np.diff(self.cut).max()), 1
        while 2 * width <= longest:
            last = self.maxima[-1]
            self.maxima.append(np.maximum(last[:len(last) - width], last[width:]))
            width *= 2

    def most(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The greatest impact of each list among its postings low .. high - 1 (0 if there are none)."""
        size = high - low
        level = np.frexp(size.astype(np.float64))[1] - 1
        out = np.zeros(len(low), np.int64)
        for v in np.unique(level[size > 0]).tolist():
            own = np.flatnonzero((level == v) & (size > 0))
            table = self.maxima[v]
            out[own] = np.maximum(table[low[own]], table[high[own] - (1 << v)])
        return out

    def best(self, term: np.ndarray, times: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, document) of the ``k`` best documents with a score above 0 for the terms (list numbers) of an item."""
        n = self.n
        kept: list[tuple[int, int]] = []  # a heap of (score, -document): the worst first

        def offer(score: int, doc: int) -> None:
            if score > 0:
                if len(kept) < k:
                    heapq.heappush(kept, (score, -doc))
                elif (score, -doc) > kept[0]:
                    heapq.heapreplace(kept, (score, -doc))

        def interval(first: int, last: int, low: np.ndarray, high: np.ndarray) -> None:
            if first < last:
                most = times * self.most(low, high)
                bound = int(most.sum())
                if bound and (len(kept) < k or (bound, -first) > kept[0]):
                    heapq.heappush(waiting, (-bound, first, last, low, high, most))

        waiting: list = []
        interval(0, n, self.cut[term], self.cut[term + 1])
        while waiting:
            bound, first, last, low, high, most = heapq.heappop(waiting)
            if len(kept) == k and (-bound, -first) <= kept[0]:
                break  # no interval that waits can do better: bounds fall, and first rises at equal bounds
            if last - first <= LEAF:
                size = high - low
                at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                score = np.zeros(last - first, np.int64)
                np.add.at(score, self.doc[at] - first, np.repeat(times, size) * self.impact[at])
                for d in np.argsort(-score, kind="stable")[:k].tolist():
                    offer(int(score[d]), first + d)
                continue
            top = int(most.argmax())
            a, b = int(low[top]), int(high[top])
            doc = int(self.doc[a + int(self.impact[a:b].argmax())])
            at = np.searchsorted(self.keys, term * n + doc)
            held = (at < high) & (self.keys[np.minimum(at, len(self.keys) - 1)] == term * n + doc)
            offer(int((times[held] * self.impact[at[held]]).sum()), doc)
            interval(first, doc, low, at)
            interval(doc + 1, last, at + held, high)
        return sorted(((s, -d) for s, d in kept), key=lambda r: (-r[0], r[1]))


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, n, terms): distinct items with their terms and how often each is there; ``item`` is a number."""
    kind = pa.list_(pa.struct([("term", pa.binary()), ("times", pa.int64())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for text in rows.column("text"):
                own: dict[bytes, int] = {}
                for term in terms(text.as_py()):
                    own[term] = own.get(term, 0) + 1
                out.append([{"term": t, "times": c} for t, c in own.items()])
            yield pa.RecordBatch.from_arrays([rows.column("item"), rows.column("item_id"), pa.array([len(o) for o in out], pa.int64()),
                                              pa.array(out, kind)], names=["item", "item_id", "n", "terms"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")).distinct() \
        .select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return rows.mapInArrow(read, "item long, item_id long, n long, terms array<struct<term: binary, times: long>>")


def search(index: DataFrame, items: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest scores above 0 for each item."""
    spark = index.sparkSession
    asked = saved(_item_terms(items, id_col, text_col), "items")
    corpus = _corpus(index)
    blocks = saved(_blocks(asked), "blocks")
    n_blocks = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    hits = None
    for block in range(n_blocks):
        own = blocks.filter(F.col("block") == block).join(asked, "item").select("item", F.explode("terms").alias("t")).select("item", "t.*")
        found = saved(_search_block(index, own, corpus, k), f"hits{block}")
        hits = found if hits is None else hits.unionByName(found)
    ranked = F.row_number().over(Window.partitionBy("item", "part").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    some = hits.withColumn("part", F.crc32(F.col("shard").cast("binary")) % 64).withColumn("rank", ranked).filter(F.col("rank") <= k).drop("rank", "part")
    ranked = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    best = some.withColumn("rank", ranked).filter(F.col("rank") <= k)
    return best.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _corpus(index: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and all their terms."""
    row = index.filter("term is null").agg(F.sum("n"), F.sum("total")).first()
    return row[0] or 0, row[1] or 0


def _blocks(asked: DataFrame) -> DataFrame:
    """(item, block): items in order, BLOCK_TERMS terms to a block; running sums in two levels."""
    parts = asked.select("item", "n").withColumn("part", F.shiftright("item", 16))
    sums = parts.groupBy("part").agg(F.sum("n").alias("s"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("s").over(order), F.lit(0))).drop("s")
    inside = Window.partitionBy("part").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(before, "part") \
        .select("item", F.floor((F.col("before") + F.col("inside")) / BLOCK_TERMS).alias("block"))


def _search_block(index: DataFrame, own: DataFrame, corpus: tuple[int, int], k: int) -> DataFrame:
    """The best ``k`` of every shard for the items of one block, whose terms (a bounded number) go to all tasks."""
    n_docs, n_terms = corpus
    wanted = F.broadcast(own.select("term").distinct())
    df = index.join(wanted, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.ln((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("long")
    rows = own.join(df, "term").select("item", "term", "times", weight.alias("w")).collect()
    weights = {bytes(r.term): r.w for r in rows}
    items: dict[int, list[tuple[bytes, int]]] = {}
    for r in rows:
        items.setdefault(r.item, []).append((bytes(r.term), r.times))

    def look(table: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        lists, out = [], []
        for row in table.select(["term", "docs", "counts"]).to_batches():
            for term, docs, counts in zip(*row.to_pydict().values()):
                if term is None:
                    ids, length = np.frombuffer(docs, "<i8"), np.frombuffer(counts, "<i8")
                else:
                    place[term] = len(lists)
                    lists.append((np.frombuffer(docs, "<u4"), np.frombuffer(counts, "<u4"), weights[term]))
        if lists:
            shard = table.column("shard")[0].as_py()
            held = Shard(lists, 12 * (75 + (25 * length * n_docs) // n_terms))
            for item, pairs in items.items():
                here = [(place[t], c) for t, c in pairs if t in place]
                if here:
                    term, times = (np.array(v, np.int64) for v in zip(*here))
                    out += [(shard, item, int(ids[d]) if d < len(ids) else None, s) for s, d in held.best(term, times, k)]
        columns = list(zip(*out)) or [()] * 4
        return pa.table({c.split()[0]: pa.array(v, t) for c, v, t in zip(HITS.split(", "), columns, [pa.string()] + [pa.int64()] * 3)})

    some = index.join(wanted, "term", "left_semi").unionByName(index.filter("term is null").select("term", *[c for c in index.columns if c != "term"]))
    return some.groupBy("shard").applyInArrow(look, HITS)
