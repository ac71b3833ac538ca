"""Periodic runs of words: stretches that repeat themselves at a fixed lag, and texts without the repeats.

Words q apart are equal all through a run of period q, so the run is a stretch
of matches on the diagonal of lag q that is at least ``guaranteed`` words long.
Diagonals are found by seeds and extended:

* Lags are handled in classes low .. 2 * low - 1.  A run of four periods has
  at least 3 * low matching words on its diagonal, and a gram of that length
  that lies in the run comes again after q words and not before (it is longer
  than a period).  So it is enough to index the grams of 3 * low words of a
  text and to enumerate neighbouring occurrences whose distance is in the
  class: no run is missed, and there are at most as many pairs as words.
* Grams double in length from class to class; only places whose shorter grams
  occur twice in the same text go on.  Grams are compared exactly (ranks of
  pairs of ranks); hashes only set aside the places that occur once.
* A table per lag holds how far its diagonal has been covered.  Seeds before
  that are passed over, so every diagonal stretch is extended once.

Whole texts are handled, many small ones in one go.  Memory is about 80 bytes
per word of a batch of 4 MB or of the longest text, whose words are read in
slices and never held as one list.  Each row is judged by itself: repeated rows
and null ids give equal results, null and empty texts have no words and no run.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.arrays import words
from marquee.llm.common import keyed, word_slices
from marquee.llm.shingles import batches_of

PERIODS = 4  # a run has at least so many periods
LENGTH = 6  # and at least so many words
SEED = 5  # matching words that a run of period 1 guarantees; longer periods guarantee three periods
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"

_PLACE = np.random.default_rng(20240611).integers(0, 2**63, SEED + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Numbers(dict):
    """Numbers words in the order in which they turn up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers (equal words, equal numbers), and where the words of each text begin (and the last ends)."""
    number = Numbers().__getitem__
    out, bounds = array("q"), [0]
    for text in texts:
        for part in word_slices(text):
            out.extend(map(number, part.split()))
        bounds.append(len(out))
    return np.frombuffer(out, np.int64) if out else np.empty(0, np.int64), np.array(bounds)


def _ranks(keys: np.ndarray) -> np.ndarray:
    return np.unique(keys, return_inverse=True)[1]


def _repeated(places: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Only the places whose rank occurs twice or more, their ranks numbered anew."""
    keep = np.bincount(ranks, minlength=1)[ranks] > 1
    return places[keep], _ranks(ranks[keep])


def _first_seeds(ids: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places whose gram of SEED words occurs again in the same text, in order, and the ranks of (text, gram)."""
    m = len(ids) - SEED + 1
    if m < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hashed = text[:m].astype(np.uint64) * _PLACE[SEED]
    for j in range(SEED):
        hashed += ids[j:m + j].astype(np.uint64) * _PLACE[j]
    order = np.argsort(hashed)
    same = np.diff(hashed[order]) == 0
    twice = np.zeros(m, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    places = np.flatnonzero(twice & (text[:m] == text[SEED - 1:]))
    ranks, top = text[places], len(ids) + 1
    for j in range(SEED):
        ranks = _ranks(ranks * top + ids[places + j])
    return _repeated(places, ranks)


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many words at the start of both are equal (``b`` is not shorter)."""
    done, step = 0, 64
    while done < len(a):
        differ = np.flatnonzero(a[done:done + step] != b[done:done + min(step, len(a) - done)])
        if len(differ):
            return done + int(differ[0])
        done, step = done + step, step * 2
    return len(a)


def periodic_runs(ids: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, in words of the whole array; runs never cross texts."""
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    places, ranks = _first_seeds(ids, text)
    covered: dict[int, int] = {}  # lag -> end of the stretch of its diagonal extended last
    out = []
    size, low, high = SEED, 1, 2  # grams of ``size`` words find the lags low .. high - 1
    while len(places):
        order = np.argsort(ranks, kind="stable")
        at, rank = places[order], ranks[order]
        lag = np.diff(at)
        pair = (rank[1:] == rank[:-1]) & (lag >= low) & (lag < high)
        at, lag = at[:-1][pair], lag[pair]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        head = np.ones(len(at), bool)  # a seed right after another of its lag lies in the same stretch
        head[1:] = (np.diff(lag) != 0) | (np.diff(at) != 1)
        for i, q in zip(at[head].tolist(), lag[head].tolist()):
            done = covered.get(q, 0)
            if i < done:
                continue
            first, last = int(bounds[text[i]]), int(bounds[text[i] + 1])
            floor = max(first, done)
            start = i - _agree(ids[floor:i][::-1], ids[floor + q:i + q][::-1])
            end = i + size + _agree(ids[i + size + q:last], ids[i + size:last])
            covered[q] = end
            if end + q - start >= max(LENGTH, PERIODS * q):
                out.append((start, end + q - start, q))
        step = 1 if size == SEED else size
        after = np.minimum(np.searchsorted(places, places + step), len(places) - 1)
        ok = places[after] == places + step
        places, ranks = _repeated(places[ok], _ranks(ranks[ok] * len(ids) + ranks[after[ok]]))
        size, low, high = size + step, high, 2 * high
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words no run holds after its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth)[:n] == 0


def _collapse(text: bytes, keep: np.ndarray) -> bytes:
    out, at = [], 0
    for part in word_slices(text):
        own = part.split()
        out.extend(compress(own, keep[at:at + len(own)].tolist()))
        at += len(own)
    return b" ".join(out)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed): the maximal runs of four or more periods and six or more words of every
    whole text, by start and period, and the words that no run holds after its first period, joined by one blank."""

    def batch(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        numbers, bounds = word_numbers(texts)
        runs = periodic_runs(numbers, bounds)
        keep = kept_words(len(numbers), runs)
        owner = np.searchsorted(bounds, [r[0] for r in runs], side="right") - 1
        own: list[list[dict]] = [[] for _ in texts]
        for k, (start, length, period) in zip(owner.tolist(), runs):
            own[k].append({"start": start - int(bounds[k]), "length": length, "period": period})
        collapsed = [_collapse(t, keep[a:b]) for t, a, b in zip(texts, bounds[:-1], bounds[1:])]
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.diff(bounds)), pa.array(own, kind),
                                           pa.array(collapsed, pa.binary())], names=["doc_id", "n_words", "runs", "collapsed"])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            ids, texts = rows.column(0).to_pylist(), rows.column(1).to_pylist()
            for a, b in batches_of(texts, 1 << 22):
                yield batch(ids[a:b], texts[a:b])

    rows = keyed(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(find, SCHEMA.replace("collapsed string", "collapsed binary")) \
        .withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then period (null without runs)."""
    def before(a: Column, b: Column) -> Column:
        gain = a["length"] * b["period"] - b["length"] * a["period"]
        return F.when(gain != 0, F.when(gain > 0, -1).otherwise(1)) \
            .when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)) \
            .otherwise(F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
    return F.get(F.array_sort(runs, before), F.lit(0))


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) where the texts whose crc32 of the id is divisible by 10 end in a periodic tail, the others as they are.

    With g = crc32 div 10 and n words the tail starts at word a = g mod n and repeats its first
    1 + (n - a) div (3 + g mod 8) words.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), h.alias("h")) \
        .withColumn("w", F.when(F.col("h") % 10 == 0, words(F.col("text")))) \
        .withColumn("n", F.when(F.size("w") > 0, F.size("w"))) \
        .withColumn("a", F.expr("cast((h div 10) % n as int)")) \
        .withColumn("p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    tail = F.expr("transform(sequence(0, n - a - 1), j -> w[a + j % p])")
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), planted).otherwise(F.col("text")).alias("text"))
