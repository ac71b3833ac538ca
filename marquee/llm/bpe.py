"""Byte-level BPE by merge replay over the distinct words of a batch, and decoding.

A text is split by the vocabulary's pattern; each distinct word is encoded
once.  Replay keeps an inverted index from token pair (named by the rank that
it merges to) to the word positions where the pair stands, takes the ranks in
order, applies a rank at all its positions and re-indexes only the touched
neighbours.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.chunks import plain, spaced_pieces
from marquee.llm.common import keyed

# Words kept per worker before the cache is emptied: bounds memory, never changes a result.
CACHE_WORDS = 500_000


class Replay:
    """Merges of a rank file (base64 token, rank per line) replayed over many words at once."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, f))}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.first = np.array([self.ranks[bytes([b])] for b in range(256)])
        self.byte_pairs = np.array([[self.ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)])
        get = self.ranks.get
        self.shift = max(self.tokens).bit_length()
        self.merges: dict[int, int] = {}  # left rank << shift | right rank -> merged rank
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = get(token[:k]), get(token[k:])
                if a is not None and b is not None:
                    self.merges[a << self.shift | b] = rank

        order = sorted(self.merges)
        self.keys, self.values = np.array([*order, 1 << 62], np.int64), np.array([*(self.merges[k] for k in order), -1], np.int64)

    def _ranks_of(self, left: np.ndarray | int, right: np.ndarray | int) -> np.ndarray:
        """Merged ranks of pairs, -1 where a pair merges to nothing."""
        want = (np.asarray(left) << self.shift) | right
        at = np.searchsorted(self.keys, want)
        return np.where(self.keys[at] == want, self.values[at], -1)

    def _apply_wide(self, index: dict, queue: list, symbols: np.ndarray, before: np.ndarray, after: np.ndarray, pair: np.ndarray,
                    own: np.ndarray) -> np.ndarray:
        """Replay ranks in order, each over all its positions at once, until ranks have few positions left.

        Words (``own`` names each position's) in which merges of a rank overlap
        or bring up a lower rank are set aside: the mask returned.  They are
        replayed from the start, one position at a time.
        """
        few, aside = 0, np.zeros(int(own[-1]) + 1, bool)
        mark, slot = np.zeros(len(own), bool), np.zeros(len(own), np.int64)

        def once(at: np.ndarray) -> np.ndarray:
            n = np.arange(len(at))
            slot[at] = n
            return at[slot[at] == n]

        while queue and few < 40:
            rank = queue[0]
            heapq.heappop(queue)
            parts = index.pop(rank)
            at = once(np.concatenate(parts)) if len(parts) > 1 else parts[0]
            p = at[(pair[at] == rank) & ~aside[own[at]]]
            q = after[p]
            left, right = before[p], after[q]
            low = lambda r: (r >= 0) & (r < rank)
            mark[p] = True
            odd = mark[q] | (right >= 0) & low(self._ranks_of(rank, symbols[right])) | (left >= 0) & low(self._ranks_of(symbols[left], rank))
            if low(self._ranks_of(rank, rank)):
                odd |= (right >= 0) & mark[right]
            mark[p] = False
            if odd.any():
                aside[own[p[odd]]] = True
                p = p[~aside[own[p]]]
                q = after[p]
                left, right = before[p], after[q]
            has_right = right >= 0
            few = few + 1 if len(p) < 40 else max(0, few - 1)
            symbols[p], symbols[q] = rank, -1
            pair[p] = pair[q] = -1
            after[p] = right
            before[right[has_right]] = p[has_right]
            # New neighbours, with the symbols after all merges of this rank.
            from_p, to = p[has_right], right[has_right]
            left = before[p]
            to_p, of = p[left >= 0], left[left >= 0]
            pair[from_p] = self._ranks_of(rank, symbols[to])
            pair[of] = self._ranks_of(symbols[of], symbols[to_p])
            fresh = once(np.concatenate([from_p, of]))
            fresh = fresh[pair[fresh] >= 0]
            if len(fresh):
                fresh = fresh[np.argsort(pair[fresh], kind="stable")]
                names = pair[fresh]
                cut = np.flatnonzero(names[1:] != names[:-1]) + 1
                for r, part in zip(names[np.append(0, cut)].tolist(), np.split(fresh, cut)):
                    if r in index:
                        index[r].append(part)
                    else:
                        index[r] = [part]
                        heapq.heappush(queue, r)
        pair[aside[own]] = -1
        return aside

    def encode(self, words: list[bytes], wide: bool = True) -> list[list[int]]:
        """The ranks of each word's tokens: a word that is a token itself is that token, else lowest rank
        first, leftmost first, as the rank files are defined."""
        out: list[list[int]] = [[] for _ in words]
        ranks, merged, shift = self.ranks, self.merges.get, self.shift
        spans, a = [], 0
        for k, word in enumerate(words):
            whole = ranks.get(word)
            if whole is not None:
                out[k] = [whole]
            elif word:
                spans.append((k, a, a + len(word)))
                a += len(word)
        if not spans:
            return out
        byte = np.frombuffer(b"".join(words[k] for k, _, _ in spans), np.uint8)
        start = np.zeros(a + 1, bool)
        start[[x for _, x, _ in spans]] = start[a] = True
        at = np.arange(a)
        first = self.first[byte]
        symbols = first.copy()
        before, after = np.where(start[:-1], -1, at - 1), np.where(start[1:], -1, at + 1)
        # The index of the first pairs: ranks of all neighbours at once, positions grouped by rank.
        rank = np.append(np.where(start[1:-1], -1, self.byte_pairs[byte[:-1], byte[1:]]), -1)
        here = np.flatnonzero(rank >= 0)
        here = here[np.argsort(rank[here], kind="stable")]
        names = rank[here]
        cut = np.flatnonzero(np.append(True, names[1:] != names[:-1])) if len(here) else np.empty(0, np.int64)
        index = dict(zip(names[cut].tolist(), [[part] for part in np.split(here, cut[1:])])) if len(here) else {}
        queue = list(index)
        heapq.heapify(queue)
        aside = np.zeros(len(spans), bool)
        if wide:
            lengths = np.array([y - x for _, x, y in spans])
            aside = self._apply_wide(index, queue, symbols, before, after, rank, np.repeat(np.arange(len(spans)), lengths))
        index = {r: np.concatenate(parts).tolist() for r, parts in index.items()}
        pair = rank.tolist()  # the rank of the pair that starts at each position, -1 if it merges to nothing
        symbols, before, after = symbols.tolist(), before.tolist(), after.tolist()
        while queue:
            rank = heapq.heappop(queue)
            at = index.pop(rank)
            at.sort()
            rest = iter(at)
            for p in rest:
                if pair[p] != rank:
                    continue  # a neighbour's merge has taken it
                q = after[p]
                left, right = before[p], after[q]
                symbols[p], symbols[q], pair[q] = rank, -1, -1
                after[p] = right
                lower = False
                if right >= 0:
                    before[right] = p
                    pair[p] = r = merged(rank << shift | symbols[right], -1)
                    if r >= 0:
                        if r in index:
                            index[r].append(p)
                        else:
                            index[r] = [p]
                            heapq.heappush(queue, r)
                        lower = r < rank
                else:
                    pair[p] = -1
                if left >= 0:
                    pair[left] = r = merged(symbols[left] << shift | rank, -1)
                    if r >= 0:
                        if r in index:
                            index[r].append(left)
                        else:
                            index[r] = [left]
                            heapq.heappush(queue, r)
                        lower = lower or r < rank
                if lower:  # a lower rank has come up: it goes first, the positions left of this one later
                    if rank not in index:
                        index[rank] = []
                        heapq.heappush(queue, rank)
                    index[rank] += rest
                    break
        for k, a, b in spans:
            out[k] = [s for s in symbols[a:b] if s >= 0]
        again = [spans[j][0] for j in np.flatnonzero(aside).tolist()]
        for k, ids in zip(again, self.encode([words[k] for k in again], wide=False) if again else ()):
            out[k] = ids
        return out


def _one_match(piece: str) -> bool:
    """Latin letters, with one blank before them or none: one match of the pattern."""
    bare = piece[1:] if piece[:1] == " " else piece
    return bare.isalpha() and (bare.isascii() or max(bare) < "ɐ")


class BatchEncoder:
    """Texts to ids and back, with a bounded cache of words."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        self.replay, self.find = Replay(path), regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    def __call__(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        a = size = 0
        for b, t in enumerate(texts, 1):
            size += len(t)
            if size > 4 << 20 or b == len(texts):
                out += self._group(texts[a:b])
                a, size = b, 0
        return out

    def _group(self, texts: list[str]) -> list[bytes]:
        split = [spaced_pieces(t) if plain(t) else [t] for t in texts]  # no match crosses from one piece to the next
        pieces = set().union(*split)
        known = self.known
        new = [p for p in pieces if p not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = list(pieces)
        words, found = set(), {}
        for p in new:
            if _one_match(p):
                words.add(p)
                continue
            core = p.rstrip(".,")  # stops after a word are a match of their own
            found[p] = [core, p[len(core):]] if _one_match(core) else self.find(p)
        words.update(w for f in found.values() for w in f if w not in known)
        known.update(zip(words, [array("I", i).tobytes() for i in self.replay.encode([w.encode() for w in words])], strict=True))
        get = known.__getitem__
        known.update([(p, b"".join(map(get, f))) for p, f in found.items()])
        get = known.__getitem__
        out = [b"".join(map(get, p)) for p in split]
        for t in texts:  # a whole text is no word that comes again
            if len(t) > 4096:
                known.pop(t, None)
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.replay.tokens.__getitem__, array("I", ids)))


_LOADED: dict[tuple[str, str], BatchEncoder] = {}
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def bpe_round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text and decode its ids: token count and digests of ids and decoded bytes.

    Null texts are empty (no tokens); repeated rows and null ids are kept.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (ranks_path, pattern)
        if key not in _LOADED:
            _LOADED[key] = BatchEncoder(*key)
        encoder = _LOADED[key]
        for batch in batches:
            for k in range(0, batch.num_rows, 2000):
                ids = encoder(batch.column(1).slice(k, 2000).to_pylist())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(k, 2000),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(encoder.decode(i)).hexdigest() for i in ids], pa.string()),
                ], names=[c.split()[0] for c in DIGESTS.split(", ")])

    return keyed(docs, id_col, text_col).mapInArrow(encode, DIGESTS)
