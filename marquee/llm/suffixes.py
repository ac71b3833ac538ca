"""Suffix arrays by two-stage sorting, to a bounded depth, in vector operations."""

from __future__ import annotations

import numpy as np

PAD = 16


def word_keys(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one big-endian number (zeros beyond the end)."""
    padded = np.concatenate([text, np.zeros(PAD, np.uint8)])
    return np.ndarray((len(text) + 8,), ">u8", padded, strides=(1,)).astype(np.uint64)


def smaller_than_successor(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that starts a byte later (the last one is not)."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int16), append=np.int16(-1)))
    # A run of equal bytes follows the byte after it.
    at = np.where(step != 0, np.arange(n), n - 1)
    return step[np.minimum.accumulate(at[::-1])[::-1]] > 0


def sort_directly(text: np.ndarray, at: np.ndarray, keys: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` in the order of their first ``depth`` bytes: by eight bytes, ties by the bytes after them."""
    first = keys[at]
    order = np.argsort(first, kind="stable")
    at, first = at[order], first[order]
    same = first[1:] == first[:-1]
    tied = np.append(same, False) | np.append(False, same)
    if depth > 8 and tied.any():
        group = np.cumsum(np.append(True, ~same))[tied]
        padded = np.concatenate([text, np.zeros(depth, np.uint8)])
        rest = np.ndarray((len(text),), f"S{depth - 8}", padded, offset=8, strides=(1,))[at[tied]]
        at[tied] = at[tied][np.lexsort((rest, group))]
    return at


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """All positions of ``text`` (bytes) in the order of the ``depth`` bytes from there on; ties in any order.

    Only suffixes smaller than their successors are sorted.  The others follow
    by one scan of the buckets of first bytes from the smallest: when a suffix
    is reached, the one a byte longer goes to the next place of its own bucket.
    """
    n = len(text)
    if not n:
        return np.empty(0, np.int64)
    small = smaller_than_successor(text)
    directly = sort_directly(text, np.flatnonzero(small), word_keys(text), depth)
    bounds = np.searchsorted(text[directly], np.arange(257))
    placed: list[list[np.ndarray]] = [[] for _ in range(256)]
    placed[int(text[-1])].append(np.array([n - 1]))  # the last suffix comes before all others of its bucket
    out = []
    for c in range(256):
        level = np.concatenate(placed[c]) if placed[c] else np.empty(0, np.int64)
        bucket = []
        while len(level):  # runs of the byte: each suffix brings the one that is longer by this byte
            bucket.append(level)
            level = level[level > 0] - 1
            level = level[text[level] == c]
        bucket.append(directly[bounds[c]:bounds[c + 1]])
        full = np.concatenate(bucket)
        if not len(full):
            continue
        out.append(full)
        before = full[full > 0] - 1
        byte = text[before]
        before, byte = before[byte > c], byte[byte > c]
        if len(before):
            by = np.argsort(byte, kind="stable")
            before, byte = before[by], byte[by]
            cut = np.flatnonzero(byte[1:] != byte[:-1]) + 1
            for part, b in zip(np.split(before, cut), byte[np.append(0, cut)].tolist()):
                placed[b].append(part)
    return np.concatenate(out)


def adjacent_common_prefixes(keys: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the next one, at most ``depth``; no suffix may end before that.

    ``keys`` are the text's word_keys.
    """
    lcp = np.full(max(0, len(order) - 1), depth, np.int64)
    open_ = np.arange(len(lcp))
    a, b = order[:-1], order[1:]
    for off in range(0, depth, 8):
        off = max(0, min(off, depth - 8))
        differ = keys[a + off] ^ keys[b + off]
        stop = differ != 0
        if stop.any():
            x = differ[stop]
            lcp[open_[stop]] = np.minimum(depth, off + sum((x >> np.uint64(64 - 8 * k) == 0).astype(np.int64) for k in range(1, 8)))
            open_, a, b = open_[~stop], a[~stop], b[~stop]
    return lcp
