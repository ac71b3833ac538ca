"""Word shingles as 64-bit hashes, for many texts at once, and exact likeness of two texts."""

from __future__ import annotations

import numpy as np

SIZE = 5  # words

_rng = np.random.default_rng(20240229)
_odd = lambda n: _rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LETTER = _rng.integers(0, 2**64 - 1, 256, dtype=np.uint64)
_LETTER[65:91] = _LETTER[97:123]  # A-Z count as a-z
_BASE = int(_odd(1)[0])
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _odd(SIZE)
_SHORT = _odd(SIZE)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_P = [_powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)]


def powers(which: int, n: int) -> np.ndarray:
    if len(_P[which]) < n:
        _P[which] = _powers((_BASE, _INVERSE)[which], n)
    return _P[which][:n]


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text: its 5-word windows, the whole sequence if there are
    fewer words, nothing without words."""
    blob = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    n = len(blob)
    white = _WHITE[blob]
    edge = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edge = np.append(0, edge)
    starts, ends = edge[::2], edge[1::2]
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_LETTER[blob] * powers(0, n), out=total[1:])
    word = mix((total[ends] - total[starts]) * powers(1, n)[starts] + (ends - starts).astype(np.uint64))
    after = np.cumsum([len(t) + 1 for t in texts])
    last = np.searchsorted(starts, after)  # words of the texts up to each one
    first = np.append(0, last[:-1])
    windows = np.empty(0, np.uint64)
    if len(word) >= SIZE:
        m = len(word) - SIZE + 1
        windows = word[:m] * _PLACE[0]
        for j in range(1, SIZE):
            windows += word[j:m + j] * _PLACE[j]
        windows = mix(windows)
    out = []
    for a, b in zip(first.tolist(), last.tolist()):
        if b - a >= SIZE:
            out.append(np.unique(windows[a:b - SIZE + 1]))
        elif b > a:
            out.append(mix(np.atleast_1d((word[a:b] * _SHORT[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a))))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())


def batches_of(texts: list, limit: int = 1 << 20):
    """Consecutive ranges (a, b) of texts of about ``limit`` bytes together."""
    a = size = 0
    for k, t in enumerate(texts, 1):
        size += len(t)
        if size > limit or k == len(texts):
            yield a, k
            a, size = k, 0


def parts_of(batches, rows: int):
    """The batches in slices of at most ``rows`` rows, so that few texts are objects at a time."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
