import hashlib
import random

import numpy as np
import pytest

from marquee.llm import substrings, suffixes
from tests.llm.conftest import MESSY


@pytest.mark.parametrize("seed", range(8))
def test_two_stage_sorting(seed):
    rng = random.Random(seed)
    alphabet = [b"ab", bytes(range(256)), b"a", b"abc\xff"][seed % 4]
    text = bytes(rng.choice(alphabet) for _ in range(600))
    text = text + text[100:300] + b"\xff" + text[50:90] * 3
    depth = [5, 30, 100, 2000][seed % 4]
    t = np.frombuffer(text, np.uint8)
    order = suffixes.suffix_array(t, depth)
    assert sorted(order.tolist()) == list(range(len(text)))
    cut = [text[i:i + depth] for i in order.tolist()]
    assert cut == sorted(cut)
    inner = order[order <= len(text) - 30]
    lcp = suffixes.adjacent_common_prefixes(suffixes.word_keys(t), inner, 30)
    for a, b, n in zip(inner.tolist(), inner.tolist()[1:], lcp.tolist()):
        x, y = text[a:a + 30], text[b:b + 30]
        assert n == next((k for k in range(30) if x[k] != y[k]), 30)


def brute(rows, length):
    """Expected (id, n_bytes, n_removed, n_spans, sha256) by a dictionary of all windows."""
    low = -(1 << 63)
    raw = [((low if d is None else d), (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in raw:
        for s in range(len(b) - length + 1):
            w = b[s:s + length]
            first[w] = min(first.get(w, (d, s)), (d, s))
    out = []
    for d, b in raw:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s:s + length]] < (d, s):
                gone[s:s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((None if d == low else d, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in substrings.remove_repeats(df, **kw).collect()), key=str)


def test_messy(spark, messy, empty):
    assert run(messy, length=20, gram=8) == brute(MESSY, 20)
    assert run(messy) == brute(MESSY, 100)
    assert run(empty) == []


@pytest.mark.parametrize("hot", [1, 3, 1000])
def test_planted(spark, hot):
    """Copies, shared passages in differing surroundings, periodic texts, repeated ids; few or many hot grams."""
    rng = random.Random(hot)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(12) for _ in range(4)]
    rows = []
    for k in range(60):
        t = text(rng.randint(0, 40)) + "".join(rng.choice(passages) + text(rng.randint(0, 9)) for _ in range(rng.randint(0, 4)))
        rows.append((k, t))
        if k % 7 == 0:
            rows.append((k + 1000, t))
        if k % 11 == 0:
            rows.append((k, t + " tail"))
        if k % 13 == 0:
            rows.append((k + 2000, "xy " * rng.randint(5, 90)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert run(df, length=24, gram=8, hot_docs=hot) == brute(rows, 24)


def test_a_gram_at_many_places_of_few_documents_is_hot(spark):
    from marquee.llm.substrings import _repeated
    df = spark.createDataFrame([(5, 1, 30), (6, 1, 1), (6, 2, 1), (7, 3, 1), (8, 4, 2)], "h long, did long, places int")
    got = {r.did: (sorted(r.hs), sorted(r.hot)) for r in _repeated(df, 20).collect()}
    assert got == {1: ([6], [5]), 2: ([6], []), 4: ([8], [])}
