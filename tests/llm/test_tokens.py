import hashlib
import io
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from marquee.llm import bpe, packing, tokenfile
from marquee.llm.chunks import library_encoder
from tests.llm.conftest import MESSY


def le32(ids):
    return np.asarray(ids, "<u4").tobytes()


def library(name):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(P.path(name))
    return lambda t: tk.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name,keep", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_cached_encoder_equals_the_library(sample, name, keep):
    enc, ref = library_encoder(P.path(name), keep), library(name)
    texts = [t or "" for _, t in MESSY + sample[1]] + ["a.b, c...", "'s word's 'll", "a ́b STRASSE, Dž ŉ"]
    for t, got in zip(texts, enc(texts), strict=True):
        assert got == le32(ref(t)), t[:80]


def test_simple8b_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 59, 60, 61, 3000):
        for top in (1, 2, 200, 50_257, 2**40, 2**63):
            ids = rng.integers(0, top, n, dtype=np.uint64)
            if n > 100:
                ids[5:90], ids[1] = 3, 2**64 - 1
            assert (tokenfile.unpack(*tokenfile.pack(ids), n) == ids).all()


def test_reader_owns_documents_by_first_block():
    rng = random.Random(2)
    docs = [(k, np.array([rng.randrange(50_000) for _ in range(rng.choice([0, 1, 10, 40_000]))], np.uint32)) for k in range(60)]
    buf = io.BytesIO()
    w = tokenfile.Writer(buf)
    for d, ids in docs:
        w.add(d, ids)
    w.close()
    buf.size = lambda: len(buf.getvalue())
    r = tokenfile.Reader(buf)
    got = []
    for k in range(0, len(r.offsets), 3):
        got += list(r.documents(k, min(k + 3, len(r.offsets))))
    want, at = [], 0
    for d, ids in docs:
        want.append((d, at, ids.tolist()))
        at += len(ids)
    # a document without ids at the very end starts in no block; the operator always adds an end id
    want = [x for x in want if x[1] < at]
    assert [(d, a, i.tolist()) for d, a, i in got] == want


def test_token_files(spark, sample, messy, empty):
    ref = library("byte_bpe_50k.json")
    for df, rows in (sample, (messy, MESSY)):
        got = [tuple(r) for r in tokenfile.token_digests(df, P.path("byte_bpe_50k.json")).collect()]
        want, at = [], 0
        for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
            ids = ref(t) + [0]
            want.append((d, at, len(ids), zlib.crc32(le32(ids))))
            at += len(ids)
        assert sorted(got, key=lambda r: r[1]) == want
    assert tokenfile.token_digests(empty, P.path("byte_bpe_50k.json")).count() == 0


def test_best_fit_decreasing_is_the_plain_algorithm():
    rng = random.Random(3)
    lengths = np.array([rng.randint(1, 64) for _ in range(800)])
    number, at = packing.best_fit(lengths, 64)
    bins, want = [], {}
    for k in sorted(range(800), key=lambda k: (-lengths[k], k)):
        fit = [b for b in range(len(bins)) if bins[b] + lengths[k] <= 64]
        if fit:
            most = max(bins[b] for b in fit)
            want[k] = most
            b = next(b for b in fit if bins[b] == most)
        else:
            bins.append(0)
            want[k] = 0
            b = len(bins) - 1
        bins[b] += lengths[k]
    assert len(bins) == number.max() + 1
    assert [want[k] for k in range(800)] == at.tolist()


def check_packing(df, rows, cap):
    ref = library("word_bpe_49k.json")
    got = [tuple(r) for r in packing.pack_sequences(df, P.path("word_bpe_49k.json"), cap, shard_docs=50).collect()]
    want = []
    for d, t in rows:
        ids = ref(t) + [0]
        want += [(d, n, a, len(ids[a:a + cap]), zlib.crc32(le32(ids[a:a + cap]))) for n, a in enumerate(range(0, len(ids), cap))]
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted((r[:5] for r in got), key=key) == sorted(want, key=key)
    by = {}
    for r in got:
        by.setdefault(r[5], []).append((r[6], r[3]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= cap
    assert len(by) <= 1.1 * sum(r[3] for r in got) / cap + 2 * (1 + len(rows) // 50)


def test_packing(sample, messy, empty):
    check_packing(*sample, 512)
    check_packing(messy, MESSY, 64)
    assert packing.pack_sequences(empty, P.path("word_bpe_49k.json")).count() == 0


def test_bpe_equals_tiktoken(sample, messy, empty):
    import base64
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for df, rows in (sample, (messy, MESSY)):
        got = [tuple(r) for r in bpe.bpe_round_trip(df, path, P.PATTERN).collect()]
        want = [(d, len(i := ref.encode_ordinary(t or "")), sha(le32(i)), sha((t or "").encode())) for d, t in rows]
        key = lambda r: tuple((x is not None, x or 0) for x in r)
        assert sorted(got, key=key) == sorted(want, key=key)
    assert bpe.bpe_round_trip(empty, path, P.PATTERN).count() == 0


def test_replay_takes_a_lower_rank_that_comes_up(tmp_path):
    import base64
    import tiktoken
    tokens = [bytes([b]) for b in range(256)] + [b"aba", b"ab", b"abab", b"bb", b"bab"]
    (tmp_path / "r").write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(tokens)))
    ref = tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})
    rng = random.Random(4)
    words = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 14))) for _ in range(400)]
    assert bpe.Replay(str(tmp_path / "r")).encode(words) == [ref.encode_ordinary(w.decode()) for w in words]


def test_packing_in_many_shards_stays_near_the_least(spark, monkeypatch):
    """Sequences over ceil(tokens / capacity) with one shard and with 25."""
    rng = random.Random(9)
    lengths = [min(2047, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(20_000)]
    df = spark.createDataFrame([(k, 0, 0, n, k) for k, n in enumerate(lengths)], packing.PIECES)
    monkeypatch.setattr(packing, "pieces", lambda *a: df)
    least = -(-sum(lengths) // 2048)
    for shard_docs in (100_000, 800):
        rows = packing.pack_sequences(df, "", 2048, shard_docs=shard_docs).collect()
        assert sorted(r.doc_id for r in rows) == list(range(20_000))
        used: dict = {}
        for r in sorted(rows, key=lambda r: r.offset):
            assert used.get(r.sequence_id, 0) == r.offset
            used[r.sequence_id] = r.offset + r.length
        assert max(used.values()) <= 2048
        print(shard_docs, "shard documents:", len(used), "sequences, least", least)
        assert len(used) <= least + 2
