"""Periodic runs against every lag tried one by one; planted tails; messy rows."""
import hashlib
import random
import zlib

from marquee.llm.queries import QUERIES
from marquee.llm.runs import find_runs, periodic_runs, with_planted_runs, word_numbers

WHITE = b" \t\n\x0b\x0c\r"


def brute(words):
    """Every stretch of matches at every lag, without those that a shorter period explains."""
    found = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            part = words[start:start + length]
            if i > start and length >= max(6, 4 * q) and not any(part[d:] == part[:-d] for d in range(1, q)):
                found.append((start, length, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapse(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def test_against_every_lag():
    rnd = random.Random(11)
    for _ in range(1500):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            letters, words = "abcdefgh"[:rnd.choice([1, 2, 3, 6])], []
            for _ in range(rnd.randint(0, 5)):
                unit = [rnd.choice(letters) for _ in range(rnd.randint(1, 9))]
                words += (unit * rnd.randint(1, 9))[:rnd.randint(1, 50)]
            texts.append(words)
        ids, bounds = word_numbers([" ".join(t).encode() for t in texts])
        want = [(s + int(bounds[k]), n, q) for k, t in enumerate(texts) for s, n, q in brute(t)]
        assert sorted(periodic_runs(ids, bounds)) == sorted(want)


def test_seeds_that_repeat_inside_a_period():
    words = list("aaaaaab" * 5 + "x" + "abcabcabd" * 4)
    ids, bounds = word_numbers([" ".join(words).encode()])
    assert periodic_runs(ids, bounds) == brute(words)


def test_one_long_text():
    ids, bounds = word_numbers([b"ab " * 900_000 + b"tail", b"ab ab ab ab ab ab"])
    assert periodic_runs(ids, bounds) == [(0, 900_000, 1), (900_001, 6, 1)]


def test_messy(spark, messy, empty):
    assert find_runs(empty).count() == 0
    rows = find_runs(messy).collect()
    texts = sorted(((r.text or "").encode() for r in messy.collect()))
    want = sorted((len(t.split()), str(brute(t.split())), collapse(t.split(), brute(t.split()))) for t in texts)
    got = sorted((r.n_words, str([tuple(x) for x in r.runs]), r.collapsed.encode()) for r in rows)
    assert got == want
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(r.doc_id for r in messy.collect() if r.doc_id is not None)


def planted(doc_id, text):
    words, h = text.encode().split(), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query(spark, sample):
    got = {r.doc_id: r for r in QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(sample[1])
    for doc, text in sample[1]:
        words = planted(doc, text or "")
        found, r = brute(words), got[doc]
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapse(words, found)).hexdigest()


def test_planted_tails(spark, messy):
    for r in with_planted_runs(messy).filter("doc_id is not null").collect():
        text = next((x.text or "") for x in messy.filter(f"doc_id = {r.doc_id}").collect())
        assert r.text.encode().split() == planted(r.doc_id, text)
