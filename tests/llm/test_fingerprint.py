import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from marquee.llm import fingerprint as fp
from tests.llm.conftest import MESSY


def parts(text):
    """Elements: distinct parts with multiplicity."""
    import re
    return set(Counter(re.split(fp.PARTS, text)).items()) if text else set()


def expected(rows):
    rows = [(d, t or "") for d, t in rows]
    order = sorted((r for r in rows if r[0] is not None))
    out = []
    for d, t in rows:
        nxt = "" if d is None else None
        out.append((d, t, nxt))
    placed = [(d, t, order[(k + 1) % len(order)][1]) for k, (d, t) in enumerate(order)] + [x for x in out if x[0] is None]
    res = []
    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    for d, t, n in placed:
        half = len(t) // 2
        edited = t[:len(t) - half] + n[:half]
        res.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(like(parts(t), parts(edited)), 9), round(like(parts(t), parts(n)), 9)))
    return sorted(res, key=str)


def run(df):
    got = fp.fingerprints(df).collect()
    return sorted(((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got), key=str), got


def test_messy_and_sample(spark, messy, empty, sample):
    assert run(messy)[0] == expected(MESSY)
    assert run(sample[0])[0] == expected(sample[1])
    assert run(empty)[0] == []


def test_order_across_buckets_and_equal_texts(spark):
    rng = random.Random(1)
    rows = [(rng.choice([-1, 1]) * rng.randrange(1, 10**rng.randint(1, 7)), "\n".join(rng.choice("abcdefg") * 3 for _ in range(rng.randint(0, 9)))) for _ in range(150)]
    rows = list(dict(rows).items())
    got, raw = run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got == expected(rows)
    seen = {}
    for (d, t), r in zip(sorted(rows), sorted(raw, key=lambda r: r.doc_id)):
        assert seen.setdefault(t, r.fingerprint) == r.fingerprint


def test_peeling_recovers_the_difference_and_retries(spark):
    """Differences far beyond the sketch are found at a larger size; a stuck sketch says so."""
    rng = random.Random(2)
    digests = [rng.randrange(-2**63, 2**63) for _ in range(400)]
    rows = [(digests[:n] + digests[200:260], digests[n // 2:n] + digests[300:300 + m]) for n in (0, 1, 5, 60, 150) for m in (0, 3, 80)]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>")
    size = lambda c: fp.sketch_size(F.col(c))
    df = df.select("a", "b", fp.differing(fp.sketch(F.col("a"), size("a")), F.col("a"), size("a"), fp.sketch(F.col("b"), size("b")), F.col("b"), size("b")).alias("n"),
                   fp.peeled(fp.grouped(F.concat(fp.spread(F.col("a"), F.lit(4)), fp.minus(fp.spread(F.col("b"), F.lit(4))))), F.lit(4)).alias("tiny"),
                   fp.peeled(fp.grouped(F.concat(fp.spread(F.col("a"), F.lit(4096)), fp.minus(fp.spread(F.col("b"), F.lit(4096))))), F.lit(4096)).alias("large"))
    for r in df.collect():
        a, b = set(r.a), set(r.b)
        assert r.n == len(a ^ b)
        if not r.large.cells:
            assert {(e.k, e.n) for e in r.large.found} == {(k, 1) for k in a - b} | {(k, -1) for k in b - a}
        assert bool(r.tiny.cells) or len(r.tiny.found) == len(a ^ b)
