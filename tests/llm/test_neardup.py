import itertools
import random
import re

import numpy as np
import pytest

from marquee.llm import graph, neardup, shingles
from tests.llm.conftest import MESSY


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """Expected (id, n_shingles, component, kept): all pairs, links closed; rows with one id are one document."""
    sets = [grams(t) for _, t in rows]
    up = {d: d for d, _ in rows if d is not None}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for (i, a), (j, b) in itertools.combinations([(d, s) for (d, _), s in zip(rows, sets) if d is not None and s], 2):
        both = len(a & b)
        if 100 * both >= 75 * (len(a) + len(b) - both):
            x, y = sorted((find(i), find(j)))
            up[y] = x
    return sorted(((d, len(s), None if d is None else find(d), d is None or find(d) == d) for (d, _), s in zip(rows, sets)), key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in neardup.near_duplicates(df, **kw).collect()), key=str)


def test_shingle_sets_count_and_compare_like_tuples():
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["a", "b", "É", "Z", "z"]) for _ in range(rng.randint(0, 30))) + rng.choice(["", "\x0b\t x"]) for _ in range(60)]
    texts += ["", " ", "one", "a b", "b a", "A B", "a b c d e f"]
    got, want = shingles.shingle_sets([t.encode() for t in texts]), [grams(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for i, j in itertools.combinations(range(len(texts)), 2):
        assert shingles.common(got[i], got[j]) == len(want[i] & want[j])


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**64 - 1, 6000, dtype=np.uint64)
    a, b = np.unique(pool[:4000]), np.unique(pool[1000:4500])
    ra, rb, rab = neardup.registers([a, b, np.union1d(a, b)])
    assert (np.maximum(ra, rb) == rab).all()
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    got = neardup.estimate(ra[None], rb[None], np.array([float(len(a))]), np.array([float(len(b))]))[0]
    assert abs(got - true) < 0.15


def test_components(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(rng.randrange(3000, 3200), rng.randrange(3000, 3200)) for _ in range(150)]
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_messy(spark, messy, empty):
    assert run(messy) == brute(MESSY)
    assert run(empty) == []


@pytest.mark.parametrize("block", [8, 256])
def test_groups_of_copies(spark, monkeypatch, block):
    """A large group of edited copies around one text, chains of copies of copies, shared passages, short texts."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rng = random.Random(block)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(120)]

    def edit(words, n):
        out = list(words)
        for _ in range(n):
            out[rng.randrange(len(out))] = word()
        return out

    texts = [base] + [edit(base, rng.randint(0, 9)) for _ in range(120)]
    chain = base
    for _ in range(12):
        chain = edit(chain, 3)
        texts.append(chain)
    texts += [base[:60] + [word() for _ in range(rng.randint(5, 60))] for _ in range(30)] + [[word() for _ in range(rng.randint(0, 8))] for _ in range(30)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    rows += [(900 + k, rows[k][1].upper()) for k in range(0, 100, 9)] + [(5, "an id that has another text too")]
    rng.shuffle(rows)
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == brute(rows)


def test_strangers_do_not_multiply_a_large_component(spark):
    """Rows of a bucket of 20,000 near-copies and one stranger: every copy goes round once, the stranger once per block."""
    from pyspark.sql import functions as F
    from marquee.llm.neardup import BLOCK, in_blocks, open_buckets
    rows = spark.range(20_001).select(F.lit(0).alias("band"), F.lit(7).alias("key"), F.col("id").alias("rep"), F.when(F.col("id") == 5, 5).otherwise(0).cast("long").alias("component"))
    alone = spark.range(300).select(F.lit(1).alias("band"), F.lit(8).alias("key"), F.col("id").alias("rep"), F.lit(0).cast("long").alias("component"))
    got = in_blocks(rows.unionByName(alone).join(open_buckets(rows.unionByName(alone)), ["band", "key"])).cache()
    blocks = -(-20_000 // BLOCK)
    assert got.count() == 20_000 + 1 + blocks
    meets = got.filter("component = 5").select("bi", "bj").distinct()
    assert got.filter("component = 0").join(meets, ["bi", "bj"]).select("rep").distinct().count() == 20_000


def test_rows_of_different_components_share_a_pair_of_blocks(spark):
    import itertools
    import random
    from marquee.llm import neardup
    rnd = random.Random(4)
    rows = [(0, 1, i, rnd.choice([0, 0, 0, 1, 2, 3])) for i in range(900)]
    df = spark.createDataFrame(rows, "band int, key int, rep long, component long")
    got = neardup.in_blocks(df.join(neardup.open_buckets(df), ["band", "key"])).collect()
    sides: dict = {}
    for r in got:
        sides.setdefault((r.bi, r.bj), []).append((r.own, r.rep, r.component))
    met = {(min(a, b), max(a, b)) for (bi, bj), rs in sides.items() for oa, a, ca in rs if oa == bi for ob, b, cb in rs if ob == bj and ca != cb and a != b}
    assert met >= {(a[2], b[2]) for a, b in itertools.combinations(rows, 2) if a[3] != b[3]}
