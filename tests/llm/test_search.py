"""Ranked search against scoring every document, with small shards, leaves and blocks."""
import math
import random
import re

import pytest

from marquee.llm import search
from marquee.llm.queries import QUERIES

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, k=20):
    rows = [(d, TERM.findall((t or "").translate(LOWER))) for d, t in docs]
    rows = [(d, w, {x: w.count(x) for x in set(w)}) for d, w in rows if w]
    n_docs, n_terms, df = len(rows), sum(len(w) for _, w, _ in rows), {}
    for _, _, tf in rows:
        for x in tf:
            df[x] = df.get(x, 0) + 1
    out = []
    for item, text in {(i, t or "") for i, t in items}:
        scored = []
        for d, w, tf in rows:
            m = 75 + 25 * len(w) * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (1000000000 * tf[x] // (1000 * tf[x] + 12 * m))
                    for x in TERM.findall(text.translate(LOWER)) if x in tf)
            scored.append((-s, d is None, d, s))
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, r + 1, d, s) for r, (_, _, d, s) in enumerate(scored[:k]) if s > 0]
    return sorted(out, key=str)


def run(spark, docs, items, k=20):
    d = spark.createDataFrame([(i, t, 1, "z") for i, t in docs], "doc_id long, text string, score int, term string").repartition(3)
    q = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, rank string")
    return sorted((tuple(r) for r in search.search(search.build_index(d), q, k).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_scoring_all(spark, seed, monkeypatch):
    rnd = random.Random(seed)
    vocabulary = [f"w{int(rnd.paretovariate(0.7))}" for _ in range(4000)] + ["Ünï", "日本", "the", "THE"]
    docs = [(d, ", ".join(rnd.choices(vocabulary, k=rnd.choice([0, 1, 5, 40, 120])))) for d in range(900)]
    docs += [(d + 5000, docs[d][1]) for d in range(200)] + [(7, "the the w1"), (7, "the the w1"), (None, "w1 w2 the"), (None, None), (9999, "")]
    docs += [(6000 + d, "copy of one w1 w2 w3 text") for d in range(300)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 3, 20])))) for i in range(25)]
    items += [(100, "copy of one w1 w2 w3 text"), (100, "copy of one w1 w2 w3 text"), (100, "the"), (101, None), (102, "nowhere"), (None, "the w1 w1 w1")]
    want = brute(docs, items)
    assert run(spark, docs, items) == want
    for name, value in (("LEAF", 1), ("BLOCK_TERMS", 40)):  # the driver's copies; the tasks' come with the code
        monkeypatch.setattr(search, name, value)
    assert run(spark, docs, items) == want


def test_small_leaves_and_shards(monkeypatch):
    import numpy as np
    rnd = random.Random(3)
    monkeypatch.setattr(search, "LEAF", 1)
    for _ in range(300):
        n, t = rnd.randint(1, 60), rnd.randint(1, 6)
        lists = []
        for _ in range(t):
            own = sorted(rnd.sample(range(n), rnd.randint(1, n)))
            lists.append((np.array(own), np.array([rnd.randint(1, 3) for _ in own]), rnd.randint(0, 40)))
        factor = np.array([rnd.choice([900, 1200]) for _ in range(n)])
        times = [rnd.randint(1, 3) for _ in range(t)]
        score = [0] * n
        for (d, c, w), x in zip(lists, times):
            for doc, count in zip(d.tolist(), c.tolist()):
                score[doc] += x * w * (10**9 * count // (1000 * count + int(factor[doc])))
        want = sorted(((s, d) for d, s in enumerate(score) if s > 0), key=lambda r: (-r[0], r[1]))[:5]
        assert search.Shard(lists, factor).best(np.arange(t), np.array(times), 5) == want


def test_opens_few_intervals(monkeypatch):
    """A document with a rare term is found without scoring the documents that only have the common one."""
    import numpy as np
    n = 1 << 14
    common = (np.arange(n), np.ones(n, int), 3)
    rare = (np.arange(0, n, 700), np.ones(len(range(0, n, 700)), int), 9000)
    asked, most = [], search.Shard.most
    monkeypatch.setattr(search.Shard, "most", lambda self, low, high: asked.append(1) or most(self, low, high))
    best = search.Shard([common, rare], np.full(n, 1200)).best(np.arange(2), np.ones(2, int), 20)
    assert [d for _, d in best] == list(range(0, 700 * 20, 700))
    assert len(asked) < 100


def test_empty_tables(spark, messy, empty):
    items = spark.createDataFrame([(1, "the repeated row")], "item_id long, text string")
    assert search.search(search.build_index(empty), items).count() == 0
    index = search.build_index(messy)
    assert search.search(index, items.limit(0)).count() == 0
    assert [(r.rank, r.doc_id) for r in search.search(index, items).collect()][:2] == [(1, 7), (2, 7)]


def test_long_text(spark):
    docs = [(1, "alpha beta " * 600_000), (2, "alpha"), (3, "gamma " * 1000 + "alpha")]
    assert run(spark, docs, [(1, "alpha gamma")]) == brute([(d, t) for d, t in docs], [(1, "alpha gamma")])


def test_query(spark, sample):
    items = [(r.item_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in QUERIES["op13_lexical_search"](spark, "/root/testdata/sf0.001").collect()), key=str)
    assert got == brute(sample[1], items)
