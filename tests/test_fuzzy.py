"""Fuzzy join by deletions and rare grams, and the collapse of near names, against plain loops."""
import random

import pytest

from marquee.operators import conform


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rnd, t, n):
    t = list(t)
    for _ in range(n):
        i, op = rnd.randrange(len(t) + 1), rnd.randrange(3)
        if op == 0:
            t.insert(i, rnd.choice("ab0é"))
        elif i < len(t):
            t[i:i + 1] = [] if op == 1 else [rnd.choice("ab0é")]
    return "".join(t)


@pytest.mark.parametrize("k", [1, 2])
def test_every_pair_within_k_edits(spark, k):
    rnd = random.Random(k)
    base = ["", "a", "aab", "aaaa", "abab", "Supplier#000000123", "Supplier#000000132", "x" * 31, "ab" * 16, "ab" * 17, "a" * 40,
            "The Grand Old Opera House of Springfield", "The Grand Old Opera House of Springdale"]
    left = sorted({edited(rnd, t, rnd.randint(0, 3)) for t in base for _ in range(12)} | set(base))
    right = sorted({edited(rnd, t, rnd.randint(0, 3)) for t in base for _ in range(12)} | set(base))
    rows = spark.createDataFrame([(i % 2, t) for i, t in enumerate(left)] + [(0, None)], "b int, t string")
    dim = spark.createDataFrame([(b, t, f"{b}{t}") for t in right for b in (0, 1)] + [(0, None, "none")], "d int, n string, id string")
    got = {(r.t, r.id, r._dist) for r in conform.fuzzy_candidates(rows, "t", ["b"], dim, "n", ["d"], max_dist=k, keep=["id"]).collect()}
    want = {(t, f"{i % 2}{n}", distance(t, n)) for i, t in enumerate(left) for n in right if distance(t, n) <= k}
    assert got == want


def test_few_pairs_meet(spark):
    """Numbered names of one block: joined pairs per match, printed."""
    s = spark.read.parquet("/root/testdata/sf0.1/supplier.parquet").selectExpr("s_name as _t", "s_nationkey as _b0")
    right = s.withColumnRenamed("_t", "_dt")
    met = conform._meeting(s, right, ["_b0"], 2)
    joined, matches = met.count(), met.distinct().where("levenshtein(_t, _dt) <= 2").count()
    texts, full = s.count(), s.join(right, "_b0").count()
    print(f"{texts} texts, {full} pairs in the blocks, {joined} joined, {matches} within two edits")
    assert joined < 3 * matches


def test_min_len_and_nulls(spark):
    rows = spark.createDataFrame([(1, "abcd"), (1, "abcdefgh"), (None, "abcdefgh")], "b int, t string")
    dim = spark.createDataFrame([(1, "abcx", 1), (1, "abcdefgx", 2)], "b int, n string, id int")
    on_dim = conform.fuzzy_candidates(rows, "t", ["b"], dim.withColumnRenamed("b", "d"), "n", ["d"], min_len=5, keep=["id"])
    assert [(r.t, r.id) for r in on_dim.collect()] == [("abcdefgh", 2)]


def one_by_one(rows, min_len=0, on="kept"):
    stay, out = {}, {}
    for o, b, t in sorted(rows, key=lambda r: (r[0], r[2])):
        if (b, t) in out:
            continue
        near = [k for k in stay.setdefault(b, []) if distance(k, t) <= 2 and len(k if on == "kept" else t) >= min_len]
        out[b, t] = near[0] if near else t
        if not near:
            stay[b].append(t)
    return out


@pytest.mark.parametrize("on,min_len", [("kept", 0), ("kept", 5), ("folded", 6)])
def test_collapse_against_a_plain_loop(spark, on, min_len):
    rnd = random.Random(min_len)
    chain = [(1, 0, "abcdefgh"), (2, 0, "abcdefxy"), (3, 0, "abcdwvxy"), (4, 0, "abqrwvxy"), (5, 0, "klqrwvxy")]  # a ~ b ~ c ~ d ~ e
    back = [(9 - o, 1, t) for o, _, t in chain]
    ties = [(1, 2, "same"), (1, 2, "samf"), (1, 2, "sbmf"), (7, 2, "same")]
    many = [(rnd.randint(0, 30), 3, "".join(rnd.choices("ab", k=rnd.randint(3, 9)))) for _ in range(60)]
    rows = chain + back + ties + many
    random.Random(min_len).shuffle(rows)
    df = spark.createDataFrame(rows + [(0, 0, None)], "o int, b int, t string").repartition(4)
    got = {(r.b, r.t): r.kept for r in conform.collapse_near(df, "t", ["b"], ["o"], min_len=min_len, len_on=on).collect()}
    assert got == one_by_one(rows, min_len, on)


def test_collapse_of_nothing(spark):
    df = spark.createDataFrame([], "o int, b int, t string")
    assert conform.collapse_near(df, "t", ["b"], ["o"]).collect() == []


def test_keys_of_texts_are_not_broadcast(spark):
    """The rests of a small table's texts are many rows: both sides of their join are shuffled, whatever the file's size."""
    s = spark.range(60).selectExpr("concat('Supplier#', lpad(id, 9, '0')) as _t", "id % 3 as _b0")
    for k, meet in ((2, conform._meeting), (3, conform._meeting_by_segments)):
        met = meet(s, s.withColumnRenamed("_t", "_dt"), ["_b0"], k)
        met.collect()
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("max_dist", [1, 2])
def test_collapse_of_many_shapes(spark, max_dist):
    """Names of one and of several lengths, below and above SHORT, blocks without a name or a key, keys called like inner columns."""
    rnd = random.Random(max_dist)
    base = ["", "a", "ab", "aabb", "Supplier#000000123", "0000000000", "x" * 31, "ab" * 16, "ab" * 17, "The Grand Old Opera House of Springfield"]
    rows = [(rnd.randint(0, 40), i % 2, edited(rnd, t, rnd.randint(0, 3))) for t in base for i in range(14)]
    rows += [(rnd.randint(0, 40), 2, "Hall" + "".join(rnd.choices("ab01", k=4)) + "Town") for _ in range(70)]   # one length only: changes and moves
    df = spark.createDataFrame([*rows, (1, None, "abcd"), (2, None, "abce")], "_n int, x int, t string").repartition(3)
    got = {(r.x, r.t): r.kept for r in conform.collapse_near(df, "t", ["x"], ["_n"], max_dist=max_dist).collect()}
    stay, want = {}, {(None, "abcd"): "abcd", (None, "abce"): "abce"}
    for _, b, t in sorted(rows, key=lambda r: (r[0], r[2])):
        if (b, t) not in want:
            near = [k for k in stay.setdefault(b, []) if distance(k, t) <= max_dist]
            want[b, t] = near[0] if near else t
            stay[b] += [] if near else [t]
    assert got == want


@pytest.mark.parametrize("first", [7])
def test_collapse_in_batches(spark, monkeypatch, first):
    """Names decided a few at a time are the same as one by one."""
    monkeypatch.setattr(conform, "FIRST_NAMES", first)
    rnd = random.Random(first)
    rows = [(i, i % 2, "".join(rnd.choices("ab", k=rnd.randint(3, 9)))) for i in range(90)]
    df = spark.createDataFrame(rows, "o int, b int, t string").repartition(4)
    assert {(r.b, r.t): r.kept for r in conform.collapse_near(df, "t", ["b"], ["o"]).collect()} == one_by_one(rows)


def test_names_meet_in_few_rows(spark, monkeypatch):
    """Numbered names of one length: 40 rows of a name are dealt out, and only pairs of numbers are written."""
    written = []
    monkeypatch.setattr(conform, "cut_lineage", lambda d: written.append(d.columns) or d.checkpoint())
    n = 3000
    names = spark.range(n).selectExpr("concat('Supplier#', lpad(id, 9, '0')) as t", "id % 25 as b", "hash(id) as o")
    got = conform.collapse_near(names, "t", ["b"], ["o"])
    assert got.count() == n and got.where("t <> kept").count() > n / 2
    assert [c for c in written if set(c) - {"_id", "_oid"}] == written[:2]
    texts = names.selectExpr("b as _b0", "t as _t", "o as _id")
    dealt = {}
    pairs = conform._two_edits_same_length(texts, ["_b0"], "_t")
    pairs.collect()
    left = [pairs._jdf.queryExecution().executedPlan()]
    while left:
        p = left.pop()
        if p.nodeName() == "Exchange":
            dealt[p.canonicalized().hashCode()] = p.metrics().apply("shuffleRecordsWritten").value()
        left += [p.executedPlan()] if p.nodeName() == "AdaptiveSparkPlan" else [p.plan()] if p.nodeName().endswith("QueryStage") else []
        left += [p.children().apply(i) for i in range(p.children().size())]
    assert 0 < sum(dealt.values()) <= 40 * n
