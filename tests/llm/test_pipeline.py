"""The pipeline's stages against brute-force versions and on awkward rows."""
import numpy as np
import public_tokenizers as P

import corpus_pipeline as cp
from marquee.llm import toxicity
from tests.llm import test_neardup, test_quality, test_suffixes
from tests.llm.conftest import MESSY

DIR = "/root/testdata/sf0.001"


def test_stage_by_stage(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    a = cp.quality_rules(spark, docs, DIR).cache()
    left = {r.doc_id for r in a.collect()}
    assert a.columns == docs.columns and left <= {d for d, r in rows.items() if not test_quality.base(r.text)[-1]} and len(left) > 0.6 * len(rows)
    b = cp.drop_toxic(spark, a, DIR).cache()
    model = toxicity.train(a, spark.read.parquet(f"{DIR}/labels.parquet"))
    assert {r.doc_id for r in b.collect()} == {d for d in left if model.score(rows[d].text) < 0.3}
    c = cp.near_duplicates(spark, b, DIR).cache()
    pairs = [(r.doc_id, r.text) for r in b.collect()]
    assert sorted(r.doc_id for r in c.collect()) == sorted(x[0] for x in test_neardup.brute(pairs) if x[3])
    d = cp.repeated_passages(spark, c, DIR).cache()
    kept = sorted(r.doc_id for r in c.collect())
    want = {x[0]: x[1] - x[2] for x in test_suffixes.brute([(k, rows[k].text) for k in kept], 100)}
    got = d.collect()
    assert d.columns == docs.columns and all(want[r.doc_id] - 6 * 4 * 40 <= len(r.text.encode()) <= want[r.doc_id] and r.n_chars == len(r.text) for r in got)
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    n = {r.doc_id: len(tk.encode(r.text, add_special_tokens=False).ids) + 1 for r in got}
    e = cp.pack(spark, d, DIR).collect()
    assert {k: sum(r.length for r in e if r.doc_id == k) for k in n} == n
    used = {}
    for r in e:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert max(used.values()) <= 2048 and len(used) <= np.ceil(sum(n.values()) / 2048) * 1.1 + 2


def test_awkward_rows(spark):
    rows = [(d, t, None, None if k % 2 else "s", None, k) for k, (d, t) in enumerate(MESSY)] + [(3, "w " * 80, "en", "s", 1, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row int")
    for some in (docs, docs.limit(0)):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, some, DIR)
            assert out.columns == docs.columns
            out.count()
        assert cp.pack(spark, some, DIR).count() >= some.count()
    assert cp.near_duplicates(spark, docs, DIR).count() == len({d for d, _ in MESSY if d is not None}) + 1
