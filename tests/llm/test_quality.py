import random
import re

from marquee.llm import quality
from tests.llm.conftest import MESSY


def base(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    tri = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
    count = {}
    for t in tri:
        count[t] = count.get(t, 0) + 1
    hit = {k + j for k, t in enumerate(tri) if count[t] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n)


def check(df, rows):
    got = quality.score_quality(df).collect()
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got), key=key) == \
        sorted(((d, *base(t)) for d, t in rows), key=key)
    assert all(not (r.base_failed and r.kept) for r in got)
    return got


def test_counts(spark, messy, empty, sample):
    check(messy, MESSY)
    check(sample[0], sample[1])
    assert quality.score_quality(empty).count() == 0


def test_outliers_of_each_group_go_and_the_bulk_stays(spark):
    """Two groups with different normal texts, one large; null group columns; junk planted in each."""
    rng = random.Random(1)
    words = {"en": ["the", "of", "and", "house", "tree", "water", "letter", "morning", "stone", "river"], "de": ["Geschwindigkeit", "und", "Verantwortung", "der", "Wirtschaft", "Haus"]}
    rows, junk = [], set()
    for k in range(900):
        lang = "de" if k % 6 == 0 else None if k % 6 == 1 else "en"
        w = [rng.choice(words[lang or "en"]) + str(rng.randrange(400)) for _ in range(int(rng.lognormvariate(5, 0.6)) + 55)]
        if k % 45 == 7:
            w = [x for y in w for x in (y, rng.choice(["|||", "***", "$$$%%%"]))]
            junk.add(k)
        rows.append((k, " ".join(w), lang, "s" if k % 4 else None))
    got = quality.score_quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    out = {r.doc_id for r in got if not r.kept}
    assert out == junk


def test_each_share_alone_passes_the_cutoff(spark):
    """Symbols, repeated lines and repeated words, each without the other two, are rejected; some lines repeated with their words are not."""
    rng = random.Random(2)
    fresh = lambda n: [f"{rng.choice(['house', 'tree', 'water', 'letter'])}{rng.randrange(10 ** 6)}" for _ in range(n)]
    lines = lambda w, n=10: "\n".join(" ".join(w[k:k + n]) for k in range(0, len(w), n))
    rows = [(k, lines(fresh(int(rng.lognormvariate(5, 0.6)) + 60))) for k in range(300)]
    names, short, seen = fresh(40), fresh(2), set()
    while len(short) < 200:  # single-word lines of 40 words; no three of them follow one another twice
        w = rng.choice(names)
        if (*short[-2:], w) not in seen:
            seen.add((*short[-2:], w))
            short.append(w)
    block = fresh(80)
    junk = {1000: " ".join(x for w in fresh(150) for x in (w, "|")), 1001: "\n".join(short), 1002: " ".join(fresh(200) + block + block)}
    some = fresh(300)
    rows += [*junk.items(), (1003, lines(some + some[:50]))]
    df = spark.createDataFrame([(d, t, "en", "s") for d, t in rows], "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.score_quality(df).collect()}
    shares = {d: [getattr(got[d], c) > 0 for c in ("n_symbols", "n_dup_lines", "n_repeat_words")] for d in (*junk, 1003)}
    assert shares == {1000: [True, False, False], 1001: [False, True, False], 1002: [False, False, True], 1003: [False, True, True]}
    assert not any(r.base_failed for r in got.values())
    assert {d for d, r in got.items() if not r.kept} == set(junk)


def test_precision_is_the_inverse(spark):
    """Gauss-Jordan in columns against numpy."""
    import numpy as np
    rng = np.random.default_rng(0)
    a = rng.normal(size=(5, 9))
    c = a @ a.T
    cols = {f"c_{x}_{y}": float(c[i, quality.X.index(y)]) for i, x in enumerate(quality.X) for y in quality.X[i:]}
    row = quality._invert(spark.createDataFrame([("g", *cols.values())], ["g", *cols])).first()
    want = np.linalg.inv(c)
    for i, x in enumerate(quality.X):
        for j in range(i, 5):
            assert abs(row[f"p_{x}_{quality.X[j]}"] - want[i, j]) < 1e-6 * abs(want).max()


def mcd(x, start, core, steps, floor):
    """The concentration steps of one group in numpy, with the histogram's quantile."""
    import numpy as np

    def quantile(d, share):
        step = np.floor(np.log2(d + 1e-9) * quality.BINS_PER_POWER)
        values, n = np.unique(step, return_counts=True)
        return 2.0 ** ((values[np.argmax(np.cumsum(n) >= share * len(d))] + 1) / quality.BINS_PER_POWER)

    m, p = start
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - m, p, x - m)
        near = x[d <= quantile(d, core)]
        m, c = near.mean(axis=0), np.cov(near.T, bias=True) + floor
        p = np.linalg.inv(c)
    return m, c, quantile


def test_estimates_against_numpy(spark):
    """Three sources of very different size in two languages: every centre, precision and scale, drawn to the larger group."""
    import numpy as np
    rng = np.random.default_rng(5)
    groups = {("en", "a"): 400, ("en", "b"): 30, ("de", "a"): 3}
    rows = [(lang, src, *(rng.normal(size=5) * [0.6, 0.2, 0.4, 0.3, 0.5] + k).tolist()) for k, ((lang, src), n) in enumerate(groups.items()) for _ in range(n)]
    got = {r.g: r for r in quality.estimates(spark.createDataFrame(rows, ["lang", "source", *quality.X])).collect()}
    floor = np.array([[quality._floor(a, b) if a <= b else quality._floor(b, a) for b in quality.X] for a in quality.X])
    key = lambda *p: "|".join([str(len(p)), *[x.encode().hex().upper() for x in p], *["-"] * (2 - len(p))])
    want = {}
    for part in [(), ("en",), ("de",), *groups]:
        x = np.array([r[2:] for r in rows if r[:len(part)] == part])
        mid = np.array([np.sort(c)[(len(c) - 1) // 2] for c in x.T])
        mad = np.array([np.sort(np.abs(c - k))[(len(c) - 1) // 2] for c, k in zip(x.T, mid)])
        sd = np.maximum(1.4826 * mad, list(quality.FLOORS.values()))
        m, c, quantile = mcd(x, (mid, np.diag(1 / sd ** 2)), quality.CORE, quality.STEPS, floor)
        w, up = len(x) / (len(x) + quality.PRIOR_DOCS), want.get(part[:-1]) if part else None
        if up is None:
            c = w * c + (1 - w) * np.diag(np.square(list(quality.WIDE.values())))
        else:
            c = w * c + (1 - w) * up[1] + w * (1 - w) * np.outer(m - up[0], m - up[0])
            m = w * m + (1 - w) * up[0]
        d = np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)
        scale = min(1.0, quality.CHI2_MEDIAN / quantile(d, 0.5))
        want[part] = (m, c, scale if up is None else w * scale + (1 - w) * up[2])
        r = got[key(*part)]
        assert np.allclose([r[f"m_{a}"] for a in quality.X], m, atol=1e-6), part
        p = np.linalg.inv(c)
        assert np.allclose([r[f"p_{a}_{b}"] for i, a in enumerate(quality.X) for b in quality.X[i:]], p[np.triu_indices(5)], rtol=1e-5, atol=1e-6), part
        assert abs(r.scale - want[part][2]) < 1e-6, part


def test_no_number_of_documents_switches_the_verdict(spark):
    """A document of symbols among n clean ones: its distance moves little from 99 to 101 rows."""
    rng = random.Random(8)
    clean = [" ".join(f"house{rng.randrange(10 ** 6)}" for _ in range(rng.randint(60, 300))) for _ in range(101)]
    odd = " ".join(x for k in range(150) for x in (f"tree{k}", "|"))
    got = []
    for n in (99, 101):
        df = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(clean[:n])] + [(-1, odd, "en", "s")], "doc_id long, text string, lang string, source string")
        got.append(quality.score_quality(df).filter("doc_id = -1").first().distance)
    assert max(got) < 1.1 * min(got)
