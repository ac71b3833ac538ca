"""Toxicity and language: machine against plain edit distance, held-out accuracy, edge cases."""
import random

from marquee.llm import langid, toxicity
from tests.llm.conftest import MESSY


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_machine_equals_edit_distance():
    rng = random.Random(1)
    terms = ["idiot", "moron", "scum", "trashy", "abcde", "abcdf"]
    lex = toxicity.Lexicon(terms, ["lowe", "vequ"], {"idiot", "abcde", "trashy"})
    words = terms + ["idiots", "idot", "1diot", "diiot", "loweich", "lowe", "low", "scun", "moro", ""]
    words += ["".join(rng.choice("abcdeflowidtm") for _ in range(rng.randint(1, 7))) for _ in range(3000)]
    for w in words:
        exact = [t for t in terms if t == w]
        stem = [s for s in ("lowe", "vequ") if w.startswith(s)]
        fuzzy = sorted(t for t in ("idiot", "abcde", "trashy") if edits(t, w) == 1)
        want = ("exact", exact[0]) if exact else ("stem", stem[0]) if stem else ("fuzzy", fuzzy[0]) if fuzzy else None
        assert lex.match(w) == want, w


def test_machine_with_swaps_and_stemmed_terms():
    """A swap of neighbours is one edit; a term that a stem covers is found with a typo inside the stem."""
    def one_edit(t, w):
        return edits(t, w) == 1 or t != w and any(t[:k] + t[k + 1] + t[k] + t[k + 2:] == w for k in range(len(t) - 1))

    rng = random.Random(3)
    near = ["lowered", "lowen", "lowe", "vequo"]
    lex = toxicity.Lexicon(["idiot", "abcde"], ["lowe", "vequ"], {"idiot", "lowered", "lowen", "vequo"}, near, swaps=True)
    words = ["diiot", "idito", "iidot", "olwered", "lwered", "loweerd", "lowered", "lowe", "lowen", "lwoen", "evquo", "abced", "idtoi", "oidit"]
    words += ["".join(rng.choice("lowenvquidt") for _ in range(rng.randint(3, 8))) for _ in range(2000)]
    for t in ("idiot", "lowered", "lowen", "vequo"):
        for _ in range(300):
            k, c = rng.randrange(len(t)), rng.choice("lowenvquidt")
            words.append(rng.choice([t[:k] + c + t[k:], t[:k] + t[k + 1:], t[:k] + c + t[k + 1:], t[:k] + t[k + 1:k + 2] + t[k] + t[k + 2:]]))
    for w in words:
        stem = [s for s in ("lowe", "vequ") if w.startswith(s)]
        fuzzy = sorted(t for t in ("idiot", "lowered", "lowen", "vequo") if one_edit(t, w))
        want = ("exact", w) if w in ("idiot", "abcde") else ("stem", stem[0]) if stem else ("fuzzy", fuzzy[0]) if fuzzy else None
        assert lex.match(w) == want, w


def test_quotation_lowers_the_score():
    m = toxicity.Model(toxicity.Lexicon(["idiot"], []), toxicity.PRIOR)
    plain, told = m.score("you are an idiot and nothing else"), m.score('she said he had been called "an idiot" once')
    assert plain > told > m.score("a clean text") >= 0 and 0 <= m.score("") < 0.3


def test_toxicity_held_out(spark, sample, messy, empty):
    dir_ = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{dir_}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    got = toxicity.score_toxicity(docs, model).join(labels, "doc_id").filter("held_out").collect()
    right = sum(r.predicted == r.toxic for r in got)
    assert right >= 0.97 * len(got)
    assert sum(r.predicted for r in got if r.toxic) >= 0.85 * sum(r.toxic for r in got)
    out = toxicity.score_toxicity(messy, model).collect()
    assert len(out) == len(MESSY) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score_toxicity(empty, model).count() == 0 and toxicity.keep_clean(messy, model).columns == messy.columns
    none = toxicity.train(empty, labels.limit(0))
    assert toxicity.score_toxicity(messy, none).count() == len(MESSY)


def test_language_held_out(spark, messy, empty):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = langid.train(docs)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got)
    out = {r.doc_id: r for r in langid.identify(messy, model).collect()}
    assert out[1].lang_pred == out[2].lang_pred == out[13].lang_pred == "und" and out[0].lang_pred != "und"
    assert langid.identify(empty, model).count() == 0 and langid.train(empty) is None
    assert {r.lang_pred for r in langid.identify(messy, None).collect()} == {"und"}


def test_one_versus_one_inside_a_family(spark):
    """Three languages of one family and one that is listed nowhere."""
    rng = random.Random(2)
    sound = {"en": "thingher", "de": "schungei", "nl": "aaijghoe", "xx": "kwzqvxyu"}
    rows = [(k, " ".join("".join(rng.choice(sound[v]) for _ in range(5)) for _ in range(30)), v) for k in range(400) for v in [rng.choice(list(sound))]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.identify(df, langid.train(df, train_rows=120)).collect()
    want = {d: v for d, _, v in rows}
    assert sum(r.lang_pred == want[r.doc_id] for r in got) >= 396


def test_misspelt_and_quoted_terms_through_training(spark):
    """Planted terms are learned; in the held-out fold their misspellings score above clean texts (labels without any misspelling
    teach no more than the prior weight), and quoted ones below plain ones."""
    import zlib
    rng = random.Random(12)
    vocabulary = [f"{a}{b}{c}" for a in ("ma", "lo", "ri", "te") for b in ("nu", "ke", "sa", "vo") for c in ("", "l", "n", "ra")]
    terms = ["grobnik", "snarfel", "blottik", "wermlig", "dorkfis"]

    def text(middle=""):
        w = rng.choices(vocabulary, k=40)
        return " ".join([*w[:20], middle, *w[20:]]) if middle else " ".join(w)

    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    learn, probe = [i for i in range(1500) if not held(i)], iter([i for i in range(1500) if held(i)])
    rows = [(i, text(terms[k % 5]), 1) for k, i in enumerate(learn[:150])] + [(i, text(), 0) for i in learn[150:500]]
    rows += [(i, text(f'he said "{t}" once'), 0) for i, t in zip(learn[500:505], terms)]
    wrong = [t[:3] + t[4:] for t in terms] + [t[:2] + t[3] + t[2] + t[4:] for t in terms] + [t[:4] + "z" + t[5:] for t in terms]
    kinds = {"plain": [text(t) for t in terms], "misspelt": [text(w) for w in wrong], "quoted": [text(f'she wrote "{t}" there') for t in terms],
             "clean": [text() for _ in range(20)]}
    placed = {next(probe): (kind, t) for kind, ts in kinds.items() for t in ts}
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(i, t) for i, (_, t) in placed.items()], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, toxicity.train(docs, labels)).collect()}
    score = {kind: [got[i].score for i, (k, _) in placed.items() if k == kind] for kind in kinds}
    assert all(got[i].held_out for i in placed)
    assert min(score["plain"]) >= toxicity.THRESHOLD > max(score["clean"])
    assert min(score["misspelt"]) > max(score["clean"]) and max(score["quoted"]) < min(score["plain"])
