"""Language identification in two levels: family first, then one-versus-one linear SVMs inside the family."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.common import fold

# Rows the models are fitted on, over all languages together; everything else covers all rows.
TRAIN_ROWS = 3000
DIMS = 4096
FOLDS, HELD_OUT = 5, 0

# ISO 639-1 codes by language family. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn af is fy lb yi".split(),
    "romance": "fr es it pt ro ca gl oc la".split(),
    "slavic": "ru pl cs uk bg sr hr sk sl mk be bs".split(),
    "uralic": "fi et hu".split(), "turkic": "tr az kk uz ky tk".split(), "semitic": "ar he mt am".split(),
    "indic": "hi bn ur mr ne pa gu si".split(), "celtic": "ga cy gd br".split(), "baltic": "lt lv".split(),
}
FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes}


def family(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0], lang)


# Letters of other scripts come as UTF-8 bytes; ASCII letters are lower-cased; all else is a blank.
_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def features(text: str) -> np.ndarray:
    """Unit vector of the square roots of hashed byte-trigram counts over the whole text."""
    b = _FOLD[np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)]
    b = np.concatenate([[32], b[(b != 32) | (np.append(0, b[:-1]) != 32)], [32]]).astype(np.uint32)
    code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)
    count = np.sqrt(np.bincount(code >> np.uint32(32 - DIMS.bit_length() + 1), minlength=DIMS))
    return (count / max(np.linalg.norm(count), 1e-9)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = 30) -> np.ndarray:
    """Weights (last one: bias) of an L2-regularised squared-hinge SVM, by dual coordinate descent; y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    weight = np.where(y > 0, len(y) / max(1, 2 * (y > 0).sum()), len(y) / max(1, 2 * (y < 0).sum()))
    diag = (x * x).sum(axis=1) + 0.5 / (c * weight)
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / (c * weight[i])
            new = max(0.0, alpha[i] - g / diag[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w.astype(np.float32)


class Model:
    """One-versus-rest separators of the families, one-versus-one separators of the languages in each."""

    def __init__(self, x: np.ndarray, langs: list[str]) -> None:
        lang = np.array(langs)
        fam = np.array([family(v) for v in langs])
        self.families = sorted(set(fam))
        self.members = {f: sorted(set(lang[fam == f])) for f in self.families}
        self.family_w = np.stack([fit_svm(x, np.where(fam == f, 1, -1)) for f in self.families]) if len(self.families) > 1 else None
        self.pair_w = {}
        for f in self.families:
            for a, b in itertools.combinations(self.members[f], 2):
                own = (lang == a) | (lang == b)
                self.pair_w[a, b] = fit_svm(x[own], np.where(lang[own] == a, 1, -1))

    def predict(self, text: str) -> tuple[str, float]:
        x = np.append(features(text), np.float32(1))
        f, sure = self.families[0], 1.0
        if self.family_w is not None:
            m = self.family_w @ x
            order = np.argsort(-m, kind="stable")
            f, sure = self.families[order[0]], 1 / (1 + np.exp(-2 * (m[order[0]] - m[order[1]])))
        members = self.members[f]
        votes = {v: [0, 0.0] for v in members}
        for a, b in itertools.combinations(members, 2):
            m = float(self.pair_w[a, b] @ x)
            votes[a if m >= 0 else b][0] += 1
            votes[a][1] += m
            votes[b][1] -= m
        best = max(members, key=lambda v: votes[v])
        margins = [float(self.pair_w[a, b] @ x) * (1 if a == best else -1) for a, b in itertools.combinations(members, 2) if best in (a, b)]
        for m in margins:
            sure = min(sure, 1 / (1 + np.exp(-4 * m)))
        return best, float(sure)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = TRAIN_ROWS) -> Model | None:
    """Fit on at most ``train_rows`` rows outside the held-out fold, shared evenly between the languages, chosen
    by a hash of the id. Rows without text or language teach nothing. None if nothing can be learned."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .filter((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & (F.length("text") > 0))
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row per language
    if not counts:
        return None
    each = max(2, train_rows // len(counts))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30))
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, int(min(1.0, 1.2 * each / n) * (1 << 30)))])
    drawn = rows.withColumn("draw", draw).filter(F.col("draw") <= share[F.col("lang")])
    best = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
    drawn = drawn.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= each)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [features(t).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["lang", "x"])

    got = drawn.select("lang", "text").mapInArrow(vectors, "lang string, x binary").collect()  # at most train_rows vectors
    got.sort(key=lambda r: (r.lang, bytes(r.x)))
    return Model(np.stack([np.frombuffer(r.x, np.float32) for r in got]), [r.lang for r in got])


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score from the whole text alone; ``und`` for null texts and texts without a letter."""
    schema = "doc_id long, lang_pred string, score double"

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                texts = batch.column(1).slice(k, 1000).to_pylist()
                out = [model.predict(t) if model and t and any(map(str.isalpha, t)) else ("und", 0.0) for t in texts]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1000), pa.array([o[0] for o in out], pa.string()),
                                                  pa.array([o[1] for o in out], pa.float64())], names=["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(predict, schema)
    return found.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
