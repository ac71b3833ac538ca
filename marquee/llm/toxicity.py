"""Toxicity: a learned lexicon in a trie, matched through Levenshtein automata, with context-window scores.

Terms and stems that mark toxic documents are learned from labelled rows.  Each
distinct word runs through the product of the trie and the Levenshtein
automaton of the word, as a machine whose states are built as they are met;
most words leave it after a few letters.  A match that stands between quotation
marks or near a reporting verb counts apart from plain ones, and a logistic
model of the counts gives the score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import fold, saved

FOLDS, HELD_OUT, THRESHOLD = 4, 2, 0.3
# Labelled rows that the lexicon and the weights are learned from, per class; everything else covers all rows.
TRAIN_TOXIC, TRAIN_CLEAN = 4000, 8000
MIN_DOCS, MIN_LOG_ODDS = 3, 3.0
FUZZY_FROM = 5  # shorter terms match exactly only
STEMS = (4, 5, 6)
WINDOW = 8  # words before a match that are searched for quotation
# Characters cut from both ends of a word.
EDGE = ".,;:!?()[]{}<>|*$%&#/\\\"'`~_-…“”„«»‘’¡¿"
OPENING, CLOSING = "\"“„«", "\"”“»"
# Reporting words that mark what stands near as quoted.
REPORTING = frozenset("said says called wrote quoted quote cited dit disait appelé écrit cité dijo llamó escribió citó sagte nannte schrieb zitierte".split())


class Lexicon:
    """Terms (whole words) and stems (word beginnings) in a trie, and the machine over it.

    A state is the set of (trie node, edits so far) that the letters read so
    far can reach with at most one edit; reading a letter moves every member by
    a match, a substitution, an insertion, a deletion or, with ``swaps``, half
    of a transposition (the letter still due stands in place of the edits).
    States are numbered and their moves remembered.  ``near``: terms that only
    match with an edit, because a stem covers them as they are written.
    """

    STATES = 200_000  # then the table starts anew; results do not change

    def __init__(self, terms: list[str], stems: list[str], fuzzy: set[str] | None = None,
                 near: list[str] | None = None, swaps: bool = False) -> None:
        self.kids: list[dict[str, int]] = [{}]
        self.entry: list[tuple[str, bool] | None] = [None]
        self.loose: list[str | None] = [None]  # the term that ends here, if it allows an edit
        self.fuzzy_below: list[bool] = [False]  # whether a term that allows an edit lies below
        for text, kind in [(t, "term") for t in terms] + [(s, "stem") for s in stems] + [(t, "near") for t in near or []]:
            node, stem = 0, kind == "stem"
            loose = not stem and len(text) >= FUZZY_FROM and (fuzzy is None or text in fuzzy)
            for ch in text:
                self.fuzzy_below[node] |= loose
                if ch not in self.kids[node]:
                    self.kids[node][ch] = len(self.kids)
                    self.kids.append({})
                    self.entry.append(None)
                    self.loose.append(None)
                    self.fuzzy_below.append(False)
                node = self.kids[node][ch]
            self.fuzzy_below[node] |= loose
            if loose:
                self.loose[node] = text
            if kind != "near" and (self.entry[node] is None or not stem):
                self.entry[node] = (text, stem)
        self.swaps = swaps
        self._reset()

    def _reset(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.start = self._state(self._close({(0, 0)}))

    def _state(self, members: frozenset) -> int:
        if not members:
            return -1
        if members not in self.number:
            self.number[members] = len(self.states)
            self.states.append(members)
            self.moves.append({})
        return self.number[members]

    def _close(self, members: set[tuple[int, int | str]]) -> frozenset:
        """With the nodes reached by leaving out a letter of a term."""
        out = set(members)
        for node, edits in members:
            if not edits and self.fuzzy_below[node]:
                out |= {(k, 1) for k in self.kids[node].values() if self.fuzzy_below[k]}
        return frozenset(out)

    def _move(self, state: int, ch: str) -> int:
        out: set[tuple[int, int | str]] = set()
        for node, edits in self.states[state]:
            if isinstance(edits, str):
                if ch == edits:
                    out.add((node, 1))
                continue
            entry = self.entry[node]
            if entry and entry[1] and not edits:
                out.add((node, 0))  # a stem takes any ending
            kids = self.kids[node]
            if ch in kids:
                out.add((kids[ch], edits))
            if not edits and self.fuzzy_below[node]:
                out.add((node, 1))
                out |= {(k, 1) for k in kids.values() if self.fuzzy_below[k]}
                if self.swaps:
                    out |= {(self.kids[k][ch], due) for due, k in kids.items() if due != ch and ch in self.kids[k] and self.fuzzy_below[self.kids[k][ch]]}
        return self._state(self._close(out))

    def match(self, word: str) -> tuple[str, str] | None:
        """(kind, entry) of the best match: exact term, then stem, then a term with one edit."""
        if len(self.states) > self.STATES:
            self._reset()
        state = self.start
        for ch in word:
            got = self.moves[state].get(ch)
            if got is None:
                got = self.moves[state][ch] = self._move(state, ch)
            state = got
            if state < 0:
                return None
        found = []
        for node, edits in self.states[state]:
            entry, loose = self.entry[node], self.loose[node]
            if entry and not edits:
                text, stem = entry
                found.append((1 if stem else 0, text))
            elif loose and edits == 1:
                found.append((2, loose))
        if not found:
            return None
        kind, text = min(found)
        return ("exact", "stem", "fuzzy")[kind], text


def words_of(text: str) -> list[str]:
    return text.lower().split()


class Matcher:
    """Hits of a lexicon in texts, with a bounded cache of words."""

    CACHE = 200_000

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self.known: dict[str, tuple[str, str] | None] = {}

    def hits(self, text: str) -> tuple[list[tuple[int, str, str]], list[str]]:
        """(position, kind, entry) of every hit, and the words."""
        words = words_of(text)
        known = self.known
        if len(known) > self.CACHE:
            known.clear()
        found = set()
        for w in set(words):
            if w in known:
                got = known[w]
            else:
                got = known[w] = self.lexicon.match(w.strip(EDGE))
            if got:
                found.add(w)
        return ([(k, *known[w]) for k, w in enumerate(words) if w in found] if found else []), words

    def vector(self, text: str) -> np.ndarray:
        """Log counts of plain exact, stem and fuzzy hits, of quoted hits, their share of the words, and 1."""
        hits, words = self.hits(text)
        n = Counter("quoted" if quoted(words, k) else kind for k, kind, _ in hits)
        plain = n["exact"] + n["stem"] + n["fuzzy"]
        return np.array([math.log1p(n["exact"]), math.log1p(n["stem"]), math.log1p(n["fuzzy"]), math.log1p(n["quoted"]),
                         math.sqrt(plain / max(1, len(words))), 1.0])


def quoted(words: list[str], at: int) -> bool:
    """Whether the word stands inside quotation marks opened just before, or near a reporting word."""
    inside = False
    for w in words[max(0, at - WINDOW):at + 1]:
        if w[:1] in OPENING and w[:1]:
            inside = True
        if len(w) > 1 and w.rstrip(".,;:!?")[-1:] in CLOSING and w is not words[at]:
            inside = False
    return inside or any(w.strip(EDGE) in REPORTING for w in words[max(0, at - WINDOW // 2):at + WINDOW // 2 + 1])


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weighted logistic regression by Newton steps, pulled towards ``prior``."""
    w = prior.copy()
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - y)) + ridge * (w - prior)
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray) -> None:
        self.matcher, self.weights = Matcher(lexicon), weights

    def score(self, text: str) -> float:
        return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(self.matcher.vector(text) @ self.weights))))))


# Weights before any label is seen: plain hits speak for abuse, quoted ones for half as much, none for a clean text.
PRIOR = np.array([3.0, 3.0, 0.5, 1.5, 1.0, -3.0])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          train_toxic: int = TRAIN_TOXIC, train_clean: int = TRAIN_CLEAN) -> Model:
    """Learn from at most ``train_toxic`` + ``train_clean`` labelled rows outside the held-out fold, chosen by a hash of the id.

    Null ids, labels and texts teach nothing; an id with several labels counts
    with the largest.  Without labels the lexicon is empty and every score low.
    """
    spark = docs.sparkSession
    marks = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label_col).cast("int").alias("y")) \
        .filter(F.col("id").isNotNull() & F.col("y").isNotNull() & (fold(F.col("id"), FOLDS) != HELD_OUT)).groupBy("id").agg(F.max("y").alias("y"))
    counts = {r.y: r["count"] for r in marks.withColumn("y", F.when(F.col("y") > 0, 1).otherwise(0)).groupBy("y").count().collect()}
    most = {1: train_toxic, 0: train_clean}
    draw = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 30))
    y = F.when(F.col("y") > 0, 1).otherwise(0)
    limit = {k: int(min(1.0, 1.2 * most[k] / max(1, counts.get(k, 0))) * (1 << 30)) for k in most}
    drawn = marks.select("id", y.alias("y"), draw.alias("draw")).filter(F.col("draw") <= F.when(F.col("y") == 1, limit[1]).otherwise(limit[0]))
    drawn = drawn.withColumn("n", F.row_number().over(Window.partitionBy("y").orderBy("draw", "id"))) \
        .filter(F.col("n") <= F.when(F.col("y") == 1, most[1]).otherwise(most[0])).select("id", "y")
    # The drawn ids are bounded by the parameters, so they may be broadcast to the one scan of the texts.
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter(F.length("text") > 0)
    sample = saved(rows.join(F.broadcast(drawn), "id").groupBy("text").agg(F.max("y").alias("y")).select("y", "text"), "labelled")  # a copied text teaches once
    n = {r.y: r["count"] for r in sample.groupBy("y").count().collect()}
    if not n.get(1):
        return Model(Lexicon([], []), PRIOR)
    sample = sample.repartition(max(4, spark.sparkContext.defaultParallelism))

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, docs_with = Counter(), Counter()
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = {w.strip(EDGE) for w in set(words_of(text))}
                own |= {w[:k] + "*" for w in own for k in STEMS if len(w) > k}
                own.discard("")
                docs_with.update(own)
                if label:
                    toxic.update(own)
            yield pa.RecordBatch.from_pydict({"term": list(docs_with), "a": [toxic[t] for t in docs_with], "b": list(docs_with.values())},
                                             schema=pa.schema([("term", pa.string()), ("a", pa.int64()), ("b", pa.int64())]))

    def odds(a: Column, b: Column) -> Column:
        return F.log((a + 0.5) / (n[1] + 1)) - F.log((b - a + 0.5) / (n.get(0, 0) + 1))

    stats = sample.mapInArrow(terms, "term string, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b")) \
        .filter(F.col("a") >= MIN_DOCS).withColumn("odds", odds(F.col("a"), F.col("b"))).filter(F.col("odds") >= MIN_LOG_ODDS)
    top = stats.collect()  # terms of the drawn rows, of which each holds MIN_DOCS or more: bounded by the parameters
    single = {r.term: r.a for r in top if not r.term.endswith("*")}
    stems: list[str] = []
    for r in sorted((r for r in top if r.term.endswith("*")), key=lambda r: (len(r.term), -r.odds, r.term)):
        stem = r.term[:-1]
        most_common = max((a for w, a in single.items() if w.startswith(stem)), default=0)
        # A stem stands for several words, none of which alone explains its documents.
        if not any(stem.startswith(s) for s in stems) and r.a >= 1.3 * most_common:
            stems.append(stem)
    words = [w for w in single if not any(w.startswith(s) for s in stems)]
    stemmed = sorted(single.keys() - words)  # a typo inside the stem is one edit of the whole term

    # One edit is allowed for a term only if its misspellings do not turn up in clean documents.
    matcher = Matcher(Lexicon(words, stems, near=stemmed, swaps=True))

    def misspelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out += [(t, label) for t in {t for _, kind, t in matcher.hits(text)[0] if kind == "fuzzy"}]
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in out], pa.string()), pa.array([v for _, v in out], pa.int64())], names=["term", "y"])

    seen = sample.mapInArrow(misspelt, "term string, y long").groupBy("term").agg(F.sum("y").alias("a"), F.count("*").alias("b")).collect()
    bad = {r.term for r in seen if math.log((r.a + 0.5) / (n[1] + 1)) - math.log((r.b - r.a + 0.5) / (n.get(0, 0) + 1)) < 1.0}
    lexicon = Lexicon(words, stems, single.keys() - bad, stemmed, swaps=True)
    matcher = Matcher(lexicon)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([matcher.vector(t).tolist() for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))],
                                             names=["y", "x"])

    got = sample.mapInArrow(vectors, "y int, x array<double>").collect()  # at most train_toxic + train_clean short rows
    got.sort(key=lambda r: (r.y, r.x))
    x, yy = np.array([r.x for r in got]), np.array([r.y for r in got], float)
    weight = np.where(yy > 0, counts[1] / n[1], counts.get(0, 0) / max(1, n.get(0, 0)))
    return Model(lexicon, fit_logistic(x, yy, weight / weight.mean(), PRIOR))


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from the whole text alone; null texts are scored as empty."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                got = [model.score(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(got, pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, in one pass without a shuffle."""
    at = docs.columns.index(text_col)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                yield part.filter(pa.array([model.score(t or "") < threshold for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
