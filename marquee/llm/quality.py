"""Quality rules: simple counts per document, and robust multivariate outliers per language and source.

DataFrame expressions only.  The counts give a vector of transformed
statistics; per (language, source) a minimum-covariance-determinant estimate of
centre and covariance is found by concentration steps from a median/MAD start
and drawn towards that of the language and of all documents, and documents whose Mahalanobis distance is beyond the cut-off are rejected.
Each step is one aggregation of moments and one of a distance histogram, both
combined before their shuffle, so a source that holds a third of the rows
costs no more than the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.arrays import let, positions, words
from marquee.llm.common import saved

# A group's estimate is drawn towards that of its language, a language's towards that of all documents and the last
# towards a wide one, as if so many documents of the larger group were in it: no number of documents switches anything.
PRIOR_DOCS = 30
WIDE = {"x1": 1.0, "x2": 0.5, "x3": 1.0, "x4": 1.0, "x5": 1.0}
# Share of each group that the estimate rests on.
CORE = 0.75
STEPS = 3
SALTS = 16
# Chi-square quantiles for 5 degrees of freedom: the median, and the default cut-off (a tail of about 1e-9).
CHI2_MEDIAN, CUTOFF = 4.351, 52.0
# The squares of these are added to every variance: a statistic that is constant in the core of a group
# must not reject every document that differs a little.  Each share alone can pass the cut-off: from 36 symbols in
# a hundred words, 57 % of the lines, or 32 % of the words (the base rules let 50 % through) where the core has none.
FLOORS = {"x1": 0.5, "x2": 0.1, "x3": 0.5, "x4": 0.63, "x5": 0.54}
# Repeated lines bring repeated words with them: the two floors are correlated, so that the pair does not count twice.
FLOOR_CORRELATIONS = {("x4", "x5"): 0.45}
X = list(FLOORS)
# Distances are compared in steps of 1/16 of a power of two.
BINS_PER_POWER = 16


def repeated_words(w: Column) -> Column:
    """Words of the array ``w`` that lie in a three-word window found twice or more, first ones included."""
    def count(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(s: Column) -> Column:
            same = lambda a, b: F.coalesce(F.get(s, a)["h"] == F.get(s, b)["h"], F.lit(False))
            again = F.filter(positions(F.size(s)), lambda k: same(k - 1, k) | ((k > 1) & same(k - 1, F.greatest(k - 2, F.lit(0)))))
            return F.size(F.array_distinct(F.flatten(F.transform(
                again, lambda k: let(F.get(s, k - 1)["i"], lambda i: F.array(i, i + 1, i + 2))))))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(let(ordered, covered))

    hashed = F.transform(positions(F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i - 1), F.get(w, i), F.get(w, i + 1)))
    return let(hashed, count).cast("long")


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source", min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """doc_id, lang, source, the counts and ``base_failed``.

    A null text has no words and fails; null languages and sources are groups of their own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                       text.alias("t"), words(text).alias("w"), lines.alias("l"))
    return rows.select(
        "doc_id", "lang", "source",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        F.size("l").alias("n_lines"),
    ).withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))


def vector(counts: DataFrame) -> DataFrame:
    """Adds the transformed statistics: length, word length, symbols, repeated lines, repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    share = lambda part, whole: F.log1p(100.0 * part / whole)
    return counts.withColumns({
        "x1": F.log(n.cast("double")), "x2": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        "x3": share(F.col("n_symbols"), n), "x4": share(F.col("n_dup_lines"), F.greatest(F.col("n_lines"), F.lit(1))),
        "x5": share(F.col("n_repeat_words"), n)})


def _groups(rows: DataFrame) -> DataFrame:
    """Each row once per level: all documents, its language, its language and source."""
    level = lambda n, lang, source: F.struct(F.lit(n).alias("level"), lang.alias("lang"), source.alias("source"))
    none = F.lit(None).cast("string")
    keys = F.array(level(0, none, none), level(1, F.col("lang").cast("string"), none), level(2, F.col("lang").cast("string"), F.col("source").cast("string")))
    return rows.select(F.explode(keys).alias("g"), *X).select(
        F.concat_ws("|", F.col("g.level").cast("string"), *(F.coalesce(F.hex(F.col(f"g.{c}")), F.lit("-")) for c in ("lang", "source"))).alias("g"), *X)


def _key(level: int) -> Column:
    part = lambda c: F.coalesce(F.hex(F.col(c).cast("string")), F.lit("-"))
    return F.concat_ws("|", F.lit(str(level)), *[part(c) if k < level else F.lit("-") for k, c in enumerate(("lang", "source"))])


def _distance() -> Column:
    """Squared Mahalanobis distance of x1.. from the centre m_* with the precision matrix p_*."""
    terms = [(F.col(a) - F.col(f"m_{a}")) * (F.col(b) - F.col(f"m_{b}")) * F.col(f"p_{a}_{b}") * (1 if a == b else 2)
             for i, a in enumerate(X) for b in X[i:]]
    return sum(terms[1:], terms[0])


def _invert(est: DataFrame) -> DataFrame:
    """Adds p_*: the inverse of the covariance c_* by Gauss-Jordan steps, in the columns of the group table."""
    n = len(X)
    name = lambda i, j: f"a_{i}_{j}"
    cov = lambda i, j: F.col(f"c_{X[min(i, j)]}_{X[max(i, j)]}")
    keep = [c for c in est.columns if not c.startswith("c_")]
    t = est.select(*keep, *[cov(i, j).alias(name(i, j)) for i in range(n) for j in range(n)])
    for k in range(n):  # in place: the matrix turns into its inverse
        pivot = F.col(name(k, k))

        def entry(i: int, j: int) -> Column:
            a, row, col = F.col(name(i, j)), F.col(name(k, j)), F.col(name(i, k))
            if i == k and j == k:
                return 1.0 / pivot
            if i == k:
                return row / pivot
            return -col / pivot if j == k else a - col * row / pivot

        t = t.select(*keep, *[entry(i, j).alias(name(i, j)) for i in range(n) for j in range(n)])
    return t.select(*keep, *[F.col(name(i, j)).alias(f"p_{X[i]}_{X[j]}") for i in range(n) for j in range(i, n)])


def _quantile(dist: DataFrame, share: float) -> DataFrame:
    """Per group the distance below which at least ``share`` of the rows lie, from a histogram of fixed steps."""
    step = F.floor(F.log2(F.col("d") + 1e-9) * BINS_PER_POWER)
    bins = dist.groupBy("g", step.alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("g")
    return bins.withColumn("upto", F.sum("n").over(w.orderBy("bin"))).withColumn("all", F.sum("n").over(w)) \
        .filter(F.col("upto") >= share * F.col("all")).groupBy("g").agg(F.pow(F.lit(2.0), (F.min("bin") + 1) / BINS_PER_POWER).alias("q"))


def _beside(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with the columns of their group; a group's rows meet its estimate in ``SALTS`` places, so none is hot."""
    return rows.join(groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["g", "salt"])


def _floor(a: str, b: str) -> float:
    return FLOORS[a] * FLOORS[b] * (1.0 if a == b else FLOOR_CORRELATIONS.get((a, b), 0.0))


def _drawn(t: DataFrame, top, below) -> DataFrame:
    """Group table, from all documents down: ``top`` makes the columns of the first level, ``below`` those of a group from
    its own, the weight ``w`` of its documents and its parent's (prefixed ``up_``)."""
    part = F.split("g", r"\|")
    t = t.withColumn("w", F.col("n") / (F.col("n") + PRIOR_DOCS)).withColumn("level", F.get(part, 0)) \
        .withColumn("up", F.when(F.col("level") == "2", F.concat(F.lit("1|"), F.get(part, 1), F.lit("|-"))).otherwise(F.lit("0|-|-")))
    done = level = t.filter("level = '0'").select("g", "n", *top)
    for k in ("1", "2"):
        parent = level.select(*[F.col(c).alias(f"up_{c}") for c in level.columns])
        level = t.filter(F.col("level") == k).join(parent, F.col("up") == F.col("up_g")).select("g", "n", *below)
        done = done.unionByName(level)
    return done


def _shrunk(cov: DataFrame) -> DataFrame:
    """Centres and covariances drawn towards those of the larger group, with what the distance of the two centres adds."""
    w, pairs = F.col("w"), [(a, b) for i, a in enumerate(X) for b in X[i:]]
    top = [*[f"m_{x}" for x in X], *[(w * F.col(f"c_{a}_{b}") + ((1 - w) * WIDE[a] ** 2 if a == b else F.lit(0.0))).alias(f"c_{a}_{b}") for a, b in pairs]]
    mix = lambda c: w * F.col(c) + (1 - w) * F.col(f"up_{c}")
    off = lambda x: F.col(f"m_{x}") - F.col(f"up_m_{x}")
    return _drawn(cov, top, [*[mix(f"m_{x}").alias(f"m_{x}") for x in X],
                             *[(mix(f"c_{a}_{b}") + w * (1 - w) * off(a) * off(b)).alias(f"c_{a}_{b}") for a, b in pairs]])


def estimates(vectors: DataFrame, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """Group table: key ``g``, rows ``n``, centre and precision of each (language, source), language, and all."""
    rows = saved(_groups(vectors).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")), "vectors")
    zero = F.lit(0.0)
    mid = rows.groupBy("g").agg(F.count("*").alias("n"), *[F.percentile_approx(x, 0.5, 1000).alias(f"m_{x}") for x in X])
    mad = _beside(rows, mid).groupBy("g").agg(F.first("n").alias("n"), *[F.first(f"m_{x}").alias(f"m_{x}") for x in X], *[
        F.greatest(1.4826 * F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{x}")), 0.5, 1000), F.lit(FLOORS[x])).alias(f"s_{x}") for x in X])
    est = saved(mad.select("g", "n", *[f"m_{x}" for x in X], *[
        (1.0 / (F.col(f"s_{a}") * F.col(f"s_{b}")) if a == b else zero).alias(f"p_{a}_{b}") for i, a in enumerate(X) for b in X[i:]]), "estimate")
    for _ in range(steps):
        dist = _beside(rows, est).select("g", _distance().alias("d"))
        near = _beside(rows, est.join(_quantile(dist, core), "g")).withColumn("d", _distance()).filter("d <= q")
        z = lambda a: F.col(a) - F.col(f"m_{a}")  # moments about the last centre: no cancellation
        sums = near.groupBy("g").agg(F.first("n").alias("n"), F.count("*").alias("k"), *[F.first(f"m_{x}").alias(f"o_{x}") for x in X],
                                     *[F.avg(z(x)).alias(f"e_{x}") for x in X],
                                     *[F.avg(z(a) * z(b)).alias(f"e_{a}_{b}") for i, a in enumerate(X) for b in X[i:]])
        cov = sums.select("g", "n", *[(F.col(f"o_{x}") + F.col(f"e_{x}")).alias(f"m_{x}") for x in X], *[
            (F.col(f"e_{a}_{b}") - F.col(f"e_{a}") * F.col(f"e_{b}") + _floor(a, b)).alias(f"c_{a}_{b}")
            for i, a in enumerate(X) for b in X[i:]])
        est = saved(_invert(cov), "estimate")
    est = saved(_invert(_shrunk(saved(cov, "covariance"))), "estimate")
    # The core is narrower than the whole: scale so that the median distance is that of a normal sample, never inflating distances.
    dist = _beside(rows, est).select("g", _distance().alias("d"))
    scale = est.select("g", "n").join(_quantile(dist, 0.5), "g").withColumn("scale", F.least(F.lit(1.0), CHI2_MEDIAN / F.col("q")))
    w = F.col("w")
    scale = _drawn(scale, ["scale"], [(w * F.col("scale") + (1 - w) * F.col("up_scale")).alias("scale")])
    return saved(est.join(scale.select("g", "scale"), "g"), "estimate")


def score_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                  cutoff: float = CUTOFF) -> DataFrame:
    """Counts, ``distance`` and ``kept`` for every row.

    The estimates rest on the documents that pass the base rules; ``distance``
    is null for rows that fail them.  Rows are judged one by one, so repeated
    rows and null ids get the same verdicts; they count in the estimates as
    often as they are there.
    """
    counts = saved(vector(base_counts(docs, id_col, text_col, lang_col, source_col)), "counts")
    est = estimates(counts.filter(~F.col("base_failed"))).filter(F.col("g").startswith("2|")).withColumnRenamed("g", "group")
    rows = counts.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    own = est.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = rows.join(own, (_key(2) == F.col("group")) & (F.col("salt") == F.col("_salt")), "left")
    distance = F.when(~F.col("base_failed"), _distance() * F.col("scale"))
    return rows.withColumn("distance", distance).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)).alias("kept"), "distance", *X)
