"""Dimension conforming (entity resolution) as joins.

Every lookup the row-at-a-time original does against in-memory indexes is a
join here: exact key, composite key, unique-only key, blocked fuzzy match,
priority pick among candidates, anti-join discovery of new members and
dense id allocation.  Dimensions are joined, never collected; AQE turns a
join against a small dimension into a broadcast at runtime, and a large one
stays a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import cut_lineage


def pick_first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (priority pick).

    ``order`` items are column names, or ``(name, "desc")`` for a numeric
    column taken in descending order.  Written as ``min_by(row, order)``
    aggregation: partial on the map side, so a key with millions of
    candidates never sorts them all in one task (a ranking window would).
    Give an order that is unique within a key for a deterministic pick.
    """
    keyparts = []
    for i, o in enumerate(order):
        name, desc = (o, False) if isinstance(o, str) else (o[0], o[1] == "desc")
        keyparts.append((-F.col(name) if desc else F.col(name)).alias(f"_o{i}"))
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*keyparts)).alias("_best"))
    return best.select(*keys, "_best.*")


def resolve_exact(df: DataFrame, dim: DataFrame, on: dict[str, str], take: dict[str, str],
                  how: str = "left") -> DataFrame:
    """Equi-join on ``on`` (df column -> dim column), adding ``take`` (dim
    column -> new name).  The dim side is deduplicated on its key first so a
    key repeated in the dimension cannot fan out facts (last id wins, as an
    index keyed by that column would keep)."""
    d = dim.select(*[F.col(v).alias(f"_k{i}") for i, v in enumerate(on.values())],
                   *[F.col(k).alias(v) for k, v in take.items()])
    d = d.groupBy(*[f"_k{i}" for i in range(len(on))]).agg(
        *[F.max_by(F.col(v), F.col(list(take.values())[0])).alias(v) for v in take.values()])
    cond = [df[k] == d[f"_k{i}"] for i, k in enumerate(on.keys())]
    return df.join(d, cond, how).drop(*[f"_k{i}" for i in range(len(on))])


def unique_members(dim: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Keys that name exactly one dimension member: (key, id)."""
    return (dim.groupBy(key).agg(F.count("*").alias("_n"), F.min(id_col).alias(id_col))
            .filter("_n = 1").drop("_n"))


def resolve_unique(df: DataFrame, df_key: str, dim: DataFrame, dim_key: str, id_col: str = "id",
                   out: str = "match_id") -> DataFrame:
    """Match only when the key is unique in the dimension (``Springfield`` is not)."""
    u = unique_members(dim, dim_key, id_col).select(F.col(dim_key).alias("_uk"), F.col(id_col).alias(out))
    return df.join(u, df[df_key] == u["_uk"], "left").drop("_uk")


# Texts up to this length meet by what is left of them after deletions, longer ones by their rarest grams.
SHORT = 32
GRAM = 4


def _deletion_keys(texts: DataFrame, text: str, k: int, out: str, gone: str) -> DataFrame:
    """One row per way to delete up to ``k`` (1 or 2) characters: ``out`` the hash of what is left, ``gone`` the deleted
    characters, each with the number of characters left before it.  Of a run of equal characters only the first ones go."""
    n, t = F.length(text), F.col(text)
    char = lambda i: F.substr(t, i, F.lit(1))
    mark = lambda i, before: F.concat_ws(":", i - 1 - before, char(i))
    d = texts.withColumn("_p", F.explode(F.sequence(F.lit(0), n)))
    d = d.filter((F.col("_p") < 2) | (char(F.col("_p")) != char(F.col("_p") - 1)))
    p, q = F.col("_p"), F.col("_q")
    if k == 1:
        d = d.withColumn("_q", F.lit(0))
    else:
        d = d.withColumn("_q", F.explode(F.when((p > 0) & (p < n), F.concat(F.array(F.lit(0)), F.sequence(p + 1, n))).otherwise(F.array(F.lit(0)))))
        d = d.filter((q < p + 2) | (char(q) != char(q - 1)))
    rest = F.when(p == 0, t).when(q == 0, F.concat(F.substr(t, F.lit(1), p - 1), F.substr(t, p + 1))) \
        .otherwise(F.concat(F.substr(t, F.lit(1), p - 1), F.substr(t, p + 1, q - p - 1), F.substr(t, q + 1)))
    marks = F.when(p == 0, F.array().cast("array<string>")).when(q == 0, F.array(mark(p, 0))).otherwise(F.array(mark(p, 0), mark(q, 1)))
    return d.withColumn(out, F.xxhash64(rest)).withColumn(gone, marks).drop("_p", "_q")


def _rare_grams(texts: DataFrame, text: str, k: int, common: DataFrame, out: str) -> DataFrame:
    """One row per gram among the k * GRAM + 1 rarest of each text, in the order that ``common`` (gram, n) gives
    all texts: grams it does not list come first, by hash."""
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text) - GRAM + 1), lambda i: F.xxhash64(F.substr(F.col(text), i, F.lit(GRAM)))))
    d = texts.crossJoin(F.broadcast(common.agg(F.map_from_entries(F.collect_list(F.struct("gram", "n"))).alias("_common"))))   # one row of bounded size
    ranked = F.array_sort(F.transform(grams, lambda g: F.struct(F.coalesce(F.col("_common")[g], F.lit(0)).alias("n"), g.alias("g"))))
    return d.withColumn(out, F.explode(F.transform(F.slice(ranked, 1, k * GRAM + 1), lambda r: r["g"]))).drop("_common")


def _segment(text: Column, length: Column, i: Column, k: int, shift: Column | int = 0) -> Column:
    """Segment ``i`` of the k + 1 nearly equal parts that a text of ``length`` has, cut from ``text`` ``shift`` places on;
    null where it would leave the text."""
    base, longer = F.floor(length / (k + 1)), k + 1 - length % (k + 1)
    size = (base + F.when(i >= longer, 1).otherwise(0)).cast("int")
    start = (i * base + F.greatest(F.lit(0), i - longer) + shift).cast("int")
    return F.when((start >= 0) & (start + size <= F.length(text)), F.substr(text, start + 1, size))


def _meeting_by_segments(left: DataFrame, right: DataFrame, names: list[str], k: int) -> DataFrame:
    """As ``_meeting`` for any ``k``: of k + 1 segments one is unedited, moved by at most k places."""
    parts = F.sequence(F.lit(0), F.lit(k))
    right_keys = right.withColumn("_n", F.length("_dt")).withColumn("_i", F.explode(parts)) \
        .withColumn("_s", _segment(F.col("_dt"), F.col("_n"), F.col("_i"), k))
    near = F.sequence(F.greatest(F.lit(0), F.length("_t") - k), F.length("_t") + k)
    left_keys = left.withColumn("_n", F.explode(near)).withColumn("_i", F.explode(parts)) \
        .withColumn("_shift", F.explode(F.sequence(F.lit(-k), F.lit(k)))) \
        .withColumn("_s", _segment(F.col("_t"), F.col("_n"), F.col("_i"), k, F.col("_shift"))) \
        .filter(F.col("_s").isNotNull()).drop("_shift").distinct()
    return left_keys.join(right_keys.hint("merge"), [*names, "_n", "_i", "_s"]).select(*names, "_t", "_dt")


def _meeting(left: DataFrame, right: DataFrame, names: list[str], k: int) -> DataFrame:
    """(names, _t, _dt) pairs that can lie within ``k`` edits: all that do, few others.

    Both sides of these joins hold many rows per text, which Spark's size estimate does not see (it takes an exploded
    table to be as small as the file): the ``merge`` hint keeps them from being broadcast through the driver."""
    short = lambda df, c, more: _deletion_keys(df.filter(F.length(c) <= SHORT + more), c, k, "_k", f"{c}_gone")
    a, b = short(left, "_t", k), short(right, "_dt", 0)
    # A character deleted at the same place on both sides could stay: that pair meets with fewer deletions.
    pairs = a.join(b.hint("merge"), [*names, "_k"]).filter(~F.arrays_overlap("_t_gone", "_dt_gone")).select(*names, "_t", "_dt")
    long_right = right.filter(F.length("_dt") > SHORT)
    if long_right.isEmpty():
        return pairs
    each = long_right.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("_dt") - GRAM + 1),
                                                   lambda i: F.xxhash64(F.substr(F.col("_dt"), i, F.lit(GRAM))))).alias("gram"))
    counted = each.groupBy("gram").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("_total"))
    # At most 100,000 grams can have more than a hundred-thousandth of all.
    common = counted.crossJoin(F.broadcast(total)).filter(F.col("n") * 100_000 > F.col("_total")).select("gram", "n")
    rare = _rare_grams(left.filter(F.length("_t") > SHORT - k), "_t", k, common, "_k") \
        .join(_rare_grams(long_right, "_dt", k, common, "_k").hint("merge"), [*names, "_k"]) \
        .filter(F.abs(F.length("_t") - F.length("_dt")) <= k)
    return pairs.unionByName(rare.select(*names, "_t", "_dt"))


def fuzzy_candidates(df: DataFrame, text: str, block: list[str], dim: DataFrame, dim_text: str,
                     dim_block: list[str], max_dist: int = 2, min_len: int = 0,
                     len_on: str = "dim", keep: list[str] | None = None) -> DataFrame:
    """All (row, member) pairs in the same block within ``max_dist`` edits.

    Distinct texts of up to SHORT characters meet by equality of (block, what
    is left after deleting up to ``max_dist`` characters): two texts within k
    edits have such a rest in common, and texts that only share a long part (a
    prefix, a usual word) have not, so a common part is never a join key.  Longer
    texts meet by one of their rarest grams: k edits change at most k * GRAM of
    the grams, so of the k * GRAM + 1 rarest one is left.  (Beyond two edits texts
    have too many rests; they meet by equal segments.)  Only pairs that meet
    get an edit distance; the rows are joined to the matched texts at the end.
    ``min_len`` applies to the dimension text (``len_on='dim'``) or the row text
    (``'row'``).
    """
    keep, k = keep or [], max_dist
    names = [f"_b{i}" for i in range(len(block))]
    left = df.select(*[F.col(c).alias(n) for c, n in zip(block, names)], F.col(text).alias("_t")).filter(F.col("_t").isNotNull()).distinct()
    right = dim.select(*[F.col(c).alias(n) for c, n in zip(dim_block, names)], F.col(dim_text).alias("_dt")).filter(F.col("_dt").isNotNull()).distinct()
    if min_len:
        side = "_dt" if len_on == "dim" else "_t"
        left, right = (left, right.filter(F.length(side) >= min_len)) if side == "_dt" else (left.filter(F.length(side) >= min_len), right)
    meet = _meeting if k <= 2 else _meeting_by_segments
    pairs = meet(left, right, names, k).distinct().withColumn("_dist", F.levenshtein("_t", "_dt", k)).filter(F.col("_dist") >= 0)
    d = dim.select(*[F.col(c).alias(n) for c, n in zip(dim_block, names)], F.col(dim_text).alias("_dt"), *[F.col(c) for c in keep])
    full = pairs.join(d, [*names, "_dt"])
    cond = [df[c] == full[n] for c, n in zip([*block, text], [*names, "_t"])]
    return df.join(full, cond).drop(*names, "_t")


# Parts that texts of one length are cut into to find those that differ in two characters.
PARTS = 6
# Names of the first batch that is decided; each batch after it has as many as all before.
FIRST_NAMES = 100_000


def _pairs_of(groups: DataFrame, rows: str, differ=None) -> DataFrame:
    """Arrays of struct<id, ...> -> (_id, _oid): each member with the earlier ones of its group; ``differ(x, y)``: which count."""
    each = groups.filter(F.size(rows) > 1).select(rows, F.explode(rows).alias("_me"))
    earlier = F.filter(rows, lambda x: (x["id"] < F.col("_me.id")) & (F.lit(True) if differ is None else differ(x, F.col("_me"))))
    return each.select(F.col("_me.id").alias("_id"), F.explode(F.transform(earlier, lambda x: x["id"])).alias("_oid"))


def _two_edits_same_length(names: DataFrame, block: list[str], text: str) -> DataFrame:
    """(_id, _oid): all pairs of a block that have one length and lie within two edits.

    Such texts are equal after one deletion in each, or differ in two characters.  For the
    latter no text meets by each two of its characters: first the texts that are equal
    outside of two of ``PARTS`` parts (or of one) come together.  Most have no other there, or one of the two parts
    is the same in all of them (a common prefix, a usual word) and they differ in the other part only, which comes up by
    itself; what is left meets by the rest after one character of each part, without being dealt out again.  What
    meets is within two edits: nothing is compared."""
    t, n = F.col(text), F.length(text)
    char = lambda c, i: F.substr(c, i, F.lit(1))
    without = lambda c, i: F.concat(F.substr(c, F.lit(1), i - 1), F.substr(c, i + 1))
    p, q = F.col("_p"), F.col("_q")
    one = names.filter(n > 0).withColumn("_p", F.explode(F.sequence(F.lit(1), n))).filter((p == 1) | (char(t, p) != char(t, p - 1)))
    one = one.select(*block, without(t, p).alias("_rest"), "_id").repartition(*block, "_rest") \
        .groupBy(*block, "_rest").agg(F.collect_list(F.struct(F.col("_id").alias("id"))).alias("_rows"))

    at = lambda i: F.floor(i * n / PARTS).cast("int")
    part = lambda i: F.substr(t, at(i) + 1, at(i + 1) - at(i))
    cuts = F.array(*[F.struct(F.lit(i * PARTS + j).alias("_cut"), (part(i) if i < j else F.lit("")).alias("_x"), part(j).alias("_y"), F.concat(
        F.substr(t, F.lit(1), at(i)), F.substr(t, at(i + 1) + 1, at(j) - at(i + 1)) if i < j else F.lit(""), F.substr(t, at(j + 1) + 1)).alias("_far"))
        for i in range(PARTS) for j in range(i, PARTS)])
    c = names.select(*block, "_id", n.alias("_n"), F.explode(cuts).alias("_c")).select(*block, "_id", "_n", "_c.*")
    x, y, alone, far = F.col("_x"), F.col("_y"), F.col("_cut") % (PARTS + 1) == 0, [*block, "_n", "_cut", "_far"]
    c = c.filter((F.length(y) > F.when(alone, 1).otherwise(0)) & (alone | (F.length(x) > 0))).repartition(*far)
    same = Window.partitionBy(*far)
    several = lambda part: F.min(part).over(same) != F.max(part).over(same)
    c = c.withColumn("_some_x", several(x)).withColumn("_some_y", several(y)).filter(F.col("_some_y") & (F.col("_some_x") | alone))
    # a part alone: two of its characters; two parts: one of each
    c = c.withColumn("_q", F.explode(F.sequence(F.lit(1), F.length(y))))
    c = c.withColumn("_p", F.explode(F.when(alone, F.when(q > 1, F.sequence(F.lit(1), q - 1))).otherwise(F.sequence(F.lit(1), F.length(x)))))
    rest = F.when(alone, without(without(y, q), p)).otherwise(F.concat(without(x, p), without(y, q)))
    c = c.select(*far, "_p", "_q", rest.alias("_rest"), F.struct(F.col("_id").alias("id"), char(F.when(alone, y).otherwise(x), p).alias("x"), char(y, q).alias("y")).alias("_row"))
    two = c.groupBy(*far, "_p", "_q", "_rest").agg(F.collect_list("_row").alias("_rows"))
    return _pairs_of(one, "_rows").unionByName(_pairs_of(two, "_rows", lambda x, y: (x["x"] != y["x"]) & (x["y"] != y["y"])))


def _two_edits(names: DataFrame, block: list[str], min_len: int, len_on: str) -> DataFrame:
    """Names (block, _t, _id) -> (_id, _oid): all pairs of a block within two edits, the later id first; a pair may come up several times."""
    n = F.length("_t")
    for b in block:   # a name of no block is near no other
        names = names.filter(F.col(b).isNotNull())
    pairs = _two_edits_same_length(names.filter((n <= SHORT) & (n >= min_len)), block, "_t")
    sizes = names.select(*block, n.alias("_n")).distinct()
    near = sizes.withColumn("_n", F.explode(F.array(*[F.col("_n") + d for d in (-2, -1, 1, 2)]))).distinct().withColumn("_near", F.lit(True))
    # texts that may be near one of another length, and long ones
    odd = names.withColumn("_n", n).join(near, [*block, "_n"], "left").filter(F.col("_near") | (F.col("_n") > SHORT)).select(*block, "_t", "_id")
    if odd.isEmpty():
        return pairs
    other = odd.withColumnsRenamed({"_t": "_dt", "_id": "_oid"})
    met = _meeting(odd.drop("_id"), other.drop("_oid"), block, 2).filter((F.length("_t") != F.length("_dt")) | (F.length("_t") > SHORT)).distinct()
    met = met.filter((F.length("_dt" if len_on == "kept" else "_t") >= min_len) & (F.levenshtein("_t", "_dt", 2) >= 0))
    met = met.join(odd, [*block, "_t"]).join(other, [*block, "_dt"]).filter(F.col("_oid") < F.col("_id"))
    return pairs.unionByName(met.select("_id", "_oid"))


def collapse_near(df: DataFrame, text: str, block: list[str], order: list[str], max_dist: int = 2,
                  min_len: int = 0, len_on: str = "kept") -> DataFrame:
    """New names to the ones that stay: (block, text, kept), as if they came in one by one.

    In the order of ``order`` (ties: the text) a name folds into the earliest
    name of its block that stays and lies within ``max_dist`` edits, and stays
    if there is none; a name that has folded takes no others.  Of a repeated
    name the first row counts.  ``min_len`` is the least length of the name
    that stays (``len_on='kept'``) or of the one that folds (``'folded'``).

    Names are numbered in their order and written once; pairs are pairs of numbers.
    The first ``FIRST_NAMES`` names are decided among themselves, and what lies near those that stay folds; then as many again, and so
    on: most names have folded by then and their pairs are never dealt out.  Within such a batch, rounds over the pairs of near
    names: a name that is in no pair the later one stays, its later neighbours
    fold, and pairs with a folded name vanish.  Each round decides the first names of
    every group of pairs at least; the pairs left are written out between rounds.
    """
    rank = F.struct(*order, text)
    names = df.select(*block, text, rank.alias("_rank")).filter(F.col(text).isNotNull()).groupBy(*block, text).agg(F.min("_rank").alias("_rank"))
    keys = [f"_b{i}" for i in range(len(block))]
    names = dense_ids(names, "_rank", 0, "_id").select(*[F.col(b).alias(k) for b, k in zip(block, keys)], F.col(text).alias("_t"), "_id")
    names = cut_lineage(names)
    if max_dist == 2:
        near = _two_edits(names, keys, min_len, len_on)
    else:
        other = names.select(*[F.col(k).alias(f"_o{k}") for k in keys], F.col("_t").alias("_o"), F.col("_id").alias("_oid"))
        near = fuzzy_candidates(names.withColumnRenamed("_t", "_name"), "_name", keys, other, "_o", [f"_o{k}" for k in keys], max_dist, keep=["_oid"]) \
            .filter((F.col("_oid") < F.col("_id")) & (F.length("_dt" if len_on == "kept" else "_name") >= min_len)).select("_id", "_oid")
    near = cut_lineage(near)
    as_earlier = lambda d: d.select(F.col("_id").alias("_oid"))
    into, low, high, top = near.limit(0), 0, FIRST_NAMES, near.agg(F.max("_oid")).first()[0] or 0
    while low < top:
        # of the next names those that have not folded, and all that may fold into them
        pairs = near.filter((F.col("_oid") > low) & (F.col("_oid") <= high))
        pairs = cut_lineage(pairs.join(as_earlier(into.filter((F.col("_id") > low) & (F.col("_id") <= high))), "_oid", "left_anti"))
        left = pairs.filter(F.col("_id") <= high)
        folded = left.select("_id").limit(0)
        while not left.isEmpty():
            stay = left.select("_oid").distinct().join(as_earlier(left).distinct(), "_oid", "left_anti")
            gone = cut_lineage(left.join(stay, "_oid", "left_semi").select("_id").distinct())
            folded = folded.unionByName(gone)
            left = cut_lineage(left.join(gone, "_id", "left_anti").join(as_earlier(gone), "_oid", "left_anti"))
        into = into.unionByName(cut_lineage(pairs.join(as_earlier(folded), "_oid", "left_anti").groupBy("_id").agg(F.min("_oid").alias("_oid"))))
        low, high = high, 2 * high
    into = into.groupBy("_id").agg(F.min("_oid").alias("_oid"))
    into = into.join(names.select(F.col("_id").alias("_oid"), F.col("_t").alias("_into")), "_oid").select("_id", "_into")
    return names.join(into, "_id", "left").select(*[F.col(k).alias(b) for b, k in zip(block, keys)], F.col("_t").alias(text), F.coalesce("_into", "_t").alias("kept"))


def new_members(names: DataFrame, name_col: str, dim: DataFrame, slug_fn) -> DataFrame:
    """Distinct candidate names whose slug is not yet a member: (slug, name).

    For a slug seen with several spellings the smallest spelling is kept so
    the result is deterministic."""
    cand = (names.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull())
            .withColumn("slug", slug_fn(F.col("name"))).filter(F.col("slug") != "")
            .groupBy("slug").agg(F.min("name").alias("name")))
    return cand.join(dim.select("slug").distinct(), "slug", "left_anti")


def dense_ids(df: DataFrame, order_col: str, base: Column | int, id_col: str = "id",
              partitions: int | None = None) -> DataFrame:
    """Assign ``base + 1 .. base + n`` in ``order_col`` order without a
    single-task global window.

    Range-partition by the order key and sort inside partitions; the
    per-partition row index comes from ``monotonically_increasing_id`` and a
    per-partition count table (one row per partition -- bounded by the
    partition count, so broadcasting it is safe) supplies the offsets.  The
    partitioned data is checkpointed to the shared checkpoint folder so both
    uses see the same partitioning, and a lost executor recomputes from it.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    s = (df.repartitionByRange(n, order_col).sortWithinPartitions(order_col)
         .withColumn("_mid", F.monotonically_increasing_id()))
    s = cut_lineage(s)
    s = s.withColumn("_pid", F.shiftright("_mid", 33)).withColumn(
        "_local", F.col("_mid") - F.shiftleft(F.col("_pid"), 33))
    counts = s.groupBy("_pid").agg(F.count("*").alias("_n"))
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    base_col = base if isinstance(base, Column) else F.lit(base)
    return (s.join(F.broadcast(offs.select("_pid", "_off")), "_pid")
            .withColumn(id_col, (base_col + F.col("_off") + F.col("_local") + 1).cast("bigint"))
            .drop("_mid", "_pid", "_local", "_off"))


def add_members(dim: DataFrame, names: DataFrame, name_col: str, slug_fn, extra: dict | None = None) -> DataFrame:
    """Discover new members (anti join on slug) and append them with ids
    after the current ``max(id)``; returns only the *new* rows."""
    new = new_members(names, name_col, dim, slug_fn)
    max_id = dim.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_max"))
    new = new.crossJoin(F.broadcast(max_id))   # one-row table
    out = dense_ids(new, "slug", F.col("_max")).drop("_max")
    for k, v in (extra or {}).items():
        out = out.withColumn(k, v)
    return out


def ids_in_order(df: DataFrame, row_key: str, list_col: str, dim: DataFrame, slug_fn,
                 out_col: str = "ids") -> DataFrame:
    """list<name> -> list<id> through the slug, keeping list order.

    Explode with position, join the dimension on the slug, regroup by the row
    key sorted by position.  Unresolved names are reported in
    ``<out_col>_missing`` instead of failing the job.
    """
    ex = df.select(row_key, F.posexplode_outer(list_col).alias("_pos", "_name"))
    ex = ex.withColumn("slug", slug_fn(F.col("_name")))
    d = dim.groupBy("slug").agg(F.min("id").alias("_id"))
    j = ex.join(d, "slug", "left")
    agg = j.groupBy(row_key).agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_id").isNotNull(), F.struct("_pos", "_id")))),
                    lambda s: s["_id"]).alias(out_col),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("_id").isNull() & F.col("_name").isNotNull(), F.struct("_pos", "_name")))),
                    lambda s: s["_name"]).alias(out_col + "_missing"))
    return df.join(agg, row_key, "left")
