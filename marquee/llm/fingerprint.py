"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, with built-in functions only.

A text's elements are its distinct lines with their multiplicity, as 64-bit
digests.  The sketch has two tables of ``size`` cells (a power of two); an
element goes to one cell of each.  A cell keeps a count, the xor of its
digests and the xor of their check sums.  Only cells in use are kept, ordered,
so tables many times as large as the text cost nothing and few digests meet.
Two sketches subtract cell by cell: equal elements vanish, and peeling cells
that hold a single digest recovers the digests that differ.  A larger sketch
folds to a smaller size.  When peeling gets stuck, both texts are sketched
anew at a larger size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.arrays import let, positions, run_starts
from marquee.llm.common import keyed, saved

# Paragraphs end at line feeds and after sentence ends.
PARTS = r"\n|(?<=[.!?]) "
ROUNDS = 24  # peeling ends by itself long before, or is stuck
CELL = "struct<c:int,n:int,k:bigint,x:bigint>"
SPARE = 16
NO_CELLS = f"array<{CELL}>"
# Documents share a bucket of so many consecutive ids; within it the next document is found by a window.
BUCKET_BITS = 10


def _cell(c: Column, n: Column, k: Column, x: Column) -> Column:
    return F.struct(c.cast("int").alias("c"), n.cast("int").alias("n"), k.alias("k"), x.alias("x"))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(977)).bitwiseAND(F.lit(0xFFFFFFFF))


def elements(text: Column) -> Column:
    """Digests of the distinct lines with their multiplicity; none for an empty text."""
    lines = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, PARTS, -1))
    hashes = F.sort_array(F.transform(lines, lambda x: F.xxhash64(x)))
    return let(hashes, lambda h: let(run_starts(h), lambda s: F.transform(
        s, lambda a, j: F.xxhash64(F.get(h, a - 1), F.coalesce(F.get(s, j + 1), F.size(h) + 1) - a))))


def grouped(cells: Column) -> Column:
    """Cells of the same index added up (counts add, digests and check sums xor); cells that vanish are left out."""
    index = lambda o: F.shiftright(o, 32)  # the order is of longs: cell index, then position
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("x"))

    def add(given: Column) -> Column:
        at = lambda o: F.get(given, o.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
        order = F.sort_array(F.transform(given, lambda c, i: F.shiftleft(c["c"].cast("bigint"), 32).bitwiseOR(i.cast("bigint"))))

        def run(o: Column, s: Column) -> Column:
            def total(a: Column, j: Column) -> Column:
                part = let(F.coalesce(F.get(s, j + 1), F.size(o) + 1) - a, lambda n: F.when(n > 1, F.slice(o, a, n)))
                got = lambda p: F.aggregate(p, zero, lambda t, e: let(at(e), lambda c: F.struct(
                    (t["n"] + c["n"]).alias("n"), t["k"].bitwiseXOR(c["k"]).alias("k"), t["x"].bitwiseXOR(c["x"]).alias("x"))))
                return let(part, lambda p: F.when(p.isNull(), at(F.get(o, a - 1))).otherwise(
                    let(got(p), lambda t: _cell(index(F.get(o, a - 1)), t["n"], t["k"], t["x"]))))
            return F.transform(s, total)

        return let(order, lambda o: let(run_starts(o, index), lambda s: run(o, s)))

    return F.filter(let(cells, add), lambda c: (c["n"] != 0) | (c["k"] != 0) | (c["x"] != 0))


def spread(keys: Column, size: Column, sign: Column | None = None) -> Column:
    """The two cells of each digest, not yet added up.  ``keys``: digests, or structs (k, n) with a sign."""
    def of(e: Column) -> Column:
        k, n = (e["k"], e["n"]) if sign is not None else (e, F.lit(1))
        h = F.xxhash64(k, F.lit(31))
        at = lambda t: F.shiftrightunsigned(h, 31 * t).bitwiseAND((size - 1).cast("bigint"))
        return F.array(*[_cell(F.lit(t) * size + at(t), n if sign is None else n * sign, k, _check(k)) for t in range(2)])
    return F.flatten(F.transform(keys, of))


def sketch(keys: Column, size: Column) -> Column:
    return grouped(spread(keys, size))


def sketch_size(keys: Column) -> Column:
    """A power of two, 16 to 32 times the digests: a difference of twice the digests seldom has a cycle."""
    return (SPARE * F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.size(keys), F.lit(4)).cast("double"))))).cast("int")


def folded(cells: Column, size: Column, to: Column) -> Column:
    """The sketch at the smaller power of two ``to``."""
    return F.transform(cells, lambda c: _cell(F.floor(c["c"] / size).cast("int") * to + F.pmod(c["c"], to), c["n"], c["k"], c["x"]))


def minus(cells: Column) -> Column:
    return F.transform(cells, lambda c: _cell(c["c"], -c["n"], c["k"], c["x"]))


def peeled(difference: Column, size: Column) -> Column:
    """Recovered (digest, sign) pairs of a subtracted sketch, as struct (cells left, found); all are found if no cell is left."""
    found = "array<struct<k:bigint,n:int>>"
    state = lambda cells, got: F.struct(cells.cast(NO_CELLS).alias("cells"), got.cast(found).alias("found"))

    def step(s: Column, _: Column) -> Column:
        pure = F.filter(s["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["k"]) == c["x"]))
        ordered = F.sort_array(F.transform(pure, lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n"))))
        keys = let(ordered, lambda o: F.transform(run_starts(o, lambda e: e["k"]), lambda i: F.get(o, i - 1)))  # a digest may be alone in several cells
        return F.when(F.size(s["cells"]) == 0, s).otherwise(let(keys, lambda p: F.when(F.size(p) == 0, s).otherwise(
            state(grouped(F.concat(s["cells"], spread(p, size, F.lit(-1)))), F.concat(s["found"], p)))))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state(difference, F.array()), step)


def differing(a: Column, a_keys: Column, a_size: Column, b: Column | None, b_keys: Column, b_size: Column) -> Column:
    """Number of digests that differ: from the two sketches, else from larger ones, at last from the digests themselves.

    ``b`` None: its sketch is not at hand and is made at the common size.
    """
    count = lambda cells, size: let(peeled(cells, size), lambda s: F.when(F.size(s["cells"]) == 0, F.size(s["found"])))
    least = F.least(a_size, b_size)
    direct = let(least, lambda to: count(grouped(F.concat(folded(a, a_size, to), minus(spread(b_keys, to) if b is None else folded(b, b_size, to)))), to))

    def retry(factor: int) -> Column:
        size = sketch_size(F.concat(a_keys, b_keys)) * factor
        return let(size, lambda to: count(grouped(F.concat(spread(a_keys, to), minus(spread(b_keys, to)))), to))

    exact = F.size(F.array_except(a_keys, b_keys)) + F.size(F.array_except(b_keys, a_keys))
    hopeless = F.abs(F.size(a_keys) - F.size(b_keys)) > 3 * least  # more differences than cells: no need to try
    return F.coalesce(F.when(~hopeless, direct), retry(1), retry(4), exact)


def likeness(a_keys: Column, b_keys: Column, differ: Column) -> Column:
    """Jaccard index of the elements, from the number that differ; 1 for two texts without elements."""
    both = F.size(a_keys) + F.size(b_keys)
    return F.when(both == 0, F.lit(1.0)).otherwise((both - differ) / (both + differ).cast("double"))


def as_text(keys: Column, size: Column, cells: Column) -> Column:
    """elements:size:cell,cell..., a cell being index.count.digests.checks in hexadecimal."""
    cell = lambda c: F.concat_ws(".", F.hex(c["c"]), c["n"].cast("string"), F.hex(c["k"]), F.hex(c["x"]))
    return F.concat_ws(":", F.size(keys).cast("string"), size.cast("string"), F.concat_ws(",", F.transform(cells, cell)))


def with_next(docs: DataFrame) -> DataFrame:
    """Adds ``after``: text and elements of the next document by ascending doc_id (after the last: the first).

    One shuffle of the texts, by buckets of consecutive ids; the first document
    of each bucket, a thousandth of the rows, also goes to the bucket before.
    Equal ids follow one another by text.  A row without id has no next one.
    """
    bucket = F.shiftright(F.col("doc_id"), BUCKET_BITS)
    ids = docs.filter("doc_id is not null").groupBy(bucket.alias("bucket")).agg(F.min("doc_id").alias("head"))
    order = Window.orderBy("bucket")
    ends = Window.orderBy(F.col("bucket").desc())
    heads = saved(ids.select("head", F.coalesce(F.lag("bucket").over(order), F.first("bucket").over(ends)).alias("before")), "heads")
    rows = docs.select("doc_id", "text", elements(F.col("text")).alias("keys"))
    follow = rows.join(heads, F.col("doc_id") == F.col("head")).groupBy("before").agg(
        F.min(F.struct("text", "keys")).alias("first_after"))
    own = rows.filter("doc_id is not null").withColumn("bucket", bucket)
    line = Window.partitionBy("bucket").orderBy("doc_id", "text")
    placed = own.withColumn("follows", F.lead(F.struct("text", "keys")).over(line))
    joined = placed.join(follow, F.col("bucket") == F.col("before"), "left") \
        .select("doc_id", "text", "keys", F.coalesce("follows", "first_after").alias("after"))
    return joined.unionByName(rows.filter("doc_id is null").withColumn("after", F.lit(None).cast(joined.schema["after"].dataType)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    Edited: the last half of the code points (rounded down) replaced by the
    first as many (or all) of the next document.  Null texts are empty.  Rows
    without id have no next document: their tail is dropped, and the document
    that they are compared with is empty.
    """
    rows = with_next(keyed(docs, id_col, text_col))
    half = F.floor(F.length("text") / 2).cast("int")
    none = F.array().cast("array<bigint>")
    rows = rows.select("doc_id", "text", "keys", half.alias("half"), F.coalesce("after.text", F.lit("")).alias("next_text"),
                       F.coalesce("after.keys", none).alias("next_keys"))
    rows = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), "keys", "next_keys",
                       F.concat(F.expr("left(text, length(text) - half)"), F.expr("left(next_text, half)")).alias("edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       "keys", elements(F.col("edited")).alias("edited_keys"), "next_keys")
    names = ("keys", "edited_keys")
    rows = rows.select("*", *[sketch_size(F.col(c)).alias(f"size_{c}") for c in (*names, "next_keys")])
    rows = rows.select("*", *[sketch(F.col(c), F.col(f"size_{c}")).alias(f"cells_{c}") for c in names])
    trio = lambda c: (F.col(f"cells_{c}"), F.col(c), F.col(f"size_{c}"))
    rows = rows.select("*", differing(*trio("keys"), *trio("edited_keys")).alias("differ_edited_keys"),
                       differing(*trio("keys"), None, F.col("next_keys"), F.col("size_next_keys")).alias("differ_next_keys"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", *[
            as_text(F.col(c), F.col(f"size_{c}"), F.col(f"cells_{c}")).alias(n) for c, n in zip(names, ("fingerprint", "edited_fingerprint"))],
        *[likeness(F.col("keys"), F.col(c), F.col(f"differ_{c}")).alias(n) for c, n in (("edited_keys", "near_edited"), ("next_keys", "near_next"))],
        F.col("differ_edited_keys").alias("n_differ_edited"), F.col("differ_next_keys").alias("n_differ_next"))
