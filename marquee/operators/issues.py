"""Whole issues as lines -> event and tour records, across page breaks and partition edges.

Lines are rows (keys, line number, line); no file, page or section is ever one
array.  What depends on everything before a line is computed by prefix sums
and joins that cut anywhere:

* being inside a section and the record that a line belongs to are "the last mark
  at or before this line" (``lines.forward_fill``: one summary per chunk, a prefix
  over the summaries, a window inside each chunk);
* the ranks of a section are a chain: the first line that can be rank 1, after
  it the first that can be rank 2, and so on.  Every line that can be rank r points
  to the next one that can be rank r + 1; the chain from rank 1 is marked by pointer
  doubling, in as many rounds as its length has binary digits.

That writes every line several times.  Tours of files of up to ``FOLDED`` lines are
therefore read in one pass: their lines come together once (not at all where the input
is dealt out by its keys already) and are folded as one array of bounded size.

A record takes at most ``MAX_LINES`` lines from its first; lines further on,
lines before the first record and lines behind the cut of a section's last tour
stay as rows with a reason.  Lines outside of sections are no part of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.text import clean_ocr_line, let
from marquee.operators import lines, records
from marquee.session import cut_lineage

MAX_LINES = 200
FOLDED = 8192   # lines of a file, or lines with a rank of a section, up to which they are one array: bounds the array and the fold over it


def _is_end(line: Column) -> Column:
    return line.startswith(records.SECTION_END)


def _sections(df: DataFrame, keys: list[str], order: str, head: Column, is_end: Column) -> DataFrame:
    """``_head`` (line number of the heading that a line stands under, 0 outside) and ``_name`` (what ``head`` gives there)."""
    mark = F.when(head.isNotNull(), F.struct(F.col(order).cast("long").alias("at"), head.alias("name"))) \
        .when(is_end, F.struct(F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("name")))
    d = lines.forward_fill(df.withColumn("_mark", mark), keys, order, "_mark", "_in")
    d = d.filter(F.col("_in.at") >= 0).select(*df.columns, F.col("_in.at").alias("_head"), F.col("_in.name").alias("_name"))
    return d.filter(F.col(order) != F.col("_head"))


def _records(df: DataFrame, keys: list[str], order: str, line: str, sep: str, cut=None) -> tuple[DataFrame, DataFrame]:
    """Lines with ``_open`` (line number of the first line of their record, null before the first) -> (records: keys,
    first_line, raw; rows: keys, first_line, raw, reason)."""
    far = F.col(order) >= F.col("_open") + MAX_LINES
    d = df.withColumn("_why", F.when(F.col("_open").isNull(), "before the first record").when(far, f"over {MAX_LINES} lines of a record"))
    some = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(line))))
    whole = d.filter("_why is null").groupBy(*keys, F.col("_open").alias("first_line")) \
        .agg(F.array_join(F.transform(some, lambda s: s[line]), sep).alias("raw"))
    loose = d.filter("_why is not null").select(*keys, F.col(order).cast("long").alias("first_line"), F.col(line).alias("raw"), F.col("_why").alias("reason"))
    return whole, loose


def issue_events(df: DataFrame, keys: list[str], order: str = "line_no", line: str = "line") -> DataFrame:
    """Lines of whole issues -> keys, first_line, raw, event, reason.

    An event opens at a first line inside a section and goes on over page
    breaks and repeated headings until the next first line or the end of the
    section.
    """
    d = df.select(*keys, order, clean_ocr_line(F.col(line)).alias(line))
    header = F.when(F.col(line) == records.SECTION_HEADER, F.lit("events"))
    d = _sections(d, keys, order, header, _is_end(F.col(line)))
    opens = F.when(F.col(line).rlike(records.NEW_EVENT), F.col(order).cast("long"))
    # the opening line counts while no section has ended since: sections that follow without an end are one
    ends = df.filter(_is_end(F.col(line))).select(*keys, order, F.lit(None).cast("string").alias(line), F.lit(-1).cast("long").alias("_mark"))
    marked = d.select(*keys, order, line, opens.alias("_mark")).unionByName(ends)
    filled = lines.forward_fill(marked, keys, order, "_mark", "_open").filter(F.col(line).isNotNull())
    filled = filled.withColumn("_open", F.when(F.col("_open") >= 0, F.col("_open")))
    whole, loose = _records(filled, keys, order, line, " | ")
    return records.with_reasons(whole.withColumn("reason", F.lit(None).cast("string")).unionByName(loose), "raw") \
        .select(*keys, "first_line", "raw", "event", "reason")


def _chain(d: DataFrame, keys: list[str], order: str, line: str) -> DataFrame:
    """(keys, _head, at, rank): the lines that open the tours of each section."""
    number = F.regexp_extract(line, records.RANK_LINE, 1)
    size = F.length(number)
    could = F.array_distinct(F.array(number, F.substr(number, F.lit(2)), F.left(number, size - 1), F.substr(number, F.lit(2), size - 2)))
    could = F.transform(F.filter(could, lambda v: v.rlike("^[1-9][0-9]{0,8}$")), lambda v: v.cast("int"))
    section = [*keys, "_head"]
    c = d.filter((F.length(line) > 15) & (number != "")).select(*section, F.col(order).cast("long").alias("at"), could.alias("ranks")).filter(F.size("ranks") > 0)
    large = cut_lineage(c.groupBy(*section).count().filter(F.col("count") > FOLDED).select(*section))
    if large.isEmpty():
        return _folded(c, section)
    same = [c[k].eqNullSafe(large[k]) for k in section]
    return _folded(c.join(large, same, "left_anti"), section).unionByName(_doubled(c.join(large, same, "left_semi"), section))


def _folded(c: DataFrame, section: list[str]) -> DataFrame:
    """The chain of each section (at, ranks), line after line."""
    state = lambda at, rank, marks: F.struct(at.alias("at"), rank.alias("rank"), marks.alias("marks"))

    def step(acc, s):
        want = acc["rank"] + 1
        opens = (s["at"] > acc["at"]) & F.array_contains(s["ranks"], want)
        return F.when(opens, state(s["at"], want, F.array_append(acc["marks"], F.struct(s["at"].alias("at"), want.alias("rank"))))).otherwise(acc)

    start = state(F.lit(-(1 << 63)), F.lit(0), F.array().cast("array<struct<at:bigint,rank:int>>"))
    rows = c.groupBy(*section).agg(F.array_sort(F.collect_list(F.struct("at", "ranks"))).alias("_rows"))
    return rows.select(*section, F.explode(F.aggregate("_rows", start, step)["marks"]).alias("_m")).select(*section, "_m.at", "_m.rank")


def _doubled(c: DataFrame, section: list[str]) -> DataFrame:
    """As ``_folded``, by pointer doubling: no section is one array."""
    c = cut_lineage(c.select(*section, "at", F.explode("ranks").alias("rank")))
    # each place that can be rank r looks for the nearest later one that can be rank r + 1
    both = c.withColumn("_have", F.col("at")).unionByName(c.select(*section, "at", (F.col("rank") + 1).alias("rank"), F.lit(None).cast("long").alias("_have")))
    later = Window.partitionBy(*section, "rank").orderBy(F.desc("at")).rangeBetween(Window.unboundedPreceding, -1)
    step = both.withColumn("_to", F.min("_have").over(later)).filter("_have is null and _to is not null") \
        .select(*section, "at", (F.col("rank") - 1).alias("rank"), "_to", F.col("rank").alias("_to_rank"))
    jump = cut_lineage(step)
    found = cut_lineage(c.filter("rank = 1").groupBy(*section).agg(F.min("at").alias("at"), F.lit(1).alias("rank")))
    while True:
        more = found.join(jump, [*section, "at", "rank"]).select(*section, F.col("_to").alias("at"), F.col("_to_rank").alias("rank"))
        more = cut_lineage(more)
        if more.isEmpty():
            return found
        found = found.unionByName(more)
        on = jump.select(*section, F.col("at").alias("_to"), F.col("rank").alias("_to_rank"), F.col("_to").alias("_far"), F.col("_to_rank").alias("_far_rank"))
        jump = cut_lineage(jump.join(on, [*section, "_to", "_to_rank"]).select(
            *section, "at", "rank", F.col("_far").alias("_to"), F.col("_far_rank").alias("_to_rank")))


def _is_rank(number: Column, rank: Column) -> Column:
    """The number of a line is ``rank``, or ``rank`` with one misread digit on either side."""
    want, size = rank.cast("string"), F.length(number)
    return (number == want) | (F.substr(number, F.lit(2)) == want) | (F.left(number, size - 1) == want) | (F.substr(number, F.lit(2), size - 2) == want)


def _short_tours(d: DataFrame, keys: list[str], order: str, line: str, head: Column) -> DataFrame:
    """Tours and loose lines of files that are one array each: keys, _name, rank, first_line, raw, _last, _why."""
    number = F.when(F.length(line) > 15, F.nullif(F.regexp_extract(line, records.RANK_LINE, 1), F.lit("")))
    for k in keys:   # lines of no file are no tours
        number = F.when(F.col(k).isNotNull(), number)
    one = F.struct(F.col(order).cast("long").alias("at"), F.col(line).alias("line"), head.alias("name"), _is_end(F.col(line)).alias("ends"), number.alias("number"))
    files = d.filter(F.col(order).isNotNull()).groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("_rows"))
    # A mark is the place of a line that opens something, and one more than the number of the mark of its heading (0
    # outside of sections): a tour's rank is its distance from that mark.  The state is copied for every line, so marks are numbers.
    state = lambda head, at, marks: F.struct(head.alias("head"), at.alias("at"), marks.alias("marks"))

    def step(acc, s):
        n = F.size(acc["marks"])
        noted = lambda head: state(head, s["at"], F.array_append(acc["marks"], F.shiftleft(s["i"].cast("long"), 32) + head))
        opens = (acc["head"] > 0) & s["number"].isNotNull() & (s["at"] > acc["at"])
        return F.when(s["name"].isNotNull() & (s["at"] >= 0), noted(n + 1)).when(s["name"].isNotNull() | s["ends"], noted(F.lit(0))) \
            .when(opens & _is_rank(s["number"], n + 1 - acc["head"]), noted(acc["head"])).otherwise(acc)

    start = state(F.lit(0), F.lit(-(1 << 63)), F.array().cast("array<bigint>"))
    # lines of one number are one place: what opens there opens at the first of them
    place_of = lambda s, i: F.when(F.get("_rows", i - 1)["at"] == s["at"], F.array_position(F.col("_rows.at"), s["at"]).cast("int") - 1).otherwise(i)
    some = F.filter(F.transform("_rows", lambda s, i: F.struct(F.when(s["number"].isNotNull(), place_of(s, i)).otherwise(i).alias("i"), s["at"].alias("at"), s["name"].alias("name"), s["ends"].alias("ends"), s["number"].alias("number"))),
                    lambda s: s["name"].isNotNull() | s["ends"] | s["number"].isNotNull())
    files = files.withColumn("_marks", F.aggregate(some, start, step)["marks"])
    place, heading = lambda m: F.shiftright(m, 32).cast("int"), lambda m: m.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    # a heading or a tour has the lines up to the next mark
    part = F.transform("_marks", lambda m, j: let(F.get("_marks", j + 1), lambda after: F.when(heading(m) > 0, F.struct(
        F.get("_rows", place(F.get("_marks", heading(m) - 1)))["name"].alias("name"), (j + 1 - heading(m)).alias("rank"),
        (after.isNull() | (heading(after) != heading(m))).alias("last"),
        F.slice("_rows", place(m) + 1, F.coalesce(place(after), F.size("_rows")) - place(m)).alias("rows")))))
    parts = files.select(*keys, F.explode(F.array_compact(part)).alias("_p")).select(*keys, "_p.*")
    first, tour = F.get("rows", 0)["at"], F.col("rank") > 0
    parts = parts.withColumn("_first", first).withColumn("_far", F.when(tour, F.element_at("rows", -1)["at"] >= first + MAX_LINES).otherwise(F.lit(False)))
    near = F.when(F.col("_far"), F.filter("rows", lambda s: s["at"] < F.col("_first") + MAX_LINES)).otherwise(F.col("rows"))
    ranked = lambda text: F.concat(F.col("rank").cast("string"), F.regexp_replace(text, "^[^A-Za-z0-9]?[0-9]+", ""))
    opening = F.array_sort(F.transform(F.filter(near, lambda s: s["at"] == F.col("_first")), lambda s: ranked(s["line"])))
    after = F.filter(near, lambda s: s["at"] > F.col("_first"))["line"]
    raw = F.when(F.get("rows", 1)["at"] == F.col("_first"), F.array_join(F.concat(opening, after), " ")).otherwise(ranked(F.array_join(near["line"], " ")))
    row = lambda at, rank, text, why: F.struct(at.alias("first_line"), rank.alias("rank"), text.alias("raw"), why.alias("_why"))
    no_rank, no_why = F.lit(None).cast("int"), F.lit(None).cast("string")
    loose = lambda rows, why: F.transform(rows, lambda s: row(s["at"], no_rank, s["line"], F.lit(why)))
    whole = F.array(row(F.col("_first"), F.col("rank"), raw, no_why))
    far = loose(F.filter("rows", lambda s: s["at"] >= F.col("_first") + MAX_LINES), f"over {MAX_LINES} lines of a record")
    out = F.when(F.col("_far"), F.concat(whole, far)).when(tour, whole).otherwise(loose(F.filter("rows", lambda s: s["at"] != F.col("_first")), "before the first record"))
    return parts.select(*keys, F.col("name").alias("_name"), F.col("last").alias("_last"), F.explode(out).alias("_r")).select(*keys, "_name", "_last", "_r.*")


def _long_tours(d: DataFrame, keys: list[str], order: str, line: str, head: Column) -> DataFrame:
    """As ``_short_tours``, for files of any length: no file or section is one array."""
    d = cut_lineage(_sections(d, keys, order, head, _is_end(F.col(line))))
    opened = _chain(d, keys, order, line)
    d = d.join(opened.withColumnRenamed("at", order), [*keys, "_head", order], "left")
    rest = F.regexp_replace(line, "^[^A-Za-z0-9]?[0-9]+", "")
    d = d.withColumn(line, F.when(F.col("rank").isNotNull(), F.concat(F.col("rank").cast("string"), rest)).otherwise(F.col(line)))
    d = d.withColumn("_mark", F.when(F.col("rank").isNotNull(), F.col(order).cast("long")))
    d = lines.forward_fill(d, [*keys, "_head"], order, "_mark", "_open")
    whole, loose = _records(d, [*keys, "_head", "_name"], order, line, " ")
    last = opened.groupBy(*keys, "_head").agg(F.max("rank").alias("_to"))
    tours = whole.join(opened.select(*keys, "_head", F.col("at").alias("first_line"), "rank"), [*keys, "_head", "first_line"]) \
        .join(last, [*keys, "_head"]).withColumn("_last", F.col("rank") == F.col("_to")).withColumn("_why", F.lit(None).cast("string"))
    loose = loose.withColumn("rank", F.lit(None).cast("int")).withColumn("_last", F.lit(False)).withColumnRenamed("reason", "_why")
    cols = [*keys, "_name", "_last", "first_line", "rank", "raw", "_why"]
    return tours.select(*cols).unionByName(loose.select(*cols))


def issue_tours(df: DataFrame, keys: list[str], order: str = "line_no", line: str = "line", sections: dict[str, str] | None = None,
                sizes: DataFrame | None = None) -> DataFrame:
    """Lines of whole issues -> keys, size, rank, first_line, raw, tour, reason.

    Sections begin at their heading and end at the next one or at a copyright
    line.  Within a section ranks go on by one from 1 (``records.ranked_tours``
    has the rule); every other line belongs to the tour before it.  The last
    tour of a section is cut behind its first asterisk, where other matter of the
    page may follow it; the matter stays as a row with a reason.

    ``sizes`` (keys, lines), where it is cheaper than a count of ``df``: about how many lines a file has.
    """
    d = df.select(*keys, order, F.trim(F.translate(F.col(line), "»", "")).alias(line))
    heads = F.create_map(*[F.lit(x) for kv in (sections or records.TOUR_SECTIONS).items() for x in kv])
    head = heads[F.col(line)]
    sizes = df.groupBy(*keys).agg(F.count("*").alias("lines")) if sizes is None else sizes
    large = cut_lineage(sizes.filter(F.col("lines") > FOLDED).select(*keys, F.lit(True).alias("_large")).distinct())
    if large.isEmpty():
        every = _short_tours(d, keys, order, line, head)
    else:   # at most one file of each FOLDED lines is large
        same = F.lit(True)
        for k in keys:
            same = same & d[k].eqNullSafe(large[k])
        part = lambda how: d.join(F.broadcast(large), same, how)
        every = _short_tours(part("left_anti"), keys, order, line, head).unionByName(_long_tours(part("left_semi"), keys, order, line, head))
    behind = F.when(F.col("_last") & F.col("rank").isNotNull() & F.col("raw").contains("*"), F.trim(F.substr("raw", F.instr("raw", "*") + 1)))
    every = every.withColumn("_behind", F.coalesce(behind, F.lit("")))
    # each row once, and for the last tours their matter
    twice = F.when(F.col("_behind") != "", F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    every = every.withColumn("_matter", F.explode(twice))
    cut = F.when(F.col("_behind") != "", F.concat(F.substring_index("raw", "*", 1), F.lit("*"))).otherwise(F.col("raw"))
    every = every.withColumn("raw", F.when(F.col("_matter"), F.col("_behind")).otherwise(cut)) \
        .withColumn("rank", F.when(~F.col("_matter"), F.col("rank"))).withColumn("_why", F.when(F.col("_matter"), F.lit("behind the last tour")).otherwise(F.col("_why")))
    parsed = records.parse_tour_lines(every.withColumn("_tour_line", F.when(F.col("_why").isNull(), F.col("raw"))), "_tour_line")
    return parsed.select(*keys, F.col("_name").alias("size"), "rank", "first_line", "raw", F.when(F.col("_why").isNull(), F.col("tour")).alias("tour"),
                         F.coalesce("_why", "tour_error").alias("reason"))
