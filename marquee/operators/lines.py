"""Ordered-line operators: text -> lines, grouping, forward fill, section slicing.

Running values over the lines of a file (group numbers, forward fill, ranks)
are computed in two levels so that one huge file never becomes one window
task: lines are cut into fixed-size chunks, a per-chunk summary (one row per
chunk) gets the prefix across chunks, and a window inside each chunk adds
the local part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 65536   # lines per chunk: bounds the rows in any one window partition


def explode_lines(df: DataFrame, keys: list[str], text: str = "text",
                  line_no: str = "line_no", line: str = "line") -> DataFrame:
    """(keys, text) -> (keys, line_no, line), ``line_no`` 0-based."""
    return df.select(*keys, F.posexplode(F.split(F.col(text), r"\r?\n")).alias(line_no, line))


def running_count(df: DataFrame, keys: list[str], order: str, flag: Column, out: str) -> DataFrame:
    """``out`` = number of rows with ``flag`` at or before this row (per keys,
    by ``order``).  Two-level prefix sum, see module doc."""
    d = df.withColumn("_chunk", F.floor(F.col(order) / CHUNK)).withColumn("_f", flag.cast("int"))
    per_chunk = d.groupBy(*keys, "_chunk").agg(F.sum("_f").alias("_cnt"))
    carry = per_chunk.withColumn("_carry", F.coalesce(F.sum("_cnt").over(
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).drop("_cnt")
    local = F.sum("_f").over(Window.partitionBy(*keys, "_chunk").orderBy(order)
                             .rowsBetween(Window.unboundedPreceding, 0))
    return (d.join(carry, [*keys, "_chunk"]).withColumn(out, (F.col("_carry") + local).cast("bigint"))
            .drop("_chunk", "_f", "_carry"))


def forward_fill(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """``out`` = last non-null ``value`` at or before this row (header fill)."""
    d = df.withColumn("_chunk", F.floor(F.col(order) / CHUNK))
    # one summary row per chunk: its last non-null value (null if none)
    per_chunk = d.groupBy(*keys, "_chunk").agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias("_last"))
    carry_all = per_chunk.withColumn("_carry", F.last("_last", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))).drop("_last")
    local = F.last(value, ignorenulls=True).over(
        Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return (d.join(carry_all, [*keys, "_chunk"], "left")
            .withColumn(out, F.coalesce(local, F.col("_carry"))).drop("_chunk", "_carry"))


def group_lines(df: DataFrame, keys: list[str], order: str, line: str, is_start: Column,
                sep: str = " | ", out: str = "text") -> DataFrame:
    """Consecutive lines -> records: a line with ``is_start`` opens a new
    record; lines before the first start form record 0.

    Returns (keys, group_no, first_line, n_lines, out) with the lines of each
    record joined by ``sep`` in line order.
    """
    g = running_count(df, keys, order, is_start, "group_no")
    return (g.groupBy(*keys, "group_no")
            .agg(F.min(order).alias("first_line"), F.count("*").alias("n_lines"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order), F.col(line)))),
                                          lambda s: s[line]), sep).alias(out)))


def section_bounds(df: DataFrame, keys: list[str], order: str, is_header: Column, is_end: Column) -> DataFrame:
    """Per key: first header line and the first end line after it (null =
    no end).  Plain aggregations (map-side partial), so a hot key is cheap."""
    h = df.filter(is_header).groupBy(*keys).agg(F.min(order).alias("header_line"))
    e = (df.join(h, keys).filter(is_end & (F.col(order) > F.col("header_line")))
         .groupBy(*keys).agg(F.min(order).alias("end_line")))
    return h.join(e, keys, "left")


def slice_section(df: DataFrame, keys: list[str], order: str, is_header: Column, is_end: Column) -> DataFrame:
    """Lines strictly after the first header and before the next end marker."""
    b = section_bounds(df, keys, order, is_header, is_end)
    return (df.join(b, keys).filter((F.col(order) > F.col("header_line"))
                                    & (F.col("end_line").isNull() | (F.col(order) < F.col("end_line"))))
            .drop("header_line", "end_line"))


def section_lines(text: Column, is_header, is_end, marker: str | None = "*") -> Column:
    """The section of one text as array<struct<line_no, line>>: the lines
    strictly after the first header line and before the next end line, the
    last one cut at its first ``marker`` (None: not cut).  Null without a header.  The section lies in one text, so
    nothing is shuffled.  ``is_header`` / ``is_end``: line -> condition."""
    from marquee.functions.text import let

    def cut(all_lines: Column) -> Column:
        numbered = F.transform(all_lines, lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))
        at = lambda rule: F.filter(numbered, lambda s: rule(s["line"]))
        head = F.get(at(is_header), 0)["line_no"]

        def body(h: Column) -> Column:
            stop = F.get(F.filter(at(is_end), lambda s: s["line_no"] > h), 0)["line_no"]
            rows = let(stop, lambda e: F.filter(numbered, lambda s: (s["line_no"] > h) & (e.isNull() | (s["line_no"] < e))))
            if marker is None:
                return rows
            return let(rows, lambda r: F.transform(r, lambda s, i: F.struct(
                s["line_no"].alias("line_no"),
                F.when((i == F.size(r) - 1) & s["line"].contains(marker), F.substring_index(s["line"], marker, 1))
                .otherwise(s["line"]).alias("line"))))

        return let(head, lambda h: F.when(h.isNotNull(), body(h)))

    return let(F.split(text, r"\r?\n"), cut)


def first_page_with(df: DataFrame, keys: list[str], page: str, text: str, marker: str) -> DataFrame:
    """Per key, the first page whose text contains ``marker``."""
    return (df.filter(F.col(text).contains(marker)).groupBy(*keys)
            .agg(F.min(page).alias("page")))


def cut_last_at(df: DataFrame, keys: list[str], order: str, line: str, marker: str = "*") -> DataFrame:
    """Cut the last line of each key at the first ``marker`` (trailing notes)."""
    last = df.groupBy(*keys).agg(F.max(order).alias("_last"))
    return (df.join(last, keys)
            .withColumn(line, F.when((F.col(order) == F.col("_last")) & F.col(line).contains(marker),
                                     F.substring_index(F.col(line), marker, 1)).otherwise(F.col(line)))
            .drop("_last"))


def rank_in_group(df: DataFrame, keys: list[str], order: str, out: str = "rank") -> DataFrame:
    """1-based position of each row within its group (running count of rows)."""
    return running_count(df, keys, order, F.lit(True), out)
