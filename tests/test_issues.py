"""Whole issues against a plain loop over the lines, with chunks that cut everywhere, and one long file."""
import random
import re

import pytest
from pyspark.sql import functions as F

from marquee.operators import issues, lines, records

HEADS = list(records.TOUR_SECTIONS)
END = "Copyrighted by someone"


def tours_by_loop(rows):
    """The rule of the ranks, line by line: {(first line, size, rank): lines}, loose lines."""
    size = rank = None
    tours, loose = [], []

    def cut():  # the last tour of a section ends behind its asterisk
        if size and rank and "*" in tours[-1][3]:
            tours[-1][3] = tours[-1][3].split("*")[0] + "*"

    for no, line in [*rows, (len(rows), END)]:
        if line in records.TOUR_SECTIONS:
            cut()
            size, rank = records.TOUR_SECTIONS[line], 0
            continue
        if line.startswith("Copyrighted"):
            cut()
            size = None
        if size is None:
            continue
        m = re.match(records.RANK_LINE, line)
        want = str(rank + 1)
        if m and len(line) > 15 and want in (m[1], m[1][1:], m[1][:-1], m[1][1:-1]):
            rank += 1
            tours.append([no, size, rank, want + re.sub("^[^A-Za-z0-9]?[0-9]+", "", line)])
        elif rank:
            tours[-1][3] += " " + line
        else:
            loose.append((no, line))
    return [tuple(t) for t in tours], loose


def random_lines(rnd, n):
    kinds = [lambda k: f"{k} | ARTIST {k} — a tour", lambda k: f"*{k}7 [ ARTIST {k}", lambda k: f"9{k} ) ARTIST {k} again", lambda k: "overflow of it",
             lambda k: f"{k} | short", lambda k: HEADS[k % 3], lambda k: END, lambda k: f"{k + 20} | ARTIST not next"]
    k, out = 1, []
    for no in range(n):
        kind = rnd.choices(range(8), [8, 4, 4, 4, 1, 1, 0.3, 2])[0]
        out.append((no, kinds[kind](k)))
        k = 1 if kind in (5, 6) else k + (kind < 3)
    return out


@pytest.mark.parametrize("chunk", [1, 7])
def test_tours_against_a_loop(spark, monkeypatch, chunk):
    monkeypatch.setattr(lines, "CHUNK", chunk)
    rnd = random.Random(chunk)
    files = {f: random_lines(rnd, 120) for f in range(4)}
    df = spark.createDataFrame([(f, no, t) for f, rows in files.items() for no, t in rows], "file int, line_no long, line string").repartition(7)
    got = issues.issue_tours(df, ["file"]).collect()
    for f, rows in files.items():
        tours, loose = tours_by_loop(rows)
        assert sorted((r.first_line, r.size, r["rank"], r.raw) for r in got if r.file == f and r["rank"]) == tours
        assert sorted((r.first_line, r.raw) for r in got if r.file == f and r.reason == "before the first record") == loose


def test_last_tour_is_cut_and_matter_kept(spark):
    rows = [HEADS[1], "1 | DIO — Avalon, Hall, Tampa, May 1", "1,000 8.00 8,000* AN ADVERT 5*", "more of the page", END, "2 | RATT — not a tour here"]
    got = issues.issue_tours(spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "line_no int, line string"), []).collect()
    tour, = [r for r in got if r["rank"]]
    assert (tour.size, tour.tour.was_sold_out, tour.tour.gross_receipts, tour.reason) == ("Arena", True, 8000, None)
    assert [(r.raw, r.reason) for r in got if not r["rank"]] == [("AN ADVERT 5* more of the page", "behind the last tour")]


def events_by_loop(rows):
    inside, events, loose = False, [], []
    opened = None
    for no, line in rows:
        if line == records.SECTION_HEADER:
            inside = True
            continue
        if line.startswith("Copyrighted"):
            inside, opened = False, None
        elif inside and line.endswith("Avalon"):
            opened = [no, line]
            events.append(opened)
        elif inside and opened:
            opened[1] += " | " + line
        elif inside:
            loose.append((no, line))
    return [tuple(e) for e in events], loose


@pytest.mark.parametrize("chunk", [1, 7])
def test_events_go_on_over_page_breaks(spark, monkeypatch, chunk):
    monkeypatch.setattr(lines, "CHUNK", chunk)
    rnd = random.Random(chunk)
    some = lambda no: rnd.choices([f"ACT {no} Arena Nov. 3 $12,345 1,000 Avalon", "DADS Landover, Md, $15.50", records.SECTION_HEADER, END], [4, 5, 1, 1])[0]
    files = {f: [(no, some(no)) for no in range(90)] for f in range(4)}
    df = spark.createDataFrame([(f, no, t) for f, rows in files.items() for no, t in rows], "file int, line_no long, line string").repartition(5)
    got = issues.issue_events(df, ["file"]).collect()
    for f, rows in files.items():
        events, loose = events_by_loop(rows)
        assert sorted((r.first_line, r.raw) for r in got if r.file == f and r.event) == events
        assert sorted((r.first_line, r.raw) for r in got if r.file == f and r.reason == "before the first record") == loose


def test_a_long_file_in_bounded_tasks(spark):
    """A million lines of one file, one section: no record takes more than MAX_LINES, every other line stays a row."""
    n = 1_000_000
    i = F.col("id")
    line = F.when(i == 0, F.lit(records.SECTION_HEADER)).when(i % 1000 == 1, F.concat(F.lit("ACT "), i.cast("string"), F.lit(" Arena Nov. 3 $12,345 1,000 Avalon"))) \
        .otherwise(F.lit("DADS Landover"))
    got = issues.issue_events(spark.range(n).select(i.alias("line_no"), line.alias("line")), [])
    counts = {(r.reason, r.size): r.n for r in got.groupBy("reason", F.size(F.split("raw", r" \| ")).alias("size")).agg(F.count("*").alias("n")).collect()}
    whole = {s for (reason, s) in counts if reason is None}
    assert counts[None, issues.MAX_LINES] == 1000 and whole == {issues.MAX_LINES}
    assert sum(k[1] * v for k, v in counts.items()) == n - 1


def test_no_lines(spark):
    df = spark.createDataFrame([], "file int, line_no long, line string")
    assert issues.issue_tours(df, ["file"]).count() == 0 and issues.issue_events(df, ["file"]).count() == 0


@pytest.mark.parametrize("folded", [0, 25])
def test_folded_and_doubled_chains_agree(spark, monkeypatch, folded):
    """Sections above and below the length up to which they are folded."""
    monkeypatch.setattr(issues, "FOLDED", folded)
    rnd = random.Random(folded)
    files = {f: random_lines(rnd, 30 * (f + 1)) for f in range(3)}
    df = spark.createDataFrame([(f, no, t) for f, rows in files.items() for no, t in rows], "file int, line_no long, line string").repartition(5)
    got = issues.issue_tours(df, ["file"]).collect()
    for f, rows in files.items():
        assert sorted((r.first_line, r.size, r["rank"], r.raw) for r in got if r.file == f and r["rank"]) == tours_by_loop(rows)[0]


def test_few_tables_are_written(spark, monkeypatch):
    """A section of 300 tours is not written again for every doubling of its ranks."""
    written = []
    monkeypatch.setattr(issues, "cut_lineage", lambda d: written.append(1) or d.checkpoint())
    rows = [(0, HEADS[1])] + [(k, f"{k} | DIO {k} — Avalon, Hall, Tampa, May 1 1,000 8.00 8,000") for k in range(1, 301)]
    got = issues.issue_tours(spark.createDataFrame(rows, "line_no long, line string"), [])
    assert got.where("rank is not null and reason is null").count() == 300 and len(written) <= 4


@pytest.mark.parametrize("folded", [40, 8192])
def test_long_and_short_files_agree(spark, monkeypatch, folded):
    """Files read as one array and files beyond that: all rows and reasons, with far lines, matter and lines of no file."""
    monkeypatch.setattr(issues, "FOLDED", folded)
    rnd = random.Random(5)
    files = {f: random_lines(rnd, 30 * (f + 1)) for f in range(3)}
    files[3] = [(0, HEADS[0]), (1, "a note under it"), (2, "1 | DIO — Avalon, Hall, Tampa, May 1 1,000 8.00 8,000* AN ADVERT"), (150, "near"), (202, "far off"), (203, HEADS[1]),
                (204, "71 | RATT — Avalon, Hall, Tampa,"), (205, "May 1 1,000 8.00 8,000* more"), (206, END), (207, "2 | RATT — not a tour here")]
    files[4] = [(0, HEADS[0]), (1, "zz of the same place"), (1, "1 | DIO — Avalon, Hall, Tampa,"), (2, "May 1 1,000 8.00 8,000"), (3, "a note"), (3, "2 | RATT — Avalon, Hall"), (4, "no more")]
    none = [(0, HEADS[0]), (1, "1 | DIO — Avalon, Hall, Tampa, May 1 1,000 8.00 8,000")]
    df = spark.createDataFrame([(f, no, t) for f, rows in [*files.items(), (None, none)] for no, t in rows], "file int, line_no long, line string").repartition(5)
    got = issues.issue_tours(df, ["file"]).collect()
    for f, rows in files.items():
        assert f > 2 or sorted((r.first_line, r.size, r["rank"], r.raw) for r in got if r.file == f and r["rank"]) == tours_by_loop(rows)[0]
    assert sorted((r.first_line, r["rank"] or 0, r.raw, r.reason) for r in got if r.file == 3) == [
        (1, 0, "a note under it", "before the first record"), (2, 0, "AN ADVERT near", "behind the last tour"),
        (2, 1, "1 | DIO — Avalon, Hall, Tampa, May 1 1,000 8.00 8,000*", None), (202, 0, "far off", "over 200 lines of a record"),
        (204, 0, "more", "behind the last tour"), (204, 1, "1 | RATT — Avalon, Hall, Tampa, May 1 1,000 8.00 8,000*", None)]
    assert sorted((r.first_line, r["rank"], r.raw) for r in got if r.file == 4) == [
        (1, 1, "1 | DIO — Avalon, Hall, Tampa, 1zz of the same place May 1 1,000 8.00 8,000"), (3, 2, "2 | RATT — Avalon, Hall 2a note no more")]
    assert [(r.first_line, r["rank"], r.reason, r.tour) for r in got if r.file is None] == [(1, None, "before the first record", None)]


def test_lines_are_dealt_out_once(spark):
    """Issues that lie together already are not shuffled or written again, however many steps their tours take."""
    rows = [(f, no, t) for f in range(40) for no, t in random_lines(random.Random(f), 50)]
    df = spark.createDataFrame(rows, "file int, line_no long, line string").repartition(4, "file")
    got = issues.issue_tours(df, ["file"], sizes=df.groupBy("file").count().withColumnRenamed("count", "lines"))
    assert got.where("rank is not null").count() > 40
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
