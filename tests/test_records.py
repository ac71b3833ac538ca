"""Event-record extraction on the reference's example lines (FIXTURES.md)."""

import pytest
from marquee.operators.records import parse_events

CASES = [
    ("CULTURE CLUB Capital Centre Nov. 11 $216,736 13,983 Cellar Door Prods. | DADS Landover, Md, $15.50 (19,114)",
     dict(artists=["CULTURE CLUB", "DADS"], location=["Capital Centre", "Landover, Md,"], dates=["Nov. 11"],
          gross_receipts_us=216736, attendance=13983, promoter=["Cellar Door Prods."], capacity=19114,
          num_shows=None, num_sellouts=None, ticket_prices=["15.50"], gross_receipts_canadian=None)),
    ("u2 San Francisco Cwic Auditorium Dee. 15 $114,780 8.472 Bill Graham Presents | WATERBOYS $15/$13.50 sellout",
     dict(artists=["u2", "WATERBOYS"], location=["San Francisco Cwic Auditorium"], dates=["Dee. 15"],
          gross_receipts_us=114780, attendance=8472, promoter=["Bill Graham Presents"], capacity=None,
          num_sellouts=1, ticket_prices=["15/13.50"])),
    ("GEORGE STRAIT Strahan Coliseum Nov. 3 $46,108 4,062 Ronald & Joy Cotton | Southwest Texas State $12 (8,000) "
     "| University | San Marcos",
     dict(artists=["GEORGE STRAIT"], location=["Strahan Coliseum", "Southwest Texas State", "University", "San Marcos"],
          promoter=["Ronald & Joy Cotton"], capacity=8000, ticket_prices=["12"])),
    ("KENNY ROGERS Reunion Arena Sept. 30 $222,921 13,876 CK, Spurlock | EDDIE RABBITT Dallas $16.50/$13.50 (5,711) "
     "| HELEN REDDY",
     dict(artists=["KENNY ROGERS", "EDDIE RABBITT", "HELEN REDDY"], location=["Reunion Arena", "Dallas"],
          capacity=None, ticket_prices=["16.50/13.50"], promoter=["CK, Spurlock"])),
    ("CYNDI LAUPER Maple Leaf Gardens Nov. 12 $166,353 13,500 Concert Prods. International | BANGLES Toronto "
     "($207,942 Canadian) sellout | $16.50/$15.50",
     dict(artists=["CYNDI LAUPER", "BANGLES"], location=["Maple Leaf Gardens", "Toronto"], num_sellouts=1,
          ticket_prices=["16.50/15.50"], gross_receipts_canadian=207942)),
    ("CULTURE CLUB The Centrum Nov. 20-21 $270017 18,351 Frank J, Russo | SCHEMERS Worcester, Mass. $16/$13.50 "
     "two shows, | one satlout",
     dict(artists=["CULTURE CLUB", "SCHEMERS"], location=["The Centrum", "Worcester, Mass."], dates=["Nov. 20-21"],
          num_shows=2, num_sellouts=1, ticket_prices=["16/13.50"], promoter=["Frank J, Russo"])),
]


CASES += [
    ("RUSH Joel Coliseum Winston-Salem Nov. l5 $86,736 7,983 In House | FASTWAY $15 & $12.50 (9,000) twenty-five shows, two thousand one hundred sellouts",
     dict(artists=["RUSH", "FASTWAY"], location=["Joel Coliseum Winston-Salem"], dates=["Nov. l5"], ticket_prices=["15 & $12.50"], capacity=9000,
          num_shows=25, num_sellouts=2100, attendance=7983)),
    ("DIO March Field Arena duly 4 $86,736 7,983 Feyline | Decatur, Ill. $15 one hundred and five shows | K101 Concerts Inc. | 16, 18-20, | Ooet. 2- | (R.I.) 15.75",
     dict(artists=["DIO"], location=["March Field Arena", "Decatur, Ill.", "(R.I.)"], dates=["duly 4", "16, 18-20,", "Ooet. 2-"],
          promoter=["Feyline", "K101 Concerts Inc."], num_shows=105, unread=["15.75"])),
    ("RATT Arena tune 4-5 $1,736 783 Avalon | Landover a hundred shows ($2,100 Canadian) sellcut | Seven Springs Resort",
     dict(location=["Arena", "Landover", "Seven Springs Resort"], dates=["tune 4-5"], num_shows=100, num_sellouts=1, gross_receipts_canadian=2100)),
]


@pytest.mark.parametrize("line,expected", CASES)
def test_parse_event(spark, line, expected):
    r = parse_events(spark.createDataFrame([(line,)], "s string"), "s").first()["event"].asDict()
    for k, v in expected.items():
        assert r[k] == v, (k, r[k], v)


def test_malformed_is_null(spark):
    df = spark.createDataFrame([("12345 $ 678",)], "s string")
    assert parse_events(df, "s").first()["event"] is None


def test_tour_line(spark):
    from marquee.operators.records import parse_tour_lines
    lines = [("12 | AEROSMITH — Cellar Door, Civic Center, Providence, Oct. 5-6 12,345 $15.50-$17.50 $216,736*",),
             ("3 | BON JOVI — Avalon, Arena, Tampa, Fla. Nov. 2 8,000 $15 $120,000",),
             ("4 | RATT — Avalon, Arena",),
             ("5 | DIO — Avalon, Arena, Oct 12 City, Nov. 2 1 $1 $1",)]
    rows = parse_tour_lines(spark.createDataFrame(lines, "l string"), "l").collect()
    a = rows[0]["tour"]
    assert (a["rank"], a["artist"], a["promoter"], a["venue"], a["city"]) == (
        "12", "AEROSMITH", "Cellar Door", "Civic Center", "Providence")
    assert (a["month_1"], a["first_day"], a["last_day"], a["tickets_sold"]) == ("Oct", 5, 6, 12345)
    assert (a["ticket_price_1"], a["ticket_price_2"], a["gross_receipts"], a["was_sold_out"]) == (
        15.5, 17.5, 216736, True)
    b = rows[1]["tour"]
    assert b["state_abbr"] == "Fla" and b["month_1"] == "Nov" and b["ticket_price_2"] is None
    assert rows[2]["tour"] is None and rows[2]["tour_error"] == "not four comma parts"
    assert rows[3]["tour"] is None and rows[3]["tour_error"] == "digit in city"


def test_tour_line_forms(spark):
    """Sales without dollar signs, bars between columns, two days, three days, a second month, a misread month, shows, sell-outs."""
    from marquee.operators.records import parse_tour_lines
    head = "9 | DIO - Avalon, Arena, Tampa, Fla. "
    cases = {
        "March 25 15,000 8.00 119,760*": ("March", 25, None, 25, 1, 15000, 8.0, None, 119760, True),
        "March 25 & 26 |2| 15,000 | 7.50-8.50 | 119,760 *": ("March", 25, None, 26, 2, 15000, 7.5, 8.5, 119760, True),
        "March 25/26/27 15,000 $8 119,760": ("March", 25, None, 27, 1, 15000, 8.0, None, 119760, False),
        "Marck 30 April 2 1,000 8.00 8,000": ("March", 30, "April", 2, 1, 1000, 8.0, None, 8000, False),
        "May15 1,000 8.00 8,000": ("May", 15, None, 15, 1, 1000, 8.0, None, 8000, False),
        "March 25-28 |4| 1,000 8.00 8,000": ("March", 25, None, 28, 4, 1000, 8.0, None, 8000, False)}
    fields = ["month_1", "first_day", "month_2", "last_day", "num_shows", "tickets_sold", "ticket_price_1", "ticket_price_2", "gross_receipts", "was_sold_out"]
    rows = parse_tour_lines(spark.createDataFrame([(head + c, c) for c in cases], "l string, c string"), "l").collect()
    for r in rows:
        assert r["tour_error"] is None and tuple(r["tour"][f] for f in fields) == cases[r["c"]], r["c"]
    bad = parse_tour_lines(spark.createDataFrame([(head + "Smarch 25 1,000 8.00 8,000",), (head + "March 25 unknown",)], "l string"), "l").collect()
    assert [(r["tour_error"], r["tour"] is None) for r in bad] == [("no dates", True), ("no sales", False)]


def test_page_to_records(spark):
    from marquee.operators.records import SECTION_HEADER, extract_events
    page = "\n".join(["HOT 100", "ARTIST title", SECTION_HEADER, "a stray line", "CULTURE CLUB Capital Centre Nov. 11 $216,736 13,983 Cellar Door Prods.",
                      "DADS Landover, Md, $15.50 (19,114)", "RATT Arena Oet. 3 $1,000 100 in-house", "Copyrighted", "DIO Hall Nov. 1 $1 1 X"])
    got = extract_events(spark.createDataFrame([(1, page), (2, "nothing"), (3, None)], "p int, t string"), ["p"], "t").orderBy("p", "event_no").collect()
    assert [(r.p, r.reason) for r in got] == [(1, None), (1, None), (1, "before the first event"), (2, "no section"), (3, "no section")]
    assert got[0].event.artists[0] == "CULTURE CLUB" and got[0].event.gross_receipts_us == 216736 and got[1].event.artists[0] == "RATT"


FIRST_LINES = ["RATT Arena duly 4 $1,000 100 in-house", "DIO Hall tune 4-5 $12,000 1,000 Avalon", "RUSH Civic Center Ooet. 4 $1,200 900 Feyline",
               "KISS Arena Nov. l5 $114,780 8,472 Bill Graham", "u2 San Francisco Cwic Auditorium Dee. 15 $114,780 8.472 Bill Graham Presents",
               "ABBA The Forum Sul 3 $1,500 90 In-House", "Y&T Hall Sept:21 $1,500 90 X"]
OTHER_LINES = ["DADS Landover, Md, $15.50 (19,114)", "Nov. 4-5 two shows", "| June Carter", "THE MAY QUEENS Decatur $15", "22-23 $12 (8,000)"]


def test_first_lines(spark):
    from marquee.operators.records import NEW_EVENT
    got = spark.createDataFrame([(x,) for x in FIRST_LINES + OTHER_LINES], "l string").selectExpr("l", f"rlike(l, r'{NEW_EVENT}') as first").collect()
    assert {r.l: r.first for r in got} == {**dict.fromkeys(FIRST_LINES, True), **dict.fromkeys(OTHER_LINES, False)}


def test_every_event_gives_a_record_or_a_reason(spark):
    from marquee.operators.records import SECTION_HEADER, extract_events
    page = "\n".join([SECTION_HEADER, *[x for pair in zip(FIRST_LINES, OTHER_LINES + OTHER_LINES) for x in pair]])
    got = extract_events(spark.createDataFrame([(page,)], "t string"), [], "t").collect()
    assert [r.raw.split(" | ")[0] for r in sorted(got, key=lambda r: r.event_no)] == FIRST_LINES and all(r.event for r in got)
    glued = "\n".join([SECTION_HEADER, FIRST_LINES[0], "RUSH Civic Center sometime $12,000 9,000 Feyline", "DIO Hall Nov. 3 $1,200 90 X"])
    got = sorted(extract_events(spark.createDataFrame([(glued,)], "t string"), [], "t").collect(), key=lambda r: r.event_no)
    assert [r.reason for r in got] == ["holds a second event", None] and got[0].event.artists[0] == "RATT"


def test_pages_are_cut_and_marked_as_one_text(spark):
    """F8: no line of a page is looked at by itself; line ends, blanks, symbols and section ends as before."""
    from marquee.operators.records import SECTION_HEADER as head, page_events
    first = "RATT Arena Nov. 3 $1,000 100 in-house"
    cases = {None: ([], [], False), "": ([], [], False), head + " ": ([], [], False), f"x{head}\n{first}": ([], [], False), head: ([], [], True),
             f"{head}\n": ([], [""], True), f"{head}\nCopyrighted": ([], [], True), f"\r\n{head}\r\n  {first} \r\n  b \n\n": ([f"{first} | b |  | "], [], True),
             f"{head}\n\n— a  \n   \n‘{first.replace('$', '§')}\n\x01\n {head}\nCopyrighted\n{first}": ([f"{first} | \x01 | {head}"], ["", "a", ""], True),
             f"{head}\n{first}\n Copyrighted\n{first}\nCopyrighted 1\n{first}": ([f"{first} | Copyrighted", first], [], True),
             f"{head}\nRATT Arena Nov.\n3 $1,000 100 in-house\nRATT Arena Nov. 3 $1,000\n100 X": ([], ["RATT Arena Nov.", "3 $1,000 100 in-house", "RATT Arena Nov. 3 $1,000", "100 X"], True)}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "k int, t string").select("k", page_events("t").alias("p"))
    got = [(r.p.events, r.p.stray, r.p.found) for r in df.orderBy("k").collect()]
    assert got == list(cases.values())
    assert "(?md)^" in df._jdf.queryExecution().optimizedPlan().toString()


def test_lines_without_a_date_are_told_at_once(spark):
    """F8: the time for a line grows with its length, not with its square."""
    import time
    from marquee.operators.records import NEW_EVENT
    long = ["A " * 30000, "A " * 30000 + "Nov. 3 x", "A " * 30000 + "b " * 30000 + "Nov. 3 $1,000 100 x"]
    df = spark.createDataFrame([(x,) for x in long], "l string").coalesce(1)
    start = time.time()
    assert [r.first for r in df.selectExpr(f"rlike(l, r'{NEW_EVENT}') as first").collect()] == [False, False, True]
    assert time.time() - start < 10


def test_event_strings_come_in_even_tasks(spark):
    """F8: tasks by cores and keys, whatever the files' size."""
    from marquee.plans.records_ops import _event_strings
    assert "REPARTITION_BY_NUM" in _event_strings(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()


def test_report_lines_in_the_real_layout(spark):
    from marquee.operators.records import parse_report_lines
    rows = [("reports/1999/worldwide/a.pdf", "1 103.5 THE ROLLING STONES 82.09 12,345 1,260,000 1,013,405 34/56 The Next Adventure"),
            ("reports/1999/worldwide/a.pdf", "3 64.7 BRUCE SPRINGSTEEN 41.20 19,300 795,160 4 56.4 BACKSTREET BOYS 36.80 15,000 552,000"),
            ("reports/1999/worldwide/a.pdf", "Top tours of the year"), ("reports/1999/worldwide/a.pdf", "5 a line that is long enough but has no numbers")]
    names = spark.createDataFrame([("BACKSTREET BOYS",)], "name string")
    got = parse_report_lines(spark.createDataFrame(rows, "path string, l string"), "l", "path", names).orderBy("rank", "reason").collect()
    by = {r.rank: r for r in got if r.reason is None}
    assert set(by) == {"1", "3", "4"} and by["1"].num_cities_shows == "34/56" and by["1"].agency_id == "the-next-adventure" and by["1"].year == "1999"
    assert by["4"].artist_id == "backstreet-boys" and by["4"].avg_revenue_per_show == "552,000" and by["3"].is_musician and not by["4"].is_musician
    assert sorted(r.reason for r in got if r.reason) == ["fits neither layout", "not a report row"]


def test_ranked_tours(spark):
    from marquee.operators.records import ranked_tours
    page = "\n".join(["1 | NOT IN A SECTION — line", "Stadium & Festivals (20,000 & Over)", "text before the first", "1 | AEROSMITH — a tour", "more of it",
                      "12 [ BON JOVI — a tour", "99 | CINDERELLA — not next", "3 | SHORT", "3 | DIO — a long enough line", "Arenas (6,000 To 20,000)", "1 | RATT — begins again here"])
    got = spark.createDataFrame([(page,), (None,)], "t string").select(ranked_tours("t").alias("r")).collect()
    assert [tuple(x) for x in got[0].r] == [
        ("Stadium", 1, "1 | AEROSMITH — a tour more of it"), ("Stadium", 2, "2 [ BON JOVI — a tour 99 | CINDERELLA — not next 3 | SHORT"),
        ("Stadium", 3, "3 | DIO — a long enough line"), ("Arena", 1, "1 | RATT — begins again here")]
    assert got[1].r == []


def test_report_chain(spark):
    """Pages to ranked rows: two layouts, a non-musician left out, ranks closed up, other lines with a reason."""
    from marquee.operators.records import report_table
    page = "\n".join(["Top tours of the year", "1 103.5 THE ROLLING STONES 82.09 12,345 1,260,000 1,013,405 34/56 The Next Adventure",
                      "2 99.1 DISNEY ON ICE 40.11 11,000 1,000,000 900,000 30/300 Feld Entertainment",
                      "3 64.7 BRUCE SPRINGSTEEN 41.20 19,300 795,160 4 56.4 BACKSTREET BOYS 36.80 15,000 552,000"])
    pages = spark.createDataFrame([("reports/1999/worldwide/a.pdf", page), ("reports/2000/worldwide/b.pdf", None)], "path string, t string")
    rows, rejects = report_table(pages, "t", "path", spark.createDataFrame([("DISNEY ON ICE",)], "name string"))
    assert [(r.rank, r.org_rank, r.artist_id, r.year) for r in rows.orderBy("rank").collect()] == [
        (1, 1, "the-rolling-stones", "1999"), (2, 3, "bruce-springsteen", "1999"), (3, 4, "backstreet-boys", "1999")]
    assert [(r.line_no, r.reason) for r in rejects.collect()] == [(0, "not a report row")]


@pytest.mark.parametrize("name", ["q41_tour_lines", "q41_two_layouts"])
def test_compiled_code_is_small_enough_to_be_optimised(spark, name):
    """the JVM leaves methods of more than 8,000 bytes interpreted."""
    import re
    import __spark_entry__ as entry
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # the final plan's code is known before it runs
    try:
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
        code = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000, sizes


def test_groups_are_those_of_a_match_only(spark):
    from pyspark.sql import functions as F
    from marquee.operators.records import _groups
    rows = spark.createDataFrame([("12 a",), ("12 ",), ("x",), ("",), (None,), ("\x011 a",), ("\x01x",), ("1 b\n",)], "t string")
    got = [r.g for r in rows.select(_groups(F.col("t"), r"^(\d+) (\S*)$", 2).alias("g")).collect()]
    assert got == [["12", "a"], ["12", ""], None, None, None, None, None, ["1", "b\n"]]


def test_spellings_are_resolved_once(spark):
    """the distinct spellings are written out, so that names and ids are not worked out again for every event."""
    from pyspark.sql import functions as F
    from marquee.operators import artists
    events = spark.createDataFrame([(1, ["A ONE/B TWO", "C"], False), (2, ["A ONE &", "B TWO", ""], False), (3, None, True)], "k long, a array<string>, e boolean")
    dim = spark.createDataFrame([(7, "b-two")], "id long, slug string")
    out, new = artists.curate_artists(events, "k", "a", "e", dim)
    assert "[_raw" in out._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD", 1)[1]
    rows = {r.k: (r.artist_names, r.artist_ids) for r in out.collect()}
    ids = {r.slug: r.id for r in new.collect()} | {"b-two": 7}
    from marquee.functions import text
    for names, got in rows.values():
        slugs = [r.s for r in spark.createDataFrame([(x,) for x in names], "t string").select(text.slugify("t").alias("s")).collect()] if names else []
        assert got == [ids[s] for s in slugs]
    assert rows[1][0] == ["A ONE", "B TWO"] and rows[3] == ([], [])
