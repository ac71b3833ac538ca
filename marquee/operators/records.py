"""Text -> record extraction for box-score events.

An event string is the physical lines of one event joined with `` | ``.
The first line has a fixed order (ARTIST venue date $gross attendance
promoter) and is read by one compiled pattern; the lines after it are read by
the grammar of ``marquee.operators.continuation``.  Both are column
expressions: no Python code sees a row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.dates import DAY_SHAPE, MONTH_WORDS, PRINTED_MONTHS
from marquee.functions.text import clean_ocr_line, clean_ocr_lines, let
from marquee.operators import lines
from marquee.operators.continuation import MONTH_DAY, continuation_column


def _num(t: Column) -> Column:
    return F.regexp_replace(t, "[$,]", "").try_cast("double")


# -- first line of an event ----------------------------------------------------
_PIPE = r"\|(?=\s|$)"
_LOC_TOKEN = r"(?!" + _PIPE + r")(?!" + MONTH_DAY + r")[^\s0-9$]+(?=\s|$)"
_DEC_TOKEN = r"\S*[0-9]+\.[0-9]+\S*"
# After the first token of a date: months, days (read as letters in part) and tokens that start with a digit.
_DATE_TOKEN = rf"(?!{_DEC_TOKEN}(?:\s|$))(?:{MONTH_DAY}\S*|{DAY_SHAPE}\S*|(?:{MONTH_WORDS})[.,]?(?=\s)|[0-9]\S*)"
_WORD = r"(?!" + _PIPE + r")\S+"
HEAD_PATTERN = (r"^(\S+(?:\s+" + _LOC_TOKEN + r")*)"
                r"(?:\s+(" + _DEC_TOKEN + r")(?=\s|$)|\s+(" + _WORD + r"(?:\s+" + _DATE_TOKEN + r")*))?"
                r"(?:\s+(" + _WORD + r"))?(?:\s+(" + _WORD + r"))?"
                r"(?:\s+(" + _WORD + r"(?:\s+" + _WORD + r")*))?"
                r"(?:\s+\|(.*))?$")

# A first line: capitals, venue words, one or two dates, numbers, a promoter (a capital or in-house); or, whatever
# stands before it, a date and right after it dollars and an attendance.  Lines without a date are told at once.  Every
# month word has a small letter in one of its first two places, so of the blanks after the capitals the last one alone
# can come before the venue words.  Nothing goes over a line feed: first lines are told within a longer text as well.
_BLANK = r"[ \t\x0B\f\r]"
_EVENT_DATE = rf"(?:{MONTH_WORDS})[.,:]?{_BLANK}?-?{DAY_SHAPE}"
_GROSS = rf"\$[0-9][0-9,.]*{_BLANK}+[0-9][0-9,.]*"
_FIRST_LINE = (rf"(?=.*?{_BLANK}{_EVENT_DATE})"
               rf"(?:.*?{_BLANK}{_EVENT_DATE}[^A-Za-z$\n]*(?:{_EVENT_DATE}[^A-Za-z$\n]*)?{_BLANK}{_GROSS}{_BLANK}"
               rf"|(?>[^a-z\n]*{_BLANK})(?:[^0-9\n]*{_BLANK})?(?:{_EVENT_DATE}[^A-Za-z\n]*){{1,2}}{_BLANK}(?:in-house|[A-Z]))")
NEW_EVENT = f"(?d)^{_FIRST_LINE}"
# Dollars of four digits or more and an attendance: once in a record.
_SECOND_SALES = r"\$[0-9][0-9,.]{3,}\s+[0-9][0-9,.]*\s[\s\S]*\$[0-9][0-9,.]{3,}\s+[0-9][0-9,.]*(?:\s|$)"
SECTION_HEADER = "ARTIST(S) Venue Date(s) Ticket Price(s) Capacity Promoter"
SECTION_END = "Copyrighted"


def page_events(page_text) -> Column:
    """Text of a page -> struct(events array<string>, stray array<string>,
    found boolean): the lines between the section header and the next
    copyright line, cleaned, grouped so that each first line of an event opens
    one (joined with `` | ``); ``stray`` are lines before the first event.

    A page is one text, so this takes no shuffle.  The section is cut, cleaned
    and marked as one string: no line of it is looked at by itself.
    """
    text = F.col(page_text) if isinstance(page_text, str) else page_text
    none = F.array().cast("array<string>")
    head = f"\n{SECTION_HEADER}\n"

    def section(t: Column) -> Column:
        """The lines of the section, a line feed before each; null without a header."""
        after = F.substr(t, F.instr(t, head) + len(head) - 1)
        return F.when(t.contains(head), F.substring_index(after, f"\n{SECTION_END}", 1))

    def grouped(parts: Column) -> Column:
        return F.struct(
            F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), lambda e: F.replace(e, F.lit("\n"), F.lit(" | "))).alias("events"),
            F.when(parts[0] == "", none).otherwise(F.split(F.substr(parts[0], F.lit(2)), "\n")).alias("stray"), F.lit(True).alias("found"))

    def events(s: Column) -> Column:
        """Events begin at a blank after a line feed, which no trimmed line has."""
        marked = F.regexp_replace(clean_ocr_lines(s), f"(?md)^(?={_FIRST_LINE})", " ")
        return F.when(s.isNotNull(), let(F.split(marked, "\n "), grouped)).otherwise(
            F.struct(none.alias("events"), none.alias("stray"), F.lit(False).alias("found")))

    whole = F.concat(F.lit("\n"), F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit(f"\n{SECTION_END}"))
    return let(let(whole, section), events)


def extract_events(pages: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """Page texts -> ``keys``, ``event_no``, ``raw``, ``event`` (the record),
    ``reason``: every event of a page becomes a record or a reason, and so does
    every line before the first one and every page without the section.  A
    record in which gross receipts and attendance come twice has taken in an
    event whose first line cannot be told; it is kept, with the reason."""
    d = pages.select(*keys, page_events(text_col).alias("_p"))
    item = lambda raw, reason: F.struct(raw.alias("raw"), reason.cast("string").alias("reason"))
    items = F.concat(
        F.transform("_p.events", lambda e: item(e, F.lit(None))),
        F.transform("_p.stray", lambda x: item(x, F.lit("before the first event"))),
        F.when(F.col("_p.found"), F.array().cast("array<struct<raw:string,reason:string>>"))
        .otherwise(F.array(item(F.lit(None).cast("string"), F.lit("no section")))))
    rows = d.select(*keys, F.posexplode(items).alias("event_no", "_i")).select(*keys, "event_no", "_i.raw", "_i.reason")
    return with_reasons(rows, "raw").select(*keys, "event_no", "raw", "event", "reason")


def with_reasons(rows: DataFrame, text_col: str) -> DataFrame:
    """Add ``event``, the record of the event string, where ``reason`` is null, and a reason where there is none or
    where the string holds a second event."""
    out = parse_events(rows, text_col).withColumn("event", F.when(F.col("reason").isNull(), F.col("event")))
    two = F.col(text_col).rlike(_SECOND_SALES)
    return out.withColumn("reason", F.coalesce("reason", F.when(F.col("event").isNull(), "no venue").when(two, "holds a second event")))


def parse_events(df: DataFrame, text_col: str, out: str = "event") -> DataFrame:
    """Add ``out`` = struct of processed-event fields parsed from the event
    string (null when no Capitalised venue word is found: a malformed record).

    Staged projections: each intermediate column is computed once (Catalyst
    does not collapse projections that would duplicate expensive work).
    """
    d = df.withColumn("_line", clean_ocr_line(F.col(text_col)))
    # the venue starts at the first word that is Capitalised (upper then
    # lower case); everything before it is the first artist line
    d, m = d.withColumn("_m", F.regexp_instr("_line", F.lit(r"(?:^|\s)[A-Z][a-z]"))), F.col("_m")
    d = d.withColumn("_lc", F.when(m == 0, F.lit(0)).when(F.substring("_line", m, 1) == " ", m + 1).otherwise(m))
    # First line, fixed order, as ONE compiled pattern (evaluated by codegen,
    # no per-token lambdas): location words, then either a decimal token
    # (skipped, no dates) or date tokens, then gross, attendance and the
    # promoter words up to the first '|' token; the rest continues.
    d = d.withColumn("_rest", F.trim(F.substr("_line", F.col("_lc"))))
    # one regex pass: every group written into a \x01-delimited string
    groups = ["loc", "dec", "date", "gross", "att", "prom", "cont"]
    d = d.withColumn("_h", F.split(F.regexp_replace(
        "_rest", HEAD_PATTERN, "\x01".join(f"${i + 1}" for i in range(len(groups)))), "\x01"))
    for i, name in enumerate(groups):
        d = d.withColumn(f"_h_{name}", F.coalesce(F.get("_h", i), F.lit("")))
    has_dec = F.col("_h_dec") != ""
    date_txt = F.col("_h_date")
    dates = F.when(has_dec | (date_txt == ""), F.array().cast("array<string>")).otherwise(F.array(date_txt))
    gtok = F.col("_h_gross")
    d = d.withColumn("_gross", F.when(gtok.startswith("$"), _num(gtok)))
    d = d.withColumn("_att", F.when(F.col("_h_att").rlike(r"^[0-9,.]+$"),
                                    F.regexp_replace("_h_att", "[,.]", "").try_cast("double")))
    promoter = F.when(F.col("_h_prom") != "", F.array(F.col("_h_prom"))).otherwise(F.array().cast("array<string>"))
    first = F.struct(F.array(F.trim(F.substring("_line", F.lit(1), F.col("_lc") - 1))).alias("artists"),
                     F.array(F.col("_h_loc")).alias("location"), dates.alias("dates"), promoter.alias("promoter"))
    d = d.withColumn("_cont", continuation_column(F.col("_h_cont"), F.col("_att")))
    c = F.col("_cont")
    rec = F.struct(*[F.concat(first[f], c[f]).alias(f) for f in ("artists", "location", "dates")],
                   F.col("_gross").alias("gross_receipts_us"), c["canadian"].alias("gross_receipts_canadian"),
                   F.col("_att").alias("attendance"), c["capacity"].alias("capacity"),
                   c["shows"].alias("num_shows"), c["sellouts"].alias("num_sellouts"),
                   F.concat(first["promoter"], c["promoter"]).alias("promoter"), c["prices"].alias("ticket_prices"), c["unread"].alias("unread"))
    # explode of a one-element array is a Generate: a projection barrier, so
    # the optimizer cannot inline the aggregate into every field access
    # downstream (which would re-run the patterns once per field)
    keep = [c for c in df.columns]
    return d.select(*keep, F.explode(F.array(F.when((F.col("_lc") > 0) & (F.col("_h_loc") != ""), rec))).alias(out))


# -- annual report lines -------------------------------------------------------
# rank, gross in millions, artist, then from the first decimal number on: average price, average tickets and
#   total tickets, average gross, cities/shows, agency        (one tour), or
#   average gross, and rank .. average gross of a second tour (two tours side by side).
# Single blanks stand between the words; the artist ends before the first decimal number, so nothing is tried twice.
_TOUR_HEAD = r"(\d+) (\S+) (\S+(?: (?!\d*\.\d+ )\S+)*+) (\d*\.\d+) (\S+)"
_ONE_TOUR = rf"^{_TOUR_HEAD} (\S+) (\S+) (\d+/\d+) (.+)$"
_TWO_TOURS = rf"^{_TOUR_HEAD} (\S+) {_TOUR_HEAD} (\S+)$"
TOUR_FIELDS = ["rank", "revenue", "artist", "avg_ticket_price", "avg_tickets_per_show", "total_tickets_sold",
               "avg_revenue_per_show", "num_cities_shows", "agency"]


def admit_report_line(col) -> Column:
    """Report rows start with a digit and are at least 40 characters."""
    c = F.col(col) if isinstance(col, str) else col
    return c.rlike("^[0-9]") & (F.length(c) >= 40)


def _groups(col: Column, pattern: str, n: int) -> Column:
    """The groups of a pattern of whole texts (``^...$``) as an array, from one pass over the text; null if it does not
    match.  A match begins with a mark, which the pattern itself must not begin with."""
    mark = "\x01"
    marked = F.regexp_replace(col, pattern, "".join(f"{mark}${i}" for i in range(1, n + 1)))
    return let(marked, lambda m: F.when(m.startswith(mark) & ~col.startswith(mark), F.split(F.substr(m, F.lit(2)), mark)))


def parse_report_lines(df: DataFrame, line_col: str, path_col: str, non_musicians: DataFrame | None = None,
                       source: str = "pollstar_dir") -> DataFrame:
    """Report lines in either layout -> the input columns and, per tour, the
    report row (all text): year and scope from ``.../<year>/<scope>/<file>``,
    artist and agency as slugs.  A line that gives no tour stays as one row
    with a ``reason``.  ``is_musician`` is false for an artist whose name is in
    ``non_musicians`` (column ``name``).
    """
    from marquee.functions import text
    d = df.withColumn("_l", text.remove_noisy_symbols(F.col(line_col)))
    d = d.withColumn("_a", F.coalesce(admit_report_line(F.col(line_col)), F.lit(False)))
    d = d.withColumn("_g1", F.when(F.col("_a"), _groups(F.col("_l"), _ONE_TOUR, 9)))
    d = d.withColumn("_g2", F.when(F.col("_a") & F.col("_g1").isNull(), _groups(F.col("_l"), _TWO_TOURS, 12)))

    def tour(group: str, at: list[int | None]) -> Column:
        return F.struct(*[(F.lit(None).cast("string") if k is None else F.get(group, k)).alias(n) for n, k in zip(TOUR_FIELDS, at)])

    one = F.array(tour("_g1", [0, 1, 2, 3, 4, 5, 6, 7, 8]))
    two = F.array(tour("_g2", [0, 1, 2, 3, 4, None, 5, None, None]), tour("_g2", [6, 7, 8, 9, 10, None, 11, None, None]))
    none = F.array(tour("_g1", [None] * 9))
    reason = F.when(~F.col("_a"), "not a report row").when(F.col("_g1").isNull() & F.col("_g2").isNull(), "fits neither layout")
    d = d.withColumn("reason", reason)
    d = d.withColumn("_t", F.explode(F.when(F.col("_g1").isNotNull(), one).when(F.col("_g2").isNotNull(), two).otherwise(none)))
    parts = F.split(F.col(path_col), "/")
    found = F.col("reason").isNull()
    d = d.select(
        *[c for c in df.columns], F.when(found, F.element_at(parts, -3)).alias("year"), F.col("_t.rank").alias("rank"),
        F.col("_t.revenue").alias("revenue"), F.when(found, F.lit("usd")).alias("currency"), F.col("_t.artist").alias("artist"),
        text.slugify("_t.artist").alias("artist_id"), *[F.col(f"_t.{c}").alias(c) for c in TOUR_FIELDS[3:8]],
        text.slugify("_t.agency").alias("agency_id"), F.when(found, F.element_at(parts, -2)).alias("scope"),
        F.when(found, F.lit(source)).alias("source_id"), "reason")
    if non_musicians is None:
        return d.withColumn("is_musician", F.when(F.col("reason").isNull(), F.lit(True)))
    names = non_musicians.select(F.col("name").alias("_nm")).distinct()
    return d.join(names, F.col("artist") == F.col("_nm"), "left") \
        .withColumn("is_musician", F.when(F.col("reason").isNull(), F.col("_nm").isNull())).drop("_nm")


def report_table(pages: DataFrame, text_col: str, path_col: str, non_musicians: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Page texts of annual reports -> (rows, rejects): lines in either layout, non-musicians left out, the others ranked anew
    per file and scope in the order of their printed rank (``org_rank``); every other line with its reason."""
    got = parse_report_lines(lines.explode_lines(pages, [path_col], text_col), "line", path_col, non_musicians)
    rejects = got.filter("reason is not null").select(path_col, "line_no", "line", "reason")
    kept = got.filter(F.col("reason").isNull() & F.col("is_musician")).withColumn("org_rank", F.col("rank").try_cast("long"))
    ranked = lines.rank_in_group(kept.drop("rank"), [path_col], "org_rank", "rank")
    return ranked.drop("line", "line_no", "reason", "is_musician"), rejects


# -- tour lines (older one-line layout) ------------------------------------------
# rank | ARTIST — promoter, venue, city, [State.] Mon. d[-[Mon.] d] sold $p1[-$p2] $gross[*]
_TOUR_STATES = ["Ala.", "Calif.", "D.C.", "Fla.", "Georgia", "Kansas", "La.", "Maine", "Mass.", "Minn.",
                "New Hampshire", "Tenn.", "Va.", "Wisc."]
TOUR_MONTHS = PRINTED_MONTHS
# First day (it may stick to the month), then: & a second day, a/b/c, a range, or a second month with its day;
# then the number of shows between bars, and the sales.
_SECOND = r"(?:([A-Z][a-z]+)\.?\s*)?(\d{1,2})"
_TOUR_DATES = (rf"^([A-Za-z]+)\.?\s*(?:\|\s*)?(\d{{1,2}})(?:\s*&\s*{_SECOND}|/\d{{1,2}}/(\d{{1,2}})|\s*-\s*{_SECOND}"
               r"|,?\s+([A-Z][a-z]+)\.?\s+(\d{1,2}))?(?:,?\s*\|(\d+)\|)?\s+(.*)$")
# Tickets, one or two prices, gross receipts, an asterisk for sold out; bars between columns, dollar signs as they come.
_TOUR_SALES = (r"^\|?\s*([0-9][0-9,.]*)\s+(?:\|\s*)?\$?([0-9]*\.?[0-9]+)(?:\s*-\s*\$?([0-9]*\.?[0-9]+))?\s+(?:\|\s*)?"
               r"\$?([0-9][0-9,.]*)\s*(\*?).*$")


# Section headings of this layout and the venue size that they stand for.
TOUR_SECTIONS = {"Stadium & Festivals (20,000 & Over)": "Stadium", "Arenas (6,000 To 20,000)": "Arena",
                 "Auditoriums (Under 6,000)": "Auditorium"}
# A tour opens with its rank (one stray mark before it is passed over) and a bar or bracket close after it.
RANK_LINE = r"^[^A-Za-z0-9]?([0-9]+)[^0-9]{0,3}?[|\[\](){}]"


def ranked_tours(page_text, sections: dict[str, str] | None = None) -> Column:
    """Page text -> array<struct<section, rank, line>>: the tours of each
    section, in rank order.

    Within a section ranks go on by one from 1.  A line of over 15 characters
    opens the next tour if its number is the next rank, or the next rank with
    one misread digit on either side, which is then put right; every other
    line belongs to the tour before it.  A page is one text: no shuffle.
    """
    heads = F.create_map(*[F.lit(x) for kv in (sections or TOUR_SECTIONS).items() for x in kv])
    mark = lambda section, rank, at: F.struct(section.alias("section"), rank.cast("int").alias("rank"), at.cast("int").alias("at"))
    state = lambda section, rank, marks: F.struct(section.alias("section"), rank.cast("int").alias("rank"), marks.alias("marks"))

    def step(acc, s):
        x, section, expected = s["x"], s["section"], acc["rank"] + 1
        number, want = s["number"], expected.cast("string")
        size = F.length(number)
        fits = (number == want) | (F.substr(number, F.lit(2)) == want) | (F.left(number, size - 1) == want) | (F.substr(number, F.lit(2), size - 2) == want)
        opens = acc["section"].isNotNull() & (number != "") & fits & (F.length(x) > 15)
        noted = lambda sec, rank: F.array_append(acc["marks"], mark(sec, rank, s["i"]))
        return (F.when(section.isNotNull(), state(section, F.lit(0), noted(section, F.lit(0))))
                .when(opens, state(acc["section"], expected, noted(acc["section"], expected)))
                .otherwise(acc))

    def tours(rows: Column) -> Column:
        """The fold notes where headings and tours begin; a tour is the lines up to the next such place."""
        start = state(F.lit(None).cast("string"), F.lit(0), F.array().cast("array<struct<section:string,rank:int,at:int>>"))
        each_line = F.transform(rows, lambda x, i: F.struct(
            x.alias("x"), i.alias("i"), heads[x].alias("section"), F.regexp_extract(x, RANK_LINE, 1).alias("number")))
        marks = F.aggregate(F.filter(each_line, lambda s: s["section"].isNotNull() | (s["number"] != "")), start, step)["marks"]

        def line(m: Column, stop: Column) -> Column:
            first = F.concat(m["rank"].cast("string"), F.regexp_replace(F.get(rows, m["at"]), "^[^A-Za-z0-9]?[0-9]+", ""))
            return F.concat_ws(" ", F.array(first), F.slice(rows, m["at"] + 2, stop - m["at"] - 1))

        each = let(marks, lambda ms: F.transform(ms, lambda m, k: F.struct(
            m["section"].alias("section"), m["rank"].alias("rank"), line(m, F.coalesce(F.get(ms, k + 1)["at"], F.size(rows))).alias("line"))))
        return F.filter(each, lambda t: t["rank"] > 0)

    rows = F.split(F.col(page_text) if isinstance(page_text, str) else page_text, r"\r?\n")
    return let(F.coalesce(rows, F.array().cast("array<string>")), tours)


def nearest_month(word: Column) -> Column:
    """The month itself, else the one month word within one edit, else null."""
    months = F.array(*[F.lit(m) for m in TOUR_MONTHS])
    near = F.filter(months, lambda m: F.levenshtein(m, word) == 1)
    return F.when(F.array_contains(months, word), word).otherwise(F.get(near, 0))


def parse_tour_lines(df: DataFrame, line_col: str, out: str = "tour") -> DataFrame:
    """Tour lines -> struct(rank, artist, promoter, venue, city, state_abbr,
    month_1, first_day, month_2, last_day, tickets_sold, ticket_price_1,
    ticket_price_2, gross_receipts, was_sold_out, num_shows) or null with a reason in
    ``<out>_error`` (no rank, space in rank, no dash, not exactly four comma
    parts, digit or month in the city, no dates).  Dates without readable
    sales give a record without sales fields and the reason "no sales"."""
    from marquee.functions.dates import MONTHS

    ln = F.col(line_col)
    s = F.regexp_replace(ln, r"^[^0-9]*", "")                       # start at the first digit
    s = F.replace(F.translate(s, "[]{}'\"()", "||||||||"), F.lit("~"), F.lit("—"))   # char map, no regex
    d = df.withColumn("_s", s)
    rank = F.trim(F.substring_index("_s", "|", 1))
    rest = F.trim(F.substr(F.col("_s"), F.instr(F.col("_s"), "|") + 1))
    d = d.withColumn("_rank", rank).withColumn("_rest", F.when(F.instr(F.col("_s"), "|") > 0, rest))
    dash = F.when(F.instr("_rest", "—") > 0, F.instr("_rest", "—")).otherwise(F.instr("_rest", "-"))
    d = d.withColumn("_dash", dash)
    d = d.withColumn("_artist", F.trim(F.substring("_rest", F.lit(1), F.col("_dash") - 1)))
    d = d.withColumn("_parts", F.split(F.trim(F.substr(F.col("_rest"), F.col("_dash") + 1)), ",", 4))
    part = lambda i: F.trim(F.replace(F.get("_parts", i), F.lit("|"), F.lit("")))
    d = d.withColumn("_city", part(2)).withColumn("_tail", F.trim(F.get("_parts", 3)))
    first_seg = F.substring_index("_tail", ",", 1)
    has_state = first_seg.rlike("|".join(re.escape(st) for st in _TOUR_STATES))
    d = d.withColumn("_has", has_state)
    d = d.withColumn("_state", F.when(F.col("_has"), F.substring_index("_tail", ".", 1)))
    d = d.withColumn("_dt", F.when(F.col("_has"), F.ltrim(F.substr(F.col("_tail"), F.instr("_tail", " ") + 1)))
                     .otherwise(F.col("_tail")))
    month_in_city = F.col("_city").rlike("|".join(sorted({m[:3] for m in MONTHS})))
    error = (F.when(F.col("_s") == "", "no rank").when(F.col("_rank").contains(" "), "space in rank")
             .when(F.col("_rest").isNull() | (F.col("_dash") == 0), "no dash")
             .when(F.size("_parts") != 4, "not four comma parts")
             .when(F.col("_city").rlike("[0-9]"), "digit in city")
             .when(month_in_city, "month in city"))
    d = d.withColumn(f"{out}_error", error)
    # each pattern matched once; its groups written into a delimited string
    d = d.withColumn("_dg", _groups(F.col("_dt"), _TOUR_DATES, 11))
    d = d.withColumn("_sg", _groups(F.get("_dg", 10), _TOUR_SALES, 5)).withColumn("_month", nearest_month(F.get("_dg", 0)))
    some = lambda *cs: F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])
    digits = lambda c: F.regexp_replace(c, "[^0-9]", "").try_cast("bigint")

    def record(r: Column) -> Column:
        dg, sg = (lambda i: F.get(r["_dg"], i - 1)), (lambda i: F.get(r["_sg"], i - 1))
        name = lambda i: F.trim(F.replace(F.get(r["_parts"], i), F.lit("|"), F.lit("")))
        return let(some(dg(3), dg(6), dg(8)), lambda second: F.struct(
            r["_rank"].alias("rank"), r["_artist"].alias("artist"), name(0).alias("promoter"),
            name(1).alias("venue"), r["_city"].alias("city"), r["_state"].alias("state_abbr"),
            r["_month"].alias("month_1"), dg(2).try_cast("int").alias("first_day"),
            F.when(second != r["_month"], second).alias("month_2"),
            some(dg(4), dg(5), dg(7), dg(9), dg(2)).try_cast("int").alias("last_day"),
            digits(sg(1)).alias("tickets_sold"), sg(2).try_cast("double").alias("ticket_price_1"),
            some(sg(3)).try_cast("double").alias("ticket_price_2"), digits(sg(4)).alias("gross_receipts"),
            (sg(5) == "*").alias("was_sold_out"), F.coalesce(some(dg(10)).try_cast("int"), F.lit(1)).alias("num_shows")))

    # the fields are read in one function: spelt out, they make the compiled code too large for the JVM to optimise
    rec = let(F.struct("_rank", "_artist", "_parts", "_city", "_state", "_month", "_dg", "_sg"), record)
    no_dates = F.col("_dg").isNull() | F.col("_month").isNull()
    d = d.withColumn(f"{out}_error", F.coalesce(F.col(f"{out}_error"), F.when(no_dates, "no dates").when(F.col("_sg").isNull(), "no sales")))
    d = d.withColumn(out, F.when(F.col(f"{out}_error").isNull() | (F.col(f"{out}_error") == "no sales"), rec))
    return d.drop("_s", "_rank", "_rest", "_dash", "_artist", "_parts", "_city", "_tail", "_has", "_state", "_dt", "_dg",
                  "_sg", "_month")
