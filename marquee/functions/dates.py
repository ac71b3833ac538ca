"""Date text cleaning, year inference and date-range parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import let

# --- fixed values -----------------------------------------------------------
# Month words as they appear in the listings, with their month number.
# (The full set: long and short forms of March, April, June, July, Sept.)
MONTHS = {
    "Jan": 1, "Feb": 2, "Mar": 3, "March": 3, "Apr": 4, "April": 4, "May": 5,
    "Jun": 6, "June": 6, "Jul": 7, "July": 7, "Aug": 8, "Sep": 9, "Sept": 9,
    "Oct": 10, "Nov": 11, "Dec": 12,
}
# Months as the listings print them, and misreadings of their abbreviations by text recognition.
PRINTED_MONTHS = ["Jan", "Feb", "March", "April", "May", "June", "July", "Aug", "Sept", "Oct", "Nov", "Dec"]
OCR_MONTHS = ["Jqn", "Feh", "Mar", "Marc", "Marn", "Mavch", "Match", "Apr", "Aprl", "Aor", "Aar", "Augg",
              "Auuq", "Sep", "Seph", "Oet", "Ooet", "Ooct", "Now", "Nno", "Dee", "Deo"]
# June and July: the first letter is read as one of these, the end as one of those.
OCR_JUNE_JULY = ("JdtS", ["ne", "n", "ly", "l", "u"])
# A day of one or two digits, of which some are read as letters.
DAY_SHAPE = r"(?:[0-9][0-9OoIl!]?|[Il!][0-9OoIl!])(?![A-Za-z])"


def any_of(words) -> str:
    """One pattern for many words: told apart by their first character, longer ones first."""
    by: dict[str, list[str]] = {}
    for w in sorted(set(words), key=lambda w: (-len(w), w)):
        by.setdefault(w[0], []).append(w[1:])
    return f"(?=[{''.join(by)}])(?:" + "|".join(f"{c}(?:{'|'.join(rest)})" for c, rest in by.items()) + ")"


# All month words as one pattern.
MONTH_WORDS = any_of([*PRINTED_MONTHS, *OCR_MONTHS, *(f"{a}u{b}" for a in OCR_JUNE_JULY[0] for b in OCR_JUNE_JULY[1])])


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_map() -> Column:
    return F.create_map(*[x for k, v in MONTHS.items() for x in (F.lit(k), F.lit(v))])


# What a date cell is read as, in this order: amounts (dropped whole), month words, other words (dropped),
# days, and the marks that join days.
_AMOUNT = r"\d+(?:[.,]\d{3,})+|\d+(?:\.\d+)+|\d{3,}"
_MONTH = r"(?<![A-Za-z])(?:" + "|".join(sorted(MONTHS, key=len, reverse=True)) + r")(?![a-z])"
_DATE_TOKEN = rf"(?:{_AMOUNT})|(?:{_MONTH})|[A-Za-z]+|\d{{1,2}}|-|(?<=\d),(?=\d)"


def clean_dates(arr) -> Column:
    """list<string> of raw date cells -> one clean date string.

    The cells are read as months, days, ranges and joining commas; all else is
    passed over.  A day counts after a month, within 1..31 and if it is later
    than the day before; ``-`` joins it (also across cells and before the next
    month), ``,`` without a blank does, else a blank.
    """
    tokens = F.regexp_extract_all(F.array_join(_c(arr), "\n"), F.lit(_DATE_TOKEN), 0)
    months = month_map()
    nothing = F.lit(None).cast("int")
    state = lambda text, month, day, join: F.struct(
        text.alias("text"), month.alias("month"), day.alias("day"), join.alias("join"))

    def step(acc, t):
        day = F.when(t.rlike("^[0-9]{1,2}$"), t.cast("int"))
        fits = acc["month"] & day.between(1, 31) & (acc["day"].isNull() | (day > acc["day"]))
        mark = acc["month"] & acc["day"].isNotNull() & t.isin("-", ",")
        first = F.when(acc["text"] == "", t)
        return (F.when(months[t].isNotNull(), state(
                    F.coalesce(first, F.concat(acc["text"], F.when(acc["join"] == "-", "-").otherwise(" "), t)),
                    F.lit(True), nothing, F.lit(" ")))
                .when(mark, state(acc["text"], acc["month"], acc["day"], t))
                .when(fits, state(F.concat(acc["text"], acc["join"], t), acc["month"], day, F.lit(" ")))
                .when(day.isNotNull(), state(acc["text"], acc["month"], acc["day"], F.lit(" ")))
                .otherwise(acc))

    return F.aggregate(tokens, state(F.lit(""), F.lit(False), nothing, F.lit(" ")), step)["text"]


def event_year(issue_year, issue_month, event_month) -> Column:
    """An event month later than the issue month belongs to the previous year."""
    return F.when(_c(event_month) > _c(issue_month), _c(issue_year) - 1).otherwise(_c(issue_year))


def _safe_date(y: Column, m: Column, d: Column) -> Column:
    return F.format_string("%04d-%02d-%02d", y, m, d).try_cast("date")


def month_day_pairs(text) -> Column:
    """Ordered (month, day) pairs in a clean date string: a month word sets the
    current month, every following number is a day of it."""
    parts = F.regexp_extract_all(_c(text), F.lit("([A-Za-z]+|[0-9]+)"), 1)
    months = month_map()
    init = F.struct(F.array().cast("array<struct<m:int,d:int>>").alias("pairs"),
                    F.lit(None).cast("int").alias("m"))

    def step(acc, t):
        mm = months[t]
        is_num = t.rlike("^[0-9]+$")
        return (F.when(mm.isNotNull(), F.struct(acc["pairs"].alias("pairs"), mm.alias("m")))
                .when(is_num & acc["m"].isNotNull(),
                      F.struct(F.array_append(acc["pairs"], F.struct(acc["m"].alias("m"),
                                                                     t.try_cast("int").alias("d")))
                               .alias("pairs"), acc["m"].alias("m")))
                .otherwise(acc))

    return F.aggregate(parts, init, step)["pairs"]


def curate_date(arr, issue_year, issue_month) -> Column:
    """Raw date cells + issue year/month -> struct(start_date, end_date, dates).

    start = first (month, day), end = last; each gets its own inferred year;
    an impossible day gives null dates (never an error).
    """
    def build(text):
        def with_pairs(pairs):
            first, last = F.get(pairs, 0), F.get(pairs, F.size(pairs) - 1)
            start = _safe_date(event_year(issue_year, issue_month, first["m"]), first["m"], first["d"])
            end = _safe_date(event_year(issue_year, issue_month, last["m"]), last["m"], last["d"])
            return let(F.struct(start.alias("s"), end.alias("e")), lambda se: F.struct(
                F.when(se["s"].isNotNull() & se["e"].isNotNull(), se["s"]).alias("start_date"),
                F.when(se["s"].isNotNull() & se["e"].isNotNull(), se["e"]).alias("end_date"),
                F.when(se["s"].isNotNull() & se["e"].isNotNull(), text).alias("dates")))
        return let(month_day_pairs(text), with_pairs)
    return let(clean_dates(arr), build)


def issue_part(path, from_end: int) -> Column:
    """Integer path segment counted from the end (``-3`` = year, ``-2`` = month);
    back-slashes are accepted as separators."""
    parts = F.split(F.replace(_c(path), F.lit("\\"), F.lit("/")), "/")
    return F.element_at(parts, F.size(parts) + 1 + from_end).try_cast("int")
