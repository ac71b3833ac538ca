"""The lines after the first of an event record, read as column expressions.

Everything after the first line is one string of tokens (``|`` stands for a
line break).  Items that can be told by their own shape are taken out first and
leave a mark: counts (a number in words or digits and a word near ``shows`` or
``sellouts``), a single ``sellout``, Canadian gross receipts, capacities and
prices.  What is left is cut by one compiled pattern into stretches, each known
by its first token:

=========  ==========================================================
artists    capitals; goes on over tokens without small letters, digits
dates      a month with a day, or a number; goes on over such tokens
promoter   a word with a digit inside; goes on to the end of the line
location   a word without digits; goes on to a date, digit or line end
unread     any other token (kept, so that nothing goes unseen)
=========  ==========================================================

No token is looked at by Python code; patterns are matched over the whole
string, and only candidates of counts (a few per record) meet an edit distance.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.dates import DAY_SHAPE, MONTH_WORDS, any_of
from marquee.functions.numbers import MULTIPLIERS, NUMBER_WORDS, count_kind, number_value
from marquee.functions.text import let, single_spaces

MARK = "\x03"  # where an item has been taken out
_OPEN, _BAR = "\x05", "\x06"  # before a stretch, and between its possible kinds
_END = r"(?= )"

# -- dates ---------------------------------------------------------------------
# A month is one only before a day, in the same token or the next.
MONTH_DAY = rf"(?:{MONTH_WORDS})[.,:]? ?-?{DAY_SHAPE}"
_NUMBER = rf"(?![^ .]*[0-9]\.[0-9])[0-9][^ ]*+"
_DATE = rf"(?:{MONTH_DAY}[^ ]*+|{_NUMBER})"
_DATES = rf"{_DATE}(?: (?:{_DATE}|&(?= [0-9])))*+"

# -- the other stretches, token by token -------------------------------------------
_ARTISTS = rf"[A-Z:,.]++{_END}(?: [^ |a-z0-9${MARK}]++{_END})*+"
_PROMOTER = rf"[^ 0-9$(|{MARK}][^ 0-9{MARK}]*+[0-9][^ {MARK}]*+(?: (?!\| )[^ {MARK}]++)*+"
LOCATION_WORD = rf"(?!\| |{MONTH_DAY})[^ 0-9{MARK}$]++{_END}"
_LOCATION = rf"{LOCATION_WORD}(?: {LOCATION_WORD})*+"
_STRETCHES = rf" (?:({_ARTISTS})|({_DATES})|({_PROMOTER})|({_LOCATION})|((?!\| )[^ {MARK}]++))"
_FIELDS = ["artists", "dates", "promoter", "location", "unread"]

# -- items with a shape of their own ------------------------------------------------
_WORD_NUMBER = any_of(NUMBER_WORDS)
_WORDS = rf"(?:an? (?={'|'.join(MULTIPLIERS)}))?{_WORD_NUMBER}(?:(?:-| | and ){_WORD_NUMBER})*"
# Digits count only where no other day stands before them; with a month before them they are no number.
_DIGITS = rf"(?:(?:{MONTH_WORDS})[.,:]? )?+(?<![0-9,&.-] )[0-9]++"
_COUNT = rf" (?:(?i:{_WORDS})|{_DIGITS}) [^ |]+{_END}"


def _one_edit(word: str) -> str:
    """Pattern of all texts within one edit of ``word``."""
    at = range(len(word))
    return "|".join([word, *(word[:i] + "[^ ]?" + word[i + 1:] for i in at), *(word[:i] + "[^ ]" + word[i:] for i in range(len(word) + 1))])


_SELLOUT = rf"(?:{_one_edit('sellout')}){_END}"
_CANADIAN = rf"\(\$([0-9,]++) Canadian\)?{_END}"
_CAPACITY = rf"\(([0-9]+,?.?[0-9]+)\)[^ ]*+{_END}"
_PRICE = rf"\$([^ ]+(?: & [^ |]+)?){_END}"
_ITEMS = rf" (?:(?=[($])(?:{_CANADIAN}|{_CAPACITY}|{_PRICE})|(?=[^ ]{{5,8}} )(?=[^ ]*[lout])(?:{_SELLOUT}))"


def _last(values: Column) -> Column:
    return F.get(values, F.size(values) - 1)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "").try_cast("double")


def continuation_column(rest: Column, attendance: Column) -> Column:
    """Tokens after the first line (one string) -> struct(artists, location, dates, prices, promoter, unread: lists;
    canadian, capacity, shows, sellouts: numbers).  A capacity below the attendance is a misreading: none."""
    text = F.concat(F.lit(" "), single_spaces(F.trim(F.coalesce(rest, F.lit("")))), F.lit(" "))
    every = lambda t, pattern: F.regexp_extract_all(t, F.lit(" " + pattern), F.lit(1))

    def split_count(raw: Column) -> Column:
        return F.struct(raw.alias("raw"), count_kind(F.substring_index(raw, " ", -1)).alias("kind"),
                        number_value(F.left(raw, F.length(raw) - F.length(F.substring_index(raw, " ", -1)) - 1)).alias("n"))

    def with_counts(t: Column) -> Column:
        raw = F.regexp_extract_all(t, F.lit(_COUNT), F.lit(0))
        return let(F.struct(t.alias("t"), F.filter(F.transform(raw, split_count), lambda c: c["kind"].isNotNull() & c["n"].isNotNull()).alias("counts")), taken_out)

    def taken_out(s: Column) -> Column:
        marked = F.aggregate(s["counts"], s["t"], lambda acc, c: F.replace(acc, F.concat(c["raw"], F.lit(" ")), F.lit(f" {MARK} ")))
        count = lambda kind: _last(F.filter(s["counts"], lambda c: c["kind"] == kind))["n"].cast("double")
        return let(F.struct(marked.alias("t"), count("shows").alias("shows"), count("sellouts").alias("sellouts")), items)

    def items(s: Column) -> Column:
        t = s["t"]
        capacity = _last(F.filter(F.transform(every(t, _CAPACITY), _digits), lambda c: c.isNotNull() & (attendance.isNull() | (c >= attendance))))
        alone = F.when(t.contains("out") | t.contains("sel") | t.contains("llo"), F.when(t.rlike(f" {_SELLOUT}"), F.lit(1.0)))
        left = F.regexp_replace(t, _ITEMS, f" {MARK}")
        return let(F.struct(
            F.regexp_replace(left, _STRETCHES, _OPEN + _BAR.join(f"${k}" for k in range(1, 6))).alias("t"),
            F.transform(every(t, _PRICE), lambda p: F.regexp_replace(p, r"(?<!& )\$", "")).alias("prices"),
            F.when(t.contains(" Canadian"), _digits(F.get(every(t, _CANADIAN), 0))).alias("canadian"),
            capacity.alias("capacity"), s["shows"].alias("shows"), F.coalesce(s["sellouts"], alone).alias("sellouts")), stretches)

    def stretches(s: Column) -> Column:
        part = lambda k: F.regexp_extract_all(s["t"], F.lit(f"{_OPEN}{_BAR * k}([^{_BAR}{_OPEN}{MARK}| ][^{_BAR}{_OPEN}{MARK}|]*)"), F.lit(1))
        lists = [F.transform(part(k), lambda x: F.rtrim(x)).alias(name) for k, name in enumerate(_FIELDS)]
        return F.struct(*lists, *[s[c].alias(c) for c in ("prices", "canadian", "capacity", "shows", "sellouts")])

    return let(text, with_counts)
