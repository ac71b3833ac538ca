"""Number words (``two shows``, ``seven sellouts``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import let

# --- fixed values -----------------------------------------------------------
# Single-word English numbers and their value.
NUMBER_WORDS = {
    "zero": 0, "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8,
    "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15,
    "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19, "twenty": 20, "thirty": 30,
    "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90, "hundred": 100,
    "thousand": 1_000, "million": 1_000_000,
}
# Words that multiply what stands before them, and words without a value of their own.
MULTIPLIERS = ["hundred", "thousand", "million"]
FILLERS = ["and", "a", "an"]


def number_word_map() -> Column:
    return F.create_map(*[x for k, v in NUMBER_WORDS.items() for x in (F.lit(k), F.lit(v))])


def number_value(token) -> Column:
    """Value of a number in words or digits, null otherwise.

    Words may be compound (``twenty-five``, ``a hundred and five``, ``two
    thousand three hundred``): parts add up, ``hundred`` multiplies the part
    since the last larger one, ``thousand`` and ``million`` all of it; without
    a number before them they stand for one.  Digits are read as bigint; what
    does not fit is null.
    """
    values = number_word_map()
    big = lambda c: c.cast("bigint")
    state = lambda whole, part: F.struct(big(whole).alias("whole"), big(part).alias("part"))

    def step(acc, w):
        some = F.greatest(acc["part"], big(F.lit(1)))
        return (F.when(w == "hundred", state(acc["whole"], some * 100))
                .when(w.isin("thousand", "million"), state(acc["whole"] + some * values[w], F.lit(0)))
                .otherwise(state(acc["whole"], acc["part"] + values[w])))

    def in_words(parts: Column) -> Column:
        known = (F.size(parts) > 0) & F.forall(parts, lambda w: values[w].isNotNull())
        return F.when(known, F.aggregate(parts, state(F.lit(0), F.lit(0)), step, lambda acc: acc["whole"] + acc["part"]))

    def value(t: Column) -> Column:
        words = let(F.filter(F.split(t, r"[\s-]+"), lambda w: ~w.isin(*FILLERS)), in_words)
        return F.coalesce(big(values[t]), F.when(t.rlike("^[0-9]+$"), t.try_cast("bigint")).otherwise(words))   # most are one word

    return let(F.lower(F.trim(F.col(token) if isinstance(token, str) else token)), value)


def count_kind(metric: Column) -> Column:
    """``sellouts`` or ``shows``, whichever the word is within 3 edits of (sellouts tried first), else null."""
    near = lambda word: F.levenshtein(metric, F.lit(word), 3) >= 0
    return F.when(metric == "shows", "shows").when(near("sellouts"), "sellouts").when(near("shows"), "shows")


def parse_count(number_token, metric_token) -> Column:
    """struct(num_shows, num_sellouts) from ``<number> <metric>``."""
    n = number_value(number_token)
    kind = count_kind(F.col(metric_token) if isinstance(metric_token, str) else metric_token)
    return F.struct(F.when(kind == "shows", n).alias("num_shows"), F.when(kind == "sellouts", n).alias("num_sellouts"))
