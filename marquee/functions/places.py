"""Location tokens: cleaning, venue-type words, state aliases, typo repair.

These are the per-row parts of location resolution; the parts that consult
the city / venue dimensions are joins in ``marquee.operators.places``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import let, title_case

# --- fixed values -----------------------------------------------------------
# Canonical venue-type word -> spellings seen in the scans (incl. OCR typos).
VENUE_TYPES = {
    "amphitheater": ["amphitheater"], "amphitheatre": ["amphitheatre"],
    "auditorium": ["auditorium", "auditoriurn", "auditorism"], "arena": ["arena"],
    "ballroom": ["ballroom"], "center": ["center"], "centre": ["centre"], "centroplex": ["centroplex"],
    "coliseum": ["coliseum", "colseum", "coltseum", "cohseum"], "college": ["college"], "dome": ["dome"],
    "fair": ["fair", "faur"], "fairgrounds": ["fairgrounds"], "fieldhouse": ["fieldhouse"],
    "gardens": ["gardens"], "grandstand": ["grandstand"], "hall": ["hall", "halt", "kall", "hail", "hat!"],
    "mall": ["mall"], "house": ["house"], "inn": ["inn"], "memorial": ["memorial"], "palace": ["palace"],
    "park": ["park"], "pavilion": ["pavilion"], "silverdome": ["silverdome"],
    "sportatorium": ["sportatorium"], "stadium": ["stadium"], "terrace": ["terrace"],
    "theater": ["theater"], "theatre": ["theatre"],
}
# Canonical city name -> OCR misspellings.
CITY_TYPOS = {
    "buffalo": ["buttato"], "bethlehem": ["bethleham"], "chapel hil!": ["chapel hil!"],
    "charlotte": ["chariotte", "charoltte"], "chattanooga": ["chatanooga"], "dallas": ["daltas", "datlas"],
    "denver": ["oenver"], "east rutherford": ["east ruterford"], "greenville": ["greenvilie"],
    "hartford": ["harttord"], "honolulu": ["honolulu"], "indianapolis": ["indianapotis"],
    "irvine": ["ivine"], "jacksonville": ["jacksonuille"], "lafayette": ["latayette"],
    "laguna hills": ["laguna hilts"],
    "louisville": ["lousulle", "loursville", "lovisville", "loussville", "lousville"],
    "merrillville": ["merrillvitle"], "nashville": ["nashvine"], "omaha": ["omatia"],
    "phoenix": ["phoentx"], "richfield": ["richtield"], "royal oak": ["royal qak"],
    "springfield": ["springheld"], "st louis": ["st lous"], "st paul": ["st paui"],
    "sunrise": ["sunsise"], "tallahassee": ["tatlahassee"], "williamsburg": ["wilhamsburg"],
    "winnipeg": ["winmpeg"],
}
# State / province alias -> state id of the state dimension.
STATE_ALIASES = {
    "ala": 1, "ariz": 3, "ark": 4, "arkansas": 4, "cali": 5, "cal": 5, "catt": 5, "calif": 5, "caltf": 5,
    "colo": 6, "conn": 7, "fla": 9, "fta": 9, "florida": 9, "ga": 10, "hawaii": 11, "idaho": 12,
    "ill": 13, "tll": 13, "ind": 14, "iowa": 15, "kan": 16, "ky": 17, "la": 18, "me": 19, "md": 20,
    "mass": 21, "mich": 22, "minn": 23, "miss": 24, "mo": 25, "mont": 26, "neb": 27, "nev": 28,
    "nj": 30, "nm": 31, "ny": 32, "nc": 33, "ohio": 35, "chic": 35, "okla": 36, "oregon": 37,
    "pa": 38, "ri": 39, "r|": 39, "rl": 39, "sc": 40, "sd": 41, "tenn": 42, "texas": 43, "tex": 43,
    "va": 46, "wash": 47, "wva": 48, "wis": 49, "dc": 51, "alberta": 59, "alta": 59, "ontario": 60,
    "ont": 60, "quebec": 61, "bc": 62,
}
# Words that belong to promoter / sales columns, never to a location.
LOCATION_NOISE = ["productions", "promotions", "presents", "presentations", "prods", "concerts", "inc",
                  "jam", "sellout", "sellouts", "associates", "attractions"]
# Tokens that mark an educational venue.
EDUCATIONAL_TOKENS = ["univ", "unwv", "unv"]
# Bracket characters around a state inside a venue name, e.g. ``(N.C.)``.
STATE_BRACKETS = "(){}"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _map(d: dict) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def venue_type_map() -> Column:
    return _map({alias: canon for canon, aliases in VENUE_TYPES.items() for alias in aliases})


def city_typo_map() -> Column:
    return _map({alias: canon for canon, aliases in CITY_TYPOS.items() for alias in aliases})


def state_alias_map() -> Column:
    return _map(STATE_ALIASES)


def location_tokens(arr) -> Column:
    """list<string> of location cells -> whitespace tokens."""
    return F.filter(F.flatten(F.transform(_c(arr), lambda p: F.split(F.trim(p), r"\s+"))), lambda t: t != "")


def split_hyphen_tokens(arr) -> Column:
    return F.flatten(F.transform(_c(arr), lambda t: F.split(t, "-")))


def clean_location(arr) -> Column:
    """Drop commas/periods, noise words and URL tokens; venue-type spellings
    become their canonical word; everything title-cased."""
    vt = venue_type_map()
    noise = F.array(*[F.lit(w) for w in LOCATION_NOISE])
    stripped = F.transform(_c(arr), lambda t: F.translate(t, ",.", ""))
    kept = F.filter(stripped, lambda t: ~F.array_contains(noise, F.lower(t))
                    & ~F.lower(t).contains("www") & ~F.lower(t).contains("http"))
    return F.transform(kept, lambda t: title_case(F.coalesce(vt[F.lower(t)], t)))


def is_venue_type(token: Column) -> Column:
    return venue_type_map()[F.lower(token)].isNotNull()


def last_venue_type_pos(arr) -> Column:
    """1-based position of the last venue-type word (0 = none)."""
    return F.array_max(F.transform(_c(arr), lambda t, i: F.when(is_venue_type(t), i + 1).otherwise(0)))


def first_venue_type_pos(arr) -> Column:
    """1-based position of the first venue-type word (0 = none)."""
    return F.array_position(F.transform(_c(arr), lambda t: is_venue_type(t)), True)


def state_after_venue(arr) -> Column:
    """struct(state_id, tokens): scanning from the end back to the last
    venue-type word, the last state alias is taken and removed."""
    sm = state_alias_map()

    def with_tokens(a):
        def with_v(v):
            hits = F.transform(a, lambda t, i: F.when(
                (i + 1 > v) & sm[F.regexp_replace(F.lower(t), r"^\.+|\.+$", "")].isNotNull(), i + 1).otherwise(0))
            return let(F.coalesce(F.array_max(hits), F.lit(0)), lambda j: F.struct(
                F.when(j > 0, sm[F.regexp_replace(F.lower(F.get(a, j - 1)), r"^\.+|\.+$", "")]).alias("state_id"),
                F.filter(a, lambda t, i: i + 1 != j).alias("tokens")))
        return let(F.coalesce(last_venue_type_pos(a), F.lit(0)), with_v)
    return let(_c(arr), with_tokens)


def state_in_venue(arr) -> Column:
    """struct(state_id, tokens) for a state written inside the venue name.

    An alias anywhere sets the state (last one wins) but is removed only when
    bracketed, ``Charlotte (N.C.) Coliseum``; a bracketed token before any
    alias that is no known state gives -1 (unknown) and is removed; ``Ohio
    Center`` keeps its token.
    """
    sm = state_alias_map()

    def with_tokens(a):
        flags = F.struct(F.transform(a, lambda t: sm[F.lower(F.translate(t, STATE_BRACKETS + ".", ""))]).alias("hit"),
                         F.transform(a, lambda t: t.rlike(r"[(){}]")).alias("bracket"))

        def with_flags(f):
            hit, bracket = f["hit"], f["bracket"]
            return let(F.array_position(F.transform(hit, lambda h: h.isNotNull()), True), lambda first: F.struct(
                F.when(first > 0, F.get(F.filter(hit, lambda h: h.isNotNull()), -1 + F.size(
                    F.filter(hit, lambda h: h.isNotNull()))))
                .when(F.exists(bracket, lambda b: b), F.lit(-1)).cast("int").alias("state_id"),
                F.filter(a, lambda t, i: ~(F.get(bracket, i) & (F.get(hit, i).isNotNull() | (first == 0)
                                                                 | (i + 1 < first)))).alias("tokens")))
        return let(flags, with_flags)
    return let(_c(arr), with_tokens)


def city_candidate(arr) -> Column:
    """Tokens after the last venue-type word, joined (commas removed); null
    when no venue-type word."""
    return let(_c(arr), lambda a: let(last_venue_type_pos(a), lambda v: F.when(
        v > 0, F.replace(F.array_join(F.slice(a, v + 1, F.greatest(F.size(a) - v, F.lit(0))), " "),
                         F.lit(","), F.lit("")))))


def looks_educational(arr) -> Column:
    return F.arrays_overlap(_c(arr), F.array(*[F.lit(t) for t in EDUCATIONAL_TOKENS]))


def isolate_venue(arr) -> Column:
    """Venue tokens = everything up to the last venue-type word (all tokens
    when there is none)."""
    return let(_c(arr), lambda a: let(last_venue_type_pos(a), lambda v: F.when(v > 0, F.slice(a, 1, v))
                                      .otherwise(a)))


def correct_typos(arr) -> Column:
    """Whole-word replacement of known city misspellings of one or more words (case-insensitive), with the
    canonical spelling title-cased.

    The tokens are joined by blanks, so that a phrase is found across them, and
    split again; texts without any of the spellings are not touched.  Longer
    spellings go first.
    """
    spelt = sorted(((w, r) for r, ws in CITY_TYPOS.items() for w in ws), key=lambda x: -len(x[0]))
    pattern = lambda w: r"(?<![A-Za-z0-9_])" + r"\s".join(re.escape(x) for x in w.split(" ")) + r"(?![A-Za-z0-9_])"

    def fix(t: Column) -> Column:
        fixed = t
        for wrong, right in spelt:
            fixed = F.regexp_replace(fixed, "(?i)" + pattern(wrong), right.title())
        return F.when(t.rlike("(?i)" + "|".join(pattern(w) for w, _ in spelt)), F.split(fixed, " "))

    return let(_c(arr), lambda a: let(F.array_join(a, " "), lambda t: F.coalesce(fix(t), a)))


def ngrams(arr, max_n: int | None = None) -> Column:
    """All contiguous n-grams as struct(start, len, text) (1-based start);
    ``max_n`` caps the window length."""
    a = _c(arr)
    n = F.size(a)
    starts = F.transform(a, lambda t, i: i + 1)
    grams = F.flatten(F.transform(starts, lambda s: F.transform(
        F.filter(F.transform(a, lambda t, j: j + 1), lambda l: (s + l - 1 <= n) & (F.lit(True) if max_n is None else l <= max_n)),
        lambda l: F.struct(s.alias("start"), l.alias("len"), F.array_join(F.slice(a, s, l), " ").alias("text")))))
    return grams
