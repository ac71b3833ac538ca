"""Artist names and special-event names (festival detection)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.text import event_title, let

# --- fixed values -----------------------------------------------------------
# Keywords that signal a special event (festival) in the artist lines.
STRONG_EVENT_KEYWORDS = ["festival", "tour", "concert", "series", "fest", "superfest", "benefit"]
WEAK_EVENT_KEYWORDS = ["dance", "party", "live", "show", "shows", "bash"]
TAG_KEYWORDS = ["vol", "vol.", "volume", "annual"]
# Score weights and the threshold at which the lines carry an event name.
SCORE_STRONG, SCORE_TAG, SCORE_WEAK, SCORE_COLON, SCORE_APOSTROPHE, SCORE_COMMA = 7, 7, 5, 5, 2, 2
EVENT_SCORE_THRESHOLD = 7
# Artist slugs rewritten to a canonical artist slug.
ARTIST_CORRECTIONS = {"krokos": "krokus", "others": "various-artists", "visitors": "various-artists"}
# Delimiters that may split one OCR cell into several artist candidates.
CANDIDATE_DELIMITERS = [",", "&", "AND", "THE", "/"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lits(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def any_keyword(text: Column, keywords) -> Column:
    """Substring test against a keyword list (``live`` also hits ``oliver``).
    (``exists``/``contains`` measured faster than one regex alternation.)"""
    return F.exists(_lits(keywords), lambda k: F.contains(text, k))


def clean_artist_name(col, in_event) -> Column:
    """Trim, delete ``._:|{}[]`` and -- outside festivals -- commas."""
    c = F.regexp_replace(F.trim(_c(col)), r"[._:|{}\[\]]", "")
    return F.when(_c(in_event), c).otherwise(F.replace(c, F.lit(","), F.lit("")))


def _overflow(token: Column) -> Column:
    """'space' when a cell ends with ``&`` or the whole word AND/THE, 'none'
    when it ends with ``-`` (word continues), null otherwise."""
    return (F.when(token.endswith("-"), F.lit("none"))
            .when(token.rlike(r"(&|(^|\s)(AND|THE))$"), F.lit("space")))


def merge_artists(arr, in_event) -> Column:
    """Join cells that overflow into the next one (``JOAN JETT & THE`` +
    ``BLACKHEARTS``); the merged cell is not examined again."""
    return let(_c(arr), lambda a: _merge(a, in_event))


def _merge(a: Column, in_event) -> Column:
    idx = F.transform(a, lambda x, i: i)
    init = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("skip"))

    def step(acc, i):
        tok = F.get(a, i)
        nxt = F.get(a, i + 1)
        sig = _overflow(tok)
        merged = F.when(sig == "space", F.trim(F.concat_ws(" ", tok, nxt))).otherwise(F.trim(F.concat(tok, nxt)))
        return (F.when(acc["skip"], F.struct(acc["out"].alias("out"), F.lit(False).alias("skip")))
                .when(sig.isNotNull() & nxt.isNotNull(),
                      F.struct(F.array_append(acc["out"], clean_artist_name(merged, in_event)).alias("out"),
                               F.lit(True).alias("skip")))
                .otherwise(F.struct(F.array_append(acc["out"], clean_artist_name(tok, in_event)).alias("out"),
                                    F.lit(False).alias("skip"))))

    return F.when(F.exists(a, lambda tok: _overflow(tok).isNotNull()), F.aggregate(idx, init, step)["out"]) \
        .otherwise(F.transform(a, lambda tok: clean_artist_name(tok, in_event)))


def separate_artists(arr, in_event) -> Column:
    """Festival lines: join all and split on commas.  Otherwise a ``/`` in a
    cell splits it at the last ``/`` and the right half absorbs the next cell."""
    return let(_c(arr), lambda a: _separate(a, in_event))


def _separate(a: Column, in_event) -> Column:
    festival = F.when(F.exists(a, lambda s: s.contains(",")),
                      F.transform(F.split(F.array_join(a, " "), ","), lambda s: F.trim(s))).otherwise(a)
    idx = F.transform(a, lambda x, i: i)
    init = F.struct(F.array().cast("array<string>").alias("out"), F.lit(False).alias("skip"))
    no_event = F.lit(False)

    def step(acc, i):
        tok = F.get(a, i)
        nxt = F.get(a, i + 1)
        left = F.regexp_extract(tok, "^(.*)/", 1)
        right = F.regexp_extract(tok, "/([^/]*)$", 1)
        has_slash = tok.contains("/")
        with_next = F.array_append(F.array_append(acc["out"], clean_artist_name(left, no_event)),
                                   clean_artist_name(F.concat(right, F.lit("/"), nxt), no_event))
        alone = F.array_append(F.array_append(acc["out"], clean_artist_name(left, no_event)),
                               clean_artist_name(right, no_event))
        return (F.when(acc["skip"], F.struct(acc["out"].alias("out"), F.lit(False).alias("skip")))
                .when(has_slash & nxt.isNotNull(), F.struct(with_next.alias("out"), F.lit(True).alias("skip")))
                .when(has_slash, F.struct(alone.alias("out"), F.lit(False).alias("skip")))
                .otherwise(F.struct(F.array_append(acc["out"], clean_artist_name(tok, no_event)).alias("out"),
                                    F.lit(False).alias("skip"))))

    plain = F.when(F.exists(a, lambda tok: tok.contains("/")), F.aggregate(idx, init, step)["out"]) \
        .otherwise(F.transform(a, lambda tok: clean_artist_name(tok, no_event)))
    return F.when(_c(in_event), festival).otherwise(plain)


def split_artist_cells(arr, in_event) -> Column:
    """merge -> separate: one artist per element."""
    return separate_artists(merge_artists(arr, in_event), in_event)


def artist_candidates(col) -> Column:
    """Candidates with a priority (lower wins): 0 the string itself, then per
    delimiter in order: the string without it, its left part, its right part.
    ``JEFF/BECK`` -> JEFF/BECK, JEFF BECK, JEFF, BECK."""
    s = _c(col)
    out = [F.struct(F.lit(0).alias("prio"), s.alias("name"))]
    for n, d in enumerate(CANDIDATE_DELIMITERS):
        has = s.contains(d)
        without = F.trim(F.regexp_replace(F.replace(s, F.lit(d), F.lit(" " if d == "/" else "")), r"\s+", " "))
        pos = F.locate(d, s)
        left = F.trim(F.substring(s, F.lit(1), pos - 1))
        right = F.trim(F.substr(s, pos + len(d)))
        for k, v in enumerate((without, left, right)):
            out.append(F.when(has, F.struct(F.lit(1 + 3 * n + k).alias("prio"), v.alias("name"))))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def plausible_artist(col) -> Column:
    return F.length(_c(col)) >= 2


def corrections_map() -> Column:
    return F.create_map(*[x for k, v in ARTIST_CORRECTIONS.items() for x in (F.lit(k), F.lit(v))])


# --- special events ----------------------------------------------------------

def special_event_score(lines) -> Column:
    """Festival score of the artist lines (threshold ``EVENT_SCORE_THRESHOLD``).

    +7 strong keyword; +7 tag keyword with a digit from the tag line on; +5
    weak keyword; +5 colon; +2 apostrophe in the candidate name (text before
    the colon, else lines up to the first keyword line, all if there is none); +2 comma.
    """
    a = _c(lines)
    text = F.lower(F.array_join(a, ""))
    low = F.transform(a, lambda l: F.lower(l))
    tag_pos = F.array_position(F.transform(low, lambda l: any_keyword(l, TAG_KEYWORDS)), True)
    # no single line holds the tag (it only spans a line break): the last line
    post_tag = F.array_join(F.when(tag_pos > 0, F.slice(a, F.greatest(tag_pos, F.lit(1)), F.size(a)))
                            .otherwise(F.slice(a, -1, 1)), " ")
    kw_pos = F.array_position(F.transform(low, lambda l: any_keyword(l, STRONG_EVENT_KEYWORDS + WEAK_EVENT_KEYWORDS)),
                              True)
    has_colon = text.contains(":")
    candidate = F.when(has_colon, F.substring_index(text, ":", 1)).otherwise(
        F.array_join(F.slice(a, F.lit(1), F.when(kw_pos > 0, kw_pos).otherwise(F.size(a))), " "))
    score = (F.when(any_keyword(text, STRONG_EVENT_KEYWORDS), SCORE_STRONG).otherwise(0)
             + F.when(any_keyword(text, TAG_KEYWORDS) & post_tag.rlike("[0-9]"), SCORE_TAG).otherwise(0)
             + F.when(any_keyword(text, WEAK_EVENT_KEYWORDS), SCORE_WEAK).otherwise(0)
             + F.when(has_colon, SCORE_COLON).otherwise(0)
             + F.when(candidate.contains("'"), SCORE_APOSTROPHE).otherwise(0)
             + F.when(text.contains(","), SCORE_COMMA).otherwise(0))
    return score.cast("int")


def extract_event_name(lines) -> Column:
    """struct(event_name, artists): the event name runs up to the line that
    completes every signal present (keyword and/or colon); text after the
    colon and the remaining lines are artists."""
    return let(_c(lines), lambda a: let(
        F.struct(F.transform(a, lambda l: F.lower(l)).alias("low"),
                 F.transform(a, lambda l: any_keyword(F.lower(l), STRONG_EVENT_KEYWORDS + WEAK_EVENT_KEYWORDS))
                 .alias("kw"),
                 F.transform(a, lambda l: l.contains(":")).alias("colon")),
        lambda f: _extract(a, f["low"], f["kw"], f["colon"])))


def _extract(a: Column, low: Column, kw: Column, colon: Column) -> Column:
    k = F.array_position(kw, True)      # 1-based, 0 = none
    c = F.array_position(colon, True)
    stops = F.filter(F.transform(a, lambda l, i: F.when(
        (F.get(kw, i) & ((c == 0) | (c <= i + 1)))
        | (~F.get(kw, i) & F.get(colon, i) & ((k == 0) | (k < i + 1))), i + 1)), lambda x: x.isNotNull())
    return let(F.array_min(stops), lambda s: _cut(a, low, s))


def _cut(a: Column, low: Column, s: Column) -> Column:
    """Name parts and artists for the 1-based stop line ``s`` (null = none)."""
    stop_line = F.get(low, s - 1)
    before = F.trim(F.substring_index(stop_line, ":", 1))
    after = F.trim(F.substr(stop_line, F.locate(":", stop_line) + 1))
    stop_has_colon = stop_line.contains(":")
    head = F.slice(low, 1, s - 1)
    name_parts = F.when(s.isNull(), low).otherwise(
        F.array_append(head, F.when(stop_has_colon, before).otherwise(stop_line)))
    rest = F.slice(a, s + 1, F.greatest(F.size(a) - s, F.lit(0)))
    tail = F.when(s.isNull() | (s >= F.size(a)), F.array().cast("array<string>")).otherwise(rest)
    artists = F.when(s.isNull(), F.array().cast("array<string>")).otherwise(
        F.when(stop_has_colon & (after != ""), F.concat(F.array(after), tail)).otherwise(tail))
    return F.struct(event_title(F.array_join(name_parts, " ")).alias("event_name"), artists.alias("artists"))


def parse_event_name(lines) -> Column:
    """Score first; at or above the threshold split off the event name."""
    def build(a):
        return let(F.struct((special_event_score(a) >= EVENT_SCORE_THRESHOLD).alias("hit"),
                            extract_event_name(a).alias("ex")),
                   lambda r: F.struct(F.when(r["hit"], r["ex"]["event_name"]).alias("event_name"),
                                      F.when(r["hit"], r["ex"]["artists"]).otherwise(a).alias("artists")))
    return let(_c(lines), build)


def event_names(df, lines: str, out: str = "parsed"):
    """DataFrame form of ``parse_event_name``: score and split are computed
    once each as their own columns (no sub-expression is evaluated twice)."""
    d = df.withColumn("_score", special_event_score(F.col(lines)))
    d = d.withColumn("_ex", F.when(F.col("_score") >= EVENT_SCORE_THRESHOLD, extract_event_name(F.col(lines))))
    return d.withColumn(out, F.struct(F.col("_ex.event_name").alias("event_name"),
                                      F.coalesce(F.col("_ex.artists"), F.col(lines)).alias("artists"),
                                      F.col("_score").alias("score"))).drop("_score", "_ex")


def _one_edit_pattern(word: str) -> str:
    """Regex alternation of every token within one edit of ``word``
    (substitution, deletion or insertion of one non-space character)."""
    import re as _re
    alts = {_re.escape(word)}
    for i in range(len(word)):
        alts.add(_re.escape(word[:i]) + r"\S" + _re.escape(word[i + 1:]))
        alts.add(_re.escape(word[:i] + word[i + 1:]))
    for i in range(len(word) + 1):
        alts.add(_re.escape(word[:i]) + r"\S" + _re.escape(word[i:]))
    return "(?:" + "|".join(sorted(alts)) + ")"


IN_HOUSE_TOKEN = r"(?i)(?<=^|\s)" + _one_edit_pattern("in-house") + r"(?=\s|$)"


def split_promoters(cells, venue_name) -> Column:
    """Promoter cells -> promoter names.

    Cells are concatenated and split on ``/``; inside each part, tokens with
    a digit or ``$`` are dropped and an ``In-House`` token (one edit allowed)
    stands for the venue's own name.  Without a venue name such a part is
    dropped.  Empty parts vanish.  Per part everything is string-level regex
    work (no per-token lambda).
    """
    joined = F.array_join(_c(cells), "")
    venue = _c(venue_name)
    venue_repl = F.regexp_replace(F.regexp_replace(venue, r"\\", r"\\\\"), r"\$", r"\\\$")

    def part_name(p):
        valid = F.regexp_replace(p, r"\S*[0-9$]\S*", "")
        inhouse = valid.rlike(IN_HOUSE_TOKEN)
        mapped = F.regexp_replace(valid, F.lit(IN_HOUSE_TOKEN), F.coalesce(venue_repl, F.lit("")))
        name = F.trim(F.regexp_replace(mapped, r"\s+", " "))
        dropped = inhouse & (venue.isNull() | (venue == ""))
        return F.when(~dropped, name)

    return F.filter(F.transform(F.split(joined, "/"), part_name), lambda n: n.isNotNull() & (n != ""))
