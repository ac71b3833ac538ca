"""Text normalisation: slugs, title case, token helpers, symbol cleaning."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Typographic quotes are dropped, as a transliterated quote is removed after lower-casing.
TYPOGRAPHIC_QUOTES = "’‘"
# Letters that the Unicode data neither decompose nor name after their base letter, and what they are written as.
OTHER_LETTERS = {
    "SCHWA": "e", "GAMMA": "g", "IOTA": "i", "ESH": "sh", "EZH": "zh", "EZH REVERSED": "zh", "UPSILON": "u", "WYNN": "w",
    "YOGH": "y", "HWAIR": "hv", "ENG": "ng", "ETH": "d", "THORN": "th", "KRA": "q", "SHARP S": "ss", "U BAR": "u", "TURNED DELTA": "d", "LAMBDA": "l",
}
# HTML character entities decoded before slugging.
ENTITIES = {"&amp;": "&", "&quot;": '"', "&lt;": "<", "&gt;": ">", "&#39;": "'"}
# Symbols removed or repaired in OCR lines: the section-sign stands for a
# dollar sign; the left quote and the em dash are noise.
OCR_SYMBOL_FIX = {"§": "$", "‘": "", "—": ""}
# Generic noisy symbols removed from report lines.
NOISY_SYMBOLS = ["=", "~", "‘", "°", "—", "_", "«", "©"]
# Small words kept lower-case inside a title (not at its start).
TITLE_SMALL_WORDS = ["of", "the", "and"]


def latin_letters() -> dict[str, str]:
    """Every Latin letter beyond ASCII up to Latin Extended-B and in Latin Extended Additional -> its ASCII letters.

    From the Unicode data: the letters of the compatibility decomposition, else
    the letter that the name gives (``LATIN SMALL LETTER L WITH STROKE``), else
    OTHER_LETTERS.  Tone signs and clicks have none.
    """
    named = re.compile(r"LATIN (?:CAPITAL |SMALL )?(?:LETTER|LIGATURE) (?:(?:OPEN|REVERSED|TURNED|AFRICAN|DOTLESS|LONG|SMALL|MIDDLE-WELSH) )*"
                       r"([A-Z]{1,2})(?: WITH .+| DIGRAPH)?$")
    out = {}
    for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]):
        name = unicodedata.name(c, "")
        if not name.startswith("LATIN"):
            continue
        letters = "".join(x for x in unicodedata.normalize("NFKD", c) if x.isascii() and x.isalpha())
        if not letters:
            found, word = named.match(name), re.sub(r"^.*(?:LETTER|LIGATURE) | WITH .*$", "", name)
            letters = OTHER_LETTERS.get(word, found.group(1).lower() if found else "")
            letters = letters.upper() if unicodedata.category(c) == "Lu" else letters
        if letters:
            out[c] = letters
    return out


_LETTERS = latin_letters()
_SINGLE = {c: x for c, x in _LETTERS.items() if len(x) == 1}
_SEVERAL = {c: x for c, x in _LETTERS.items() if len(x) > 1}
# Combining marks, left over where a text comes decomposed.
_MARKS = "".join(map(chr, range(0x300, 0x370)))


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` as a lambda variable.

    Higher-order functions run interpreted; an expression referenced inside
    a lambda (or several times in one projection) is otherwise evaluated at
    every reference.  ``transform(array(v), x -> fn(x))[0]`` binds it once.
    """
    return F.get(F.transform(F.array(value), fn), 0)


def ascii_fold(col) -> Column:
    """Transliterate Latin letters to ASCII: one ``translate`` for letters that become one, replacements only in
    texts with a letter that becomes several."""
    def several(c: Column) -> Column:
        longer = c
        for k, v in _SEVERAL.items():
            longer = F.replace(longer, F.lit(k), F.lit(v))
        return F.when(c.rlike("[" + "".join(_SEVERAL) + "]"), longer).otherwise(c)

    return let(F.translate(_c(col), "".join(_SINGLE) + TYPOGRAPHIC_QUOTES + _MARKS, "".join(_SINGLE.values())), several)


def slugify(col) -> Column:
    """Lower-case, ASCII, dash-separated slug.

    Straight apostrophes split words (``RJ's`` -> ``rj-s``), typographic ones
    vanish (``That’s`` -> ``thats``), thousands separators between digits are
    dropped, every other run of non ``[a-z0-9]`` becomes one dash and the slug
    is trimmed of dashes.  ASCII texts are not transliterated, and those
    without ``&``, ``'`` and ``,`` need the dashes alone.
    """
    dashed = lambda x: F.btrim(F.regexp_replace(x, "[^a-z0-9]+", "-"), F.lit("-"))

    def other(t: Column) -> Column:
        c = F.regexp_replace(t, "'+", "-")
        for k, v in ENTITIES.items():
            c = F.replace(c, F.lit(k), F.lit(v))
        c = F.lower(F.when(t.rlike(r"[^\x00-\x7F]"), ascii_fold(c)).otherwise(c))
        c = F.regexp_replace(c, "'+", "")
        return dashed(F.regexp_replace(c, "(?<=[0-9]),(?=[0-9])", ""))

    t = _c(col)   # the longer way is kept out of the compiled code, which it would make too large for the JVM to optimise
    return F.when(t.rlike(r"[^\x00-\x7F]|[&',]"), let(t, other)).otherwise(dashed(F.lower(t)))


def slugify_underscore(col) -> Column:
    """Underscore variant used by the reference tables (``live_nation``)."""
    return F.replace(slugify(col), F.lit("-"), F.lit("_"))


def title_case(col) -> Column:
    """Word-wise title case where any non-letter starts a new word.

    ``o'connor`` -> ``O'Connor``; ``6th`` -> ``6Th`` (fixed by ``fix_title``).
    """
    pieces = F.regexp_extract_all(F.lower(_c(col)), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))),
        "")


def fix_title(col) -> Column:
    """Ordinals back to lower case (``6Th`` -> ``6th``), ``'S`` -> ``'s`` and
    the small words of/the/and lower-case after the first word."""
    c = _c(col)
    for suffix in ("St", "Nd", "Rd", "Th"):
        c = F.regexp_replace(c, rf"\b([0-9]+){suffix}\b", rf"$1{suffix.lower()}")
    c = F.regexp_replace(c, r"(['’])S\b", "$1s")
    for w in TITLE_SMALL_WORDS:
        c = F.regexp_replace(c, rf"(?<=\s){w.title()}\b", w)
    return c


def event_title(col) -> Column:
    """Title case used for special-event names."""
    return fix_title(title_case(col))


def single_spaces(col) -> Column:
    """Every run of whitespace -> one blank; runs that are one are left as they are."""
    return F.regexp_replace(_c(col), r"\s{2,}|[\t-\r]", " ")


def squeeze_spaces(col) -> Column:
    return F.trim(single_spaces(col))


def clean_ocr_line(col) -> Column:
    """Symbol repair of an OCR line: section sign -> ``$``; drop stray quote
    and em dash; trim."""
    c = fixed = _c(col)
    for k, v in OCR_SYMBOL_FIX.items():
        fixed = F.replace(fixed, F.lit(k), F.lit(v))
    return F.trim(F.when(c.rlike(f"[{''.join(OCR_SYMBOL_FIX)}]"), fixed).otherwise(c))


def clean_ocr_lines(col) -> Column:
    """``clean_ocr_line`` for every line of a text in one go."""
    before = lambda c: F.when(c.contains("\n "), F.regexp_replace(c, "\n +", "\n")).otherwise(c)
    after = lambda c: F.when(c.contains(" \n"), F.regexp_replace(c, "(?<! ) ++\n", "\n")).otherwise(c)
    return let(let(clean_ocr_line(col), before), after)


def remove_noisy_symbols(col) -> Column:
    """Drop the generic noisy symbols and squeeze whitespace."""
    c, noisy = _c(col), "".join(NOISY_SYMBOLS)
    return squeeze_spaces(F.when(c.rlike(f"[{noisy}]"), F.translate(c, noisy, "")).otherwise(c))


def tokens(col) -> Column:
    """Whitespace tokenisation with empty tokens removed."""
    return F.filter(F.split(F.trim(_c(col)), r"\s+"), lambda t: t != "")


def split_hyphens(arr) -> Column:
    """Split every token on ``-`` (empty parts are kept, as str.split does)."""
    return F.flatten(F.transform(_c(arr), lambda t: F.split(t, "-")))


def py_list_text_to_array(col, element_type: str = "string") -> Column:
    """Parse a Python-repr list literal (``['A', 'B']``, ``[1, 2]``) into an array.

    ``None`` elements become nulls; ``\\xNN`` escapes are turned into JSON
    ``\\u00NN`` escapes so the JSON reader accepts them.
    """
    c = F.regexp_replace(_c(col), r"(?<=[\[,\s])None(?=[,\]])", "null")
    c = F.regexp_replace(c, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    return F.from_json(c, f"array<{element_type}>", {"allowSingleQuotes": "true"})
