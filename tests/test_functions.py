"""Table-driven checks of the column functions (examples from the reference's
own unit and smoke tests, see FIXTURES.md section 2)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import one
from marquee.functions import dates, money, names, places, text

D = dt.date


@pytest.mark.parametrize("cells,expected", [
    (["17,50/15"], [17.5, 15.0]),
    (["17.75/15.25,"], [17.75, 15.25]),
    (["17.50/15.50_"], [17.5, 15.5]),
    (["15/S14"], [15.0, 14.0]),
    (["15 & $12.50"], [15.0, 12.5]),
    (["(15)"], []),
])
def test_price_list(spark, cells, expected):
    assert one(spark, money.curate_prices(F.col("p")), (cells,), "p array<string>") == expected


@pytest.mark.parametrize("raw,expected", [("12,345", 12345), ("8.470", 8470), ("1,234.0", 1234),
                                          ("", None), ("abc", None), (" 17 512 ", 17512)])
def test_ocr_int(spark, raw, expected):
    assert one(spark, money.parse_ocr_int(F.col("s")), (raw,), "s string") == expected


@pytest.mark.parametrize("cells,y,m,start,end", [
    (["Dec. 28-29, 31"], 1985, 1, D(1984, 12, 28), D(1984, 12, 31)),
    (["Dec. 31-", "Jan. 1"], 1989, 2, D(1988, 12, 31), D(1989, 1, 1)),
    (["Feb.25-March 3."], 1985, 3, D(1985, 2, 25), D(1985, 3, 3)),
    (["Sept. 14-", "16, 18-20,", "22-23"], 1988, 10, D(1988, 9, 14), D(1988, 9, 23)),
    (["Nov. 4-5,7-9", "11-12"], 1984, 11, D(1984, 11, 4), D(1984, 11, 12)),
    (["Oct. 7"], 1985, 11, D(1985, 10, 7), D(1985, 10, 7)),
    (["April 3-4"], 1990, 5, D(1990, 4, 3), D(1990, 4, 4)),
    (["Feb. 30"], 1990, 5, None, None),
    (["no date"], 1990, 5, None, None),
])
def test_date_range(spark, cells, y, m, start, end):
    r = one(spark, dates.curate_date(F.col("d"), F.col("y"), F.col("m")), (cells, y, m),
            "d array<string>, y int, m int")
    assert (r["start_date"], r["end_date"]) == (start, end)


def test_year_inference(spark):
    assert one(spark, dates.event_year(F.lit(1985), F.lit(1), F.lit(12)), (1,), "x int") == 1984
    assert one(spark, dates.event_year(F.lit(1985), F.lit(3), F.lit(2)), (1,), "x int") == 1985


@pytest.mark.parametrize("cells,expected", [
    (["Nov. 3 989,704 5,867"], "Nov 3"),
    (["Jan.6"], "Jan 6"),
    (["Sept: 21"], "Sept 21"),
    (["March 23- 3435,694 21,174", "26"], "March 23-26"),
    (["Sept. 28", "Sept. 30 9144.zia 10,894"], "Sept 28 Sept 30"),
    (["Mayer Nov. 30,", "Dec. 1-4"], "Nov 30 Dec 1-4"),
    (["June 14-17}"], "June 14-17"),
    (["Oct. 3-48", "67"], "Oct 3"),
    (["Feb. 10-15, 17-", "22, March 1"], "Feb 10-15 17-22 March 1"),
    (["Auditorium/Charlotte Sept. 12", "101"], "Sept 12"),
    (["Jan. 20-21 8141 22,130"], "Jan 20-21"),
    (["Multt-Purpose"], ""),
    (["Nov, 2"], "Nov 2"),
    (["Nov. 10.00.5"], "Nov"),
    (["Dec. 30-Jan.1"], "Dec 30-Jan 1"),
    (["Jan5-6, 8"], "Jan 5-6 8"),
    ([], ""),
])
def test_date_clean(spark, cells, expected):
    assert one(spark, dates.clean_dates(F.col("d")), (cells,), "d array<string>") == expected


@pytest.mark.parametrize("s,expected", [
    ("That’s Entertainment", "thats-entertainment"), ("RJ's", "rj-s"), ("C&M Prods,", "c-m-prods"),
    ("  Café  Olé ", "cafe-ole"), ("1,000 Clowns", "1000-clowns"), ("--A--B--", "a-b"),
])
def test_slug(spark, s, expected):
    assert one(spark, text.slugify(F.col("s")), (s,), "s string") == expected


@pytest.mark.parametrize("s,expected", [
    ("budweiser superfest", "Budweiser Superfest"), ("world series of rock", "World Series of Rock"),
    ("6th annual o'connor's jam", "6th Annual O'Connor's Jam"),
])
def test_event_title(spark, s, expected):
    assert one(spark, text.event_title(F.col("s")), (s,), "s string") == expected


@pytest.mark.parametrize("cells,in_event,expected", [
    (["AEROSMITH", "JOAN JETT & THE", "BLACKHEARTS,"], False, ["AEROSMITH", "JOAN JETT & THE BLACKHEARTS"]),
    (["HANK WILLIAMS JR.", "BAMA BAND", "MERLE KILGORE"], False, ["HANK WILLIAMS JR", "BAMA BAND", "MERLE KILGORE"]),
    (["RINGO STARR & HIS ALL-", "STARR BAND", "MASON RUFFNER"], False,
     ["RINGO STARR & HIS ALL-STARR BAND", "MASON RUFFNER"]),
    (["CHICAGO/THE BEACH BOYS:"], False, ["CHICAGO", "THE BEACH BOYS"]),
    (["PEABO BRYSON, KOOL &", "THE GANG, RUFUS"], True, ["PEABO BRYSON", "KOOL & THE GANG", "RUFUS"]),
])
def test_merge_split(spark, cells, in_event, expected):
    col = names.split_artist_cells(F.col("a"), F.lit(in_event))
    assert one(spark, col, (cells,), "a array<string>") == expected


def test_candidates(spark):
    r = one(spark, names.artist_candidates(F.col("s")), ("JEFF/BECK",), "s string")
    assert {x["name"] for x in r} == {"JEFF", "BECK", "JEFF BECK", "JEFF/BECK"}
    assert r[0]["name"] == "JEFF/BECK"


@pytest.mark.parametrize("lines,score", [
    (["BUDWEISER SUPERFEST:", "PEABO BRYSON, KOOL &"], 7 + 5 + 2),
    (["AEROSMITH"], 0),
    (["SWATCH WATCH: NEW YORK", "CITY FRESH FESTIVAL"], 7 + 5),
    (["TEXXAS JAM VOL. 2"], 7),
    (["BOB'S LIVE SHOW"], 5 + 2),
])
def test_event_score(spark, lines, score):
    assert one(spark, names.special_event_score(F.col("l")), (lines,), "l array<string>") == score


@pytest.mark.parametrize("lines,name,artists", [
    (["BUDWEISER SUPERFEST:", "PEABO BRYSON, KOOL &", "THE GANG"], "Budweiser Superfest",
     ["PEABO BRYSON, KOOL &", "THE GANG"]),
    (["SWATCH WATCH: NEW YORK", "CITY FRESH FESTIVAL"], "Swatch Watch: New York City Fresh Festival", []),
    (["AEROSMITH", "RATT"], None, ["AEROSMITH", "RATT"]),
])
def test_event_name(spark, lines, name, artists):
    r = one(spark, names.parse_event_name(F.col("l")), (lines,), "l array<string>")
    assert (r["event_name"], r["artists"]) == (name, artists)


def test_location_clean(spark):
    r = one(spark, places.clean_location(F.col("t")), (["The", "Copa", "Toronto,", "Ont.", "Www.copa.com"],),
            "t array<string>")
    assert r == ["The", "Copa", "Toronto", "Ont"]


def test_state_after_venue(spark):
    r = one(spark, places.state_after_venue(F.col("t")),
            (["Giants", "Stadium", "East", "Ruthertord,", "NJ."],), "t array<string>")
    assert r["state_id"] == 30 and r["tokens"] == ["Giants", "Stadium", "East", "Ruthertord,"]


@pytest.mark.parametrize("tokens,sid,rest", [
    (["Providence", "(R.I.)", "Civic", "Center"], 39, ["Providence", "Civic", "Center"]),
    (["Casper", "(Wya.)", "Events", "Center"], -1, ["Casper", "Events", "Center"]),
    (["Ohio", "Center"], 35, ["Ohio", "Center"]),
    (["Civic", "Center"], None, ["Civic", "Center"]),
])
def test_state_in_venue(spark, tokens, sid, rest):
    r = one(spark, places.state_in_venue(F.col("t")), (tokens,), "t array<string>")
    assert (r["state_id"], r["tokens"]) == (sid, rest)


def test_isolate_venue(spark):
    r = one(spark, places.isolate_venue(F.col("t")),
            (["Harttord", "(Conn.)", "Civic", "Center", "&", "Sellout"],), "t array<string>")
    assert " ".join(r) == "Harttord (Conn.) Civic Center"


def test_typos(spark):
    r = one(spark, places.correct_typos(F.col("t")), (["Harttord", "Civic", "Center"],), "t array<string>")
    assert r == ["Hartford", "Civic", "Center"]


def test_ngrams(spark):
    r = one(spark, places.ngrams(F.col("t"), 2), (["a", "b", "c"],), "t array<string>")
    assert [(x["start"], x["len"], x["text"]) for x in r] == [
        (1, 1, "a"), (1, 2, "a b"), (2, 1, "b"), (2, 2, "b c"), (3, 1, "c")]


@pytest.mark.parametrize("word,value", [("twenty-five", 25), ("one hundred", 100), ("One hundred and five", 105), ("7", 7), ("ninety nine", 99),
                                        ("3000000000", 3_000_000_000), ("99999999999999999999", None), ("twenty-foo", None), ("", None), ("and", None)])
def test_number_words(spark, word, value):
    from marquee.functions import numbers
    assert one(spark, numbers.number_value(F.col("s")), (word,), "s string") == value


def test_no_length_limits(spark):
    long = "a" * ((1 << 20) + 5)
    assert one(spark, F.length(text.title_case(F.col("s"))), (long,), "s string") == len(long)


@pytest.mark.parametrize("lines,score", [
    (["WYNF BIRTHDAY PARTY:", "JOE WALSH"], 10),
    (["RICHARD NADER'S VALENTINE'S", "DOO WOPP SHOW", "LITTLE ANTHONY", "FRED PARIS & THE LITTLE", "SATINS", "THE BELMONTS & MARVELETTES"], 7),
    (["ROYAL NEW YORK DOO WOPP", "VOL. 13"], 7),
    (["AGREAT NIGHT FOR THE IRISH: |", "FRANK PATTERSON", "GERALDINE O'GRADY", "DES KEOGH", "NA CASAIEIGH", "EILY O'GRADY, & OTHERS"], 7),
    (["GUITAR GREATS: DAVID", "GILMOUR, DAVE EDMUNDS,", "JOHNNY WINTER, BRIAN SETZER,", "NEAL SCHON, DICKIE BETTS,", "TONY IOMMI, STEVE CROPPER,", "LINK WRAY"], 7),
    (["KENNY ROGERS:", "THE FORESTER SISTERS,"], 7),
    (["VAN HALEN'S MONSTERS OF", "ROCK:", "VAN HALEN", "SCORPIONS", "DOKKEN", "METALLICA", "KINGDOM COME"], 7),
    (["O'JAYS:", "PHYLLIS HYMAN:"], 7),
    (["CHICAGO/THE BEACH BOYS:"], 5),
    (["RONNIE LAWS:", "ROYCE LYTEL", "JOHN AYD :"], 5),
    (["WORLD PARTY", "WIRE TRAIN"], 5),
    (["THE HIGHWAYWEN:", "JOHNNY CASH", "WILLIE NELSON", "WAYLON JENNINGS", "KRIS KRISTOFFERSON"], 5),
    (["CROSBY, STILLS & NASH"], 2),
    (["O'JAYS/LEVERT"], 2),
    (["HUEY LEWIS & THE NEWS", "TOWER OF POWER", "LOS LOBOS", "EDDIE & THE TIDE"], 0),
])
def test_festival_scores(spark, lines, score):
    assert one(spark, names.special_event_score(F.col("l")), (lines,), "l array<string>") == score


def test_every_latin_letter_has_a_slug(spark):
    """All Latin Extended-A and -B letters but tone signs, clicks and the like; names with stroke letters, carons, decomposed marks."""
    import unicodedata
    letters = [chr(c) for c in [*range(0x100, 0x250)] if "LETTER" in unicodedata.name(chr(c), "")]
    rows = spark.createDataFrame([(x,) for x in letters], "t string").select("t", text.slugify("t").alias("s")).collect()
    odd = {r.t for r in rows if not r.s}
    assert all(any(w in unicodedata.name(x) for w in ("TONE", "CLICK", "GLOTTAL", "STOP", "TWO WITH STROKE", "ESH LOOP")) for x in odd), [unicodedata.name(x) for x in odd]
    plain = {r.t: r.s for r in rows}
    assert all(plain[x] == unicodedata.normalize("NFKD", x)[0].lower() for x in letters if len(unicodedata.normalize("NFKD", x)) == 2 and unicodedata.normalize("NFKD", x)[0].isascii())
    names = {"Dvořák": "dvorak", "Łódź": "lodz", "Şebnem": "sebnem", "Straße": "strasse", "Zoe\u0308": "zoe", "Þór Øye": "thor-oye", "İstanbul": "istanbul", "That’s": "thats"}
    got = spark.createDataFrame([(k,) for k in names], "t string").select("t", text.slugify("t").alias("s")).collect()
    assert {r.t: r.s for r in got} == names


@pytest.mark.parametrize("words,value", [
    ("twenty-five", 25), ("one hundred and five", 105), ("a hundred", 100), ("one thousand two hundred", 1200), ("two hundred thousand", 200_000),
    ("a million and one", 1_000_001), ("seven hundred twenty-three thousand four", 723_004), ("12", 12), ("9999999999", 9_999_999_999), ("several", None), ("", None)])
def test_number_words(spark, words, value):
    from marquee.functions.numbers import number_value
    assert one(spark, number_value("t"), (words,), "t string") == value


@pytest.mark.parametrize("tokens,expected", [
    (["Laguna", "Hilts", "Arena"], ["Laguna", "Hills", "Arena"]), (["The", "EAST", "RUTERFORD", "Hall"], ["The", "East", "Rutherford", "Hall"]),
    (["St", "Lous"], ["St", "Louis"]), (["Daltas,"], ["Dallas,"]), (["Lagunas", "Hilts"], ["Lagunas", "Hilts"]), ([], []), (None, None)])
def test_phrases_are_repaired_across_tokens(spark, tokens, expected):
    assert one(spark, places.correct_typos("t"), (tokens,), "t array<string>") == expected


def _slug_in_full(c):
    """Every step of the slug rules on every text."""
    c = F.regexp_replace(c, "'+", "-")
    for k, v in text.ENTITIES.items():
        c = F.replace(c, F.lit(k), F.lit(v))
    c = F.regexp_replace(F.lower(text.ascii_fold(c)), "'+", "")
    c = F.regexp_replace(F.regexp_replace(c, "(?<=[0-9]),(?=[0-9])", ""), "[^-a-z0-9]+", "-")
    return F.regexp_replace(F.regexp_replace(c, "-{2,}", "-"), "^-+|-+$", "")


def test_slug_of_odd_texts_is_the_full_rules(spark):
    import itertools
    odd = ["A", "9", "1,000", " ", "-", "'", "’", "&", "&amp;", "&#39;", ",", "é", "Æ", "ß", "é", "K", "\t\n", ".", "_", "Zİ"]
    rows = [("".join(x),) for k in (1, 2, 3) for x in itertools.product(odd, repeat=k)] + [(None,), ("",)]
    got = spark.createDataFrame(rows, "t string").filter(~text.slugify("t").eqNullSafe(_slug_in_full(F.col("t"))))
    assert got.collect() == []


def test_slug_of_plain_texts_takes_no_transliteration(spark):
    """names in plain ASCII cost a fraction of the full rules, and the slug does not make compiled code too large to optimise."""
    import time
    names = spark.range(400_000).select(F.concat(F.lit("Grand HALL of the North "), F.col("id")).alias("t")).cache()
    names.count()

    def seconds(fn):
        out = []
        for _ in range(2):
            t0 = time.perf_counter()
            names.select(fn(F.col("t"))).write.format("noop").mode("overwrite").save()
            out.append(time.perf_counter() - t0)
        return min(out)

    fast, full = seconds(text.slugify), seconds(_slug_in_full)
    names.unpersist()
    assert fast * 2 < full, (fast, full)
