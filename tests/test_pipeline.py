"""End-to-end curation and warehouse load on hand-made processed rows
(example lines of the reference's smoke tests, FIXTURES.md)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marquee.operators import load
from marquee.operators.curate import Dimensions, curate_events

PROCESSED = "file string, row_pos long, issue_year int, issue_month int, artists array<string>, " \
            "location array<string>, dates array<string>, gross_receipts_us string, " \
            "gross_receipts_canadian string, attendance string, capacity string, num_shows string, " \
            "num_sellouts string, promoter array<string>, ticket_prices array<string>, source_id string, " \
            "schema_id string, s3_uri string"

ROWS = [
    ("BB-1984-11-17.csv", 0, 1984, 11, ["CULTURE CLUB", "DADS"], ["Capital Centre", "Landover, Md,"], ["Nov. 11"],
     "216736.0", None, "13983.0", "19114.0", None, None, ["Cellar Door Prods."], ["15.50"], "billboard", "bb_3",
     "s3://b/1"),
    ("BB-1984-11-17.csv", 1, 1984, 11, ["KENNY ROGERS", "EDDIE RABBITT", "HELEN REDDY"], ["Reunion Arena", "Dallas"],
     ["Oct. 30"], "222921.0", None, "13876.0", None, "2.0", "1.0", ["CK Spurlock/In-House"], ["16.50/$13.50"],
     "billboard", "bb_3", "s3://b/1"),
    ("BB-1984-11-24.csv", 0, 1984, 11, ["BUDWEISER SUPERFEST:", "PEABO BRYSON, KOOL &", "THE GANG"],
     ["Giants Stadium", "East Rutherford, N.J."], ["Aug. 3-4"], "1,000,000", None, "60000.0", None, None, None,
     ["Ron Delsener"], ["17,50/15"], "billboard", "bb_3", "s3://b/2"),
    ("BB-1984-11-24.csv", 1, 1984, 11, ["CULTURE CLUB", "DADS"], ["Capital Centre", "Landover, Md,"], ["Nov. 11"],
     "216736.0", None, "-5.0", "19114.0", "1.0", "3.0", ["Cellar Door Prods."], ["15.50"], "billboard", "bb_3",
     "s3://b/2"),
]


@pytest.fixture(scope="module")
def dims(spark):
    return Dimensions(
        artists=spark.createDataFrame([(1, "Culture Club", "culture-club", None), (2, "Kool & The Gang",
                                                                                  "kool-the-gang", None)],
                                      "id int, name string, slug string, parent_id int"),
        venues=spark.createDataFrame([(1, "Reunion Arena", "reunion-arena", 4, 43),
                                      (2, "Capital Centre", "capital-centre", 5, 20)],
                                     "id int, name string, slug string, city_id int, state_id int"),
        cities=spark.createDataFrame([(-1, "Unknown", "unknown", -1), (4, "Dallas", "dallas", 43),
                                      (5, "Landover", "landover", 20), (6, "Springfield", "springfield", 21),
                                      (7, "Springfield", "springfield", 13)],
                                     "id int, name string, slug string, state_id int"),
        promoters=spark.createDataFrame([(1, "Cellar Door Prods.", "cellar-door-prods")],
                                        "id int, name string, slug string"),
        sources=spark.createDataFrame([(1, "Billboard", "billboard", 2)],
                                      "id int, name string, slug string, reliability int"))


@pytest.fixture(scope="module")
def curated(spark, dims):
    corr = spark.createDataFrame(
        [("kenny-rogers-reunion-arena-1984-10-30", "capacity", "15711", 1),
         ("kenny-rogers-reunion-arena-1984-10-30", "capacity", "15712", 2)],
        "event_signature string, field string, true_value string, seq int")
    out, new = curate_events(spark.createDataFrame(ROWS, PROCESSED), dims, corr)
    rows = {(r["file"], r["weekly_rank"]): r.asDict() for r in out.collect()}
    return rows, {k: v.collect() for k, v in new.items()}


def test_first_event(curated):
    rows, new = curated
    r = rows[("BB-1984-11-17.csv", 1)]
    dads = [a["id"] for a in new["artists"] if a["slug"] == "dads"][0]
    assert r["artist_ids"] == [1, dads]
    assert r["venue_id"] == 2
    assert r["start_date"] == dt.date(1984, 11, 11) and r["end_date"] == dt.date(1984, 11, 11)
    assert r["signature"] == "culture-club-capital-centre-1984-11-11"
    assert r["promoters"] == [1]
    assert r["ticket_prices"] == [15.5]
    assert r["gross_receipts_us"] == 216736 and r["attendance"] == 13983 and r["capacity"] == 19114
    assert r["source_id"] == 1


def test_unique_city_and_corrections(curated):
    rows, _ = curated
    r = rows[("BB-1984-11-17.csv", 2)]
    assert r["venue_id"] == 1                       # Dallas is unique -> city 4 -> Reunion Arena
    assert r["start_date"] == dt.date(1984, 10, 30)
    assert r["capacity"] == 15712                   # last correction wins
    assert r["num_shows"] == 2 and r["num_sellouts"] == 1
    assert r["ticket_prices"] == [16.5, 13.5]


def test_festival_new_city_and_venue(curated):
    rows, new = curated
    r = rows[("BB-1984-11-24.csv", 1)]
    assert r["event_name"] == "Budweiser Superfest"
    assert r["artist_ids"][1] == 2                  # KOOL & THE GANG resolved to the existing member
    assert r["signature"] == "budweiser-superfest-giants-stadium-1984-08-03"
    assert r["end_date"] == dt.date(1984, 8, 4)
    city = [c for c in new["cities"] if c["slug"] == "east-rutherford"][0]
    assert city["state_id"] == 30 and city["id"] == 8
    venue = [v for v in new["venues"] if v["slug"] == "giants-stadium"][0]
    assert venue["city_id"] == city["id"] and r["venue_id"] == venue["id"] == 3
    assert r["gross_receipts_us"] == 1000000
    assert r["ticket_prices"] == [17.5, 15.0]


def test_issue_gate(curated):
    rows, _ = curated
    # the second issue has a negative attendance: the column is dropped for that issue
    assert rows[("BB-1984-11-24.csv", 2)]["attendance"] is None
    assert rows[("BB-1984-11-24.csv", 1)]["attendance"] is None
    # sellouts > shows in that issue: sellouts dropped for the issue
    assert rows[("BB-1984-11-24.csv", 2)]["num_sellouts"] is None


def test_new_members_ids_follow_max(curated):
    _, new = curated
    ids = sorted(a["id"] for a in new["artists"])
    assert ids == list(range(3, 3 + len(ids)))
    assert {a["slug"] for a in new["artists"]} >= {"dads", "kenny-rogers", "peabo-bryson"}


def test_load_warehouse(spark, dims):
    out, _ = curate_events(spark.createDataFrame(ROWS, PROCESSED), dims)
    wh = load.load_warehouse(out)
    ev = wh["event"].collect()
    assert len(ev) == 3                            # the repeated signature is loaded once
    assert sorted(e["id"] for e in ev) == [1, 2, 3]
    survivor = [e for e in ev if e["signature"].startswith("culture-club")][0]
    assert survivor["s3_uri"] == "s3://b/1"        # first file wins
    assert wh["event_to_artist"].count() == 2 + 3 + 2
    prices = wh["event_ticket_price"].orderBy("event_id", "ticket_price").collect()
    assert [str(p["ticket_price"]) for p in prices if p["event_id"] == survivor["id"]] == ["15.50"]


def test_load_again_ignores_known_events(spark, dims):
    """Insert or ignore against an event table, special events by name and alias, grown dimensions, full refresh."""
    out, new = curate_events(spark.createDataFrame(ROWS, PROCESSED), dims)
    special = spark.createDataFrame([(4, "superfest")], "id int, slug string")
    alias = spark.createDataFrame([("budweiser-superfest", "superfest")], "alias_slug string, slug string")
    first = load.load_warehouse(out, special_events=special, aliases=alias)
    by = {r.signature: r for r in first["event"].collect()}
    assert {r.special_event_id for s, r in by.items() if s.startswith("budweiser")} == {4}
    assert all(r.special_event_id is None for s, r in by.items() if not s.startswith("budweiser"))
    known = spark.createDataFrame([(7, min(by))], "id long, signature string")
    again = load.load_warehouse(out, existing=known)["event"].collect()
    assert {r.signature for r in again} == set(by) - {min(by)} and sorted(r.id for r in again) == [8, 9]
    more = load.grown(dims, new)
    assert more.artists.count() == dims.artists.count() + new["artists"].count()
    assert curate_events(spark.createDataFrame(ROWS, PROCESSED), more)[1]["artists"].count() == 0


def test_corrections_reach_lists_and_names(spark, dims, tmp_path):
    from marquee.sources.files import read_corrections
    base = spark.createDataFrame(ROWS, PROCESSED)
    sig = curate_events(base, dims)[0].select("raw_signature").orderBy("file", "weekly_rank").first()[0]
    path = tmp_path / "event_corrections_bb_3.csv"
    path.write_bytes(f"event_signature,field,true_value\n{sig},artists,\"['NEW NAME']\"\n{sig},dates,\"['Nov. 12']\"\n{sig},schema_id,caf\u2019\xe9\n".encode("cp1252"))
    out, new = curate_events(base, dims, read_corrections(spark, str(path)))
    r = out.orderBy("file", "weekly_rank").first()
    assert r["start_date"].day == 12 and r["schema_id"] == "caf\u2019\xe9" and "new-name" in {m["slug"] for m in new["artists"].collect()}
