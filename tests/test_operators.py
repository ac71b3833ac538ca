"""DataFrame operators: conforming, ordered lines, gates, load, listing, sources."""

import datetime as dt

from pyspark.sql import functions as F

from marquee.functions import text
from marquee.operators import conform, lines, load, quality
from marquee.operators.corrections import apply_corrections
from marquee.sources import files


def test_dense_ids_global_order(spark):
    df = spark.createDataFrame([(f"s{i:04d}",) for i in range(500)][::-1], "slug string")
    out = conform.dense_ids(df, "slug", 100, partitions=7).collect()
    got = sorted((r["slug"], r["id"]) for r in out)
    assert got == [(f"s{i:04d}", 101 + i) for i in range(500)]


def test_add_members_anti_join(spark):
    dim = spark.createDataFrame([(5, "Aerosmith", "aerosmith")], "id int, name string, slug string")
    names = spark.createDataFrame([("AEROSMITH",), ("Ratt",), ("RATT",), ("Dio",)], "n string")
    new = conform.add_members(dim, names, "n", text.slugify).orderBy("id").collect()
    assert [(r["slug"], r["id"]) for r in new] == [("dio", 6), ("ratt", 7)]
    assert [r["name"] for r in new] == ["Dio", "RATT"]


def test_unique_and_fuzzy(spark):
    cities = spark.createDataFrame([(1, "springfield", 21), (2, "springfield", 13), (3, "honolulu", 11)],
                                   "id int, slug string, state_id int")
    q = spark.createDataFrame([("springfield",), ("honolulu",)], "slug string")
    r = {x["slug"]: x["match_id"] for x in conform.resolve_unique(q, "slug", cities, "slug").collect()}
    assert r == {"springfield": None, "honolulu": 3}
    probe = spark.createDataFrame([(1, "springheld", 21), (2, "springheld", 11)], "k int, t string, st int")
    fz = conform.fuzzy_candidates(probe, "t", ["st"], cities, "slug", ["state_id"], keep=["id"]).collect()
    assert [(x["k"], x["id"], x["_dist"]) for x in fz] == [(1, 1, 2)]


def test_ids_in_order_reports_missing(spark):
    dim = spark.createDataFrame([(1, "a", "a"), (2, "b", "b")], "id int, name string, slug string")
    ev = spark.createDataFrame([(1, ["B", "zz", "A"])], "k int, names array<string>")
    r = conform.ids_in_order(ev, "k", "names", dim, text.slugify).first()
    assert r["ids"] == [2, 1] and r["ids_missing"] == ["zz"]


def test_group_lines_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(lines, "CHUNK", 4)
    rows = [("f", i, f"L{i}", i in (0, 3, 9)) for i in range(12)] + [("g", i, f"M{i}", i == 2) for i in range(3)]
    df = spark.createDataFrame(rows, "file string, line_no long, line string, start boolean")
    g = lines.group_lines(df, ["file"], "line_no", "line", F.col("start")).collect()
    got = sorted((r["file"], r["group_no"], r["text"]) for r in g)
    assert got == [("f", 1, "L0 | L1 | L2"), ("f", 2, "L3 | L4 | L5 | L6 | L7 | L8"), ("f", 3, "L9 | L10 | L11"),
                   ("g", 0, "M0 | M1"), ("g", 1, "M2")]


def test_forward_fill_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(lines, "CHUNK", 3)
    hdr = {0: "Stadium", 7: "Arena"}
    df = spark.createDataFrame([("p", i, hdr.get(i)) for i in range(10)], "page string, n long, h string")
    r = {x["n"]: x["section"] for x in lines.forward_fill(df, ["page"], "n", "h", "section").collect()}
    assert [r[i] for i in range(10)] == ["Stadium"] * 7 + ["Arena"] * 3


def test_section_slice_and_cut(spark):
    ls = ["junk", "ARTIST(S) Venue Date(s)", "A 1", "B 2 * note", "Copyrighted material", "C 3"]
    df = spark.createDataFrame([("f", i, l) for i, l in enumerate(ls)], "file string, line_no long, line string")
    sec = lines.slice_section(df, ["file"], "line_no", F.col("line").startswith("ARTIST(S)"),
                              F.col("line").startswith("Copyrighted"))
    cut = lines.cut_last_at(sec, ["file"], "line_no", "line", "*")
    assert [r["line"] for r in cut.orderBy("line_no").collect()] == ["A 1", "B 2 "]


def test_rank_in_group(spark, monkeypatch):
    monkeypatch.setattr(lines, "CHUNK", 2)
    df = spark.createDataFrame([("i", k) for k in [5, 1, 9, 3, 7]], "issue string, pos long")
    r = {x["pos"]: x["rank"] for x in lines.rank_in_group(df, ["issue"], "pos").collect()}
    assert r == {1: 1, 3: 2, 5: 3, 7: 4, 9: 5}


def test_gates(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 1.0), ("a", -1.0, 2.0, 3.0), ("b", 5.0, 2.0, 2.0)],
                               "f string, g double, shows double, sell double")
    g = {(r["f"], r["shows"], r["sell"]): r["g"] for r in quality.column_gate(df, ["f"], ["g"]).collect()}
    assert g[("a", 2.0, 1.0)] is None and g[("b", 2.0, 2.0)] == 5.0
    s = quality.sellout_gate(df, ["f"], "shows", "sell").collect()
    assert {(r["f"], r["sell"]) for r in s} == {("a", None), ("b", 2.0)}


def test_corrections_last_wins_and_typed(spark):
    ev = spark.createDataFrame([("sig1", 10, 5), ("sig2", 20, 6)], "signature string, attendance int, capacity int")
    corr = spark.createDataFrame([("sig1", "attendance", "11", 1), ("sig1", "attendance", "12", 2),
                                  ("sig1", "capacity", "n/a", 1), ("sig3", "attendance", "1", 1)],
                                 "event_signature string, field string, true_value string, seq int")
    out = {r["signature"]: r for r in apply_corrections(ev, corr, fields={"attendance": "int",
                                                                          "capacity": "int"}).collect()}
    assert (out["sig1"]["attendance"], out["sig1"]["capacity"]) == (12, 5)
    assert (out["sig2"]["attendance"], out["sig2"]["capacity"]) == (20, 6)


def test_dedupe_and_bridge(spark):
    df = spark.createDataFrame([("s", "f2", 1, [1, 2]), ("s", "f1", 3, [2]), ("t", "f1", 1, [])],
                               "signature string, file string, weekly_rank int, ids array<int>")
    d = load.dedupe_by_key(df, "signature", ["file", "weekly_rank"], count_col="n").collect()
    assert {(r["signature"], r["file"], r["n"]) for r in d} == {("s", "f1", 2), ("t", "f1", 1)}
    b = load.bridge(df, "signature", "ids", "artist_id").collect()
    assert {(r["signature"], r["artist_id"]) for r in b} == {("s", 1), ("s", 2)}


def test_event_listing(spark):
    event = spark.createDataFrame(
        [(1, "Fest", 7, dt.date(1985, 1, 2), dt.date(1985, 1, 3), 100, 10),
         (2, None, 7, dt.date(1984, 12, 1), dt.date(1984, 12, 1), 50, 5),
         (3, None, 8, dt.date(1984, 11, 1), dt.date(1984, 11, 1), 70, 7)],
        "id int, event_name string, venue_id int, start_date date, end_date date, gross_receipts_us int, "
        "attendance int")
    venue = spark.createDataFrame([(7, "Forum")], "id int, name string")
    artist = spark.createDataFrame([(1, "B"), (2, "A")], "id int, name string")
    eta = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 1)], "event_id int, artist_id int")
    etp = spark.createDataFrame([(1, 15.5), (1, 12.0), (2, 9.0)], "event_id int, ticket_price double")
    etp = etp.withColumn("ticket_price", F.col("ticket_price").cast("decimal(8,2)"))
    rows = load.event_listing(event, venue, artist, eta, etp).collect()
    assert [r["event_id"] for r in rows] == [2, 1]            # event 3: no venue -> dropped; by start date
    assert rows[1]["artists"] == "A, B" and rows[1]["ticket_prices"] == "12.00, 15.50"
    assert rows[1]["start_date"] == "01/02/1985"


def test_issue_csv_scan(spark, tmp_path):
    d = tmp_path / "processed" / "billboard" / "1984" / "11"
    d.mkdir(parents=True)
    (d / "BB-1984-11-03.csv").write_text(
        "artists,dates,gross_receipts_us,gross_receipts_canadian,tickets_sold,capacity,num_shows,num_sellouts,"
        "promoter,ticket_prices,location,source_id,schema_id,s3_uri\n"
        "\"['ALABAMA', 'JUICE NEWTON']\",\"['Sept. 17-', '18']\",271436.0,,17512.0,,,,\"['Salem Concerts']\","
        "\"['15 & $12.50']\",\"['Reunion Arena', 'Dallas']\",billboard,bb_3,s3://x\n", encoding="utf-8")
    r = files.read_issue_csvs(spark, str(tmp_path / "processed")).first()
    assert r["artists"] == ["ALABAMA", "JUICE NEWTON"] and r["attendance"] == "17512.0"
    assert (r["issue_year"], r["issue_month"], r["file"]) == (1984, 11, r["path"]) and r["file"].endswith("/1984/11/BB-1984-11-03.csv")


def test_ragged_rows_and_py_lists(spark):
    df = spark.createDataFrame([("a,,b, ,c",)], "value string")
    assert files.compact_ragged(df).first()["value"] == "a,b,c"
    lit = spark.createDataFrame([("['A', None, 'B\\x27s']",)], "s string")
    assert lit.select(text.py_list_text_to_array(F.col("s")).alias("a")).first()["a"] == ["A", None, "B's"]


def test_latin1_read(spark, tmp_path):
    p = tmp_path / "dim.csv"
    p.write_bytes("id,name,slug,state_id\n1,Montr\xe9al,montreal,61\n".encode("latin-1"))
    r = spark.read.option("header", True).option("encoding", "ISO-8859-1").schema(
        files.DIMENSION_SCHEMAS["city"]).csv(str(p)).first()
    assert r["name"] == "Montréal"


def test_rows_that_do_not_fit_are_kept_apart(spark, tmp_path):
    d = tmp_path / "processed" / "1984" / "11"
    d.mkdir(parents=True)
    good = "\"['RATT']\",\"['Nov. 12']\",1000.0,,100.0,,,,\"['X']\",\"['10']\",\"['Hall']\",billboard,bb_3,s3://y"
    (d / "a.csv").write_text(",".join(f"c{k}" for k in range(14)) + "\n" + good + "\n" + "['SHORT'],1\n" + good + ",more,cells\n")
    assert files.read_issue_csvs(spark, str(tmp_path)).count() == 1
    assert files.read_issue_csvs(spark, str(tmp_path)).select("artists").count() == 1
    bad = files.read_issue_rejects(spark, str(tmp_path)).collect()
    assert len(bad) == 2 and {r.reason for r in bad} == {"wrong number of cells"} and any("SHORT" in r.record for r in bad)


def test_venues_are_kept_per_city(spark):
    from marquee.operators.places import curate_locations
    cities = spark.createDataFrame([(1, "Providence", "providence", 39), (2, "Des Moines", "des-moines", 15), (3, "Dallas", "dallas", 43)],
                                   "id int, name string, slug string, state_id int")
    venues = spark.createDataFrame([(7, "Civic Center", "civic-center", 1, 39)], "id int, name string, slug string, city_id int, state_id int")
    ev = spark.createDataFrame([("a", ["Civic", "Center", "Des", "Moines"]), ("b", ["Memorial", "Coliseum", "Des", "Moines"]),
                                ("c", ["Memorial", "Coliseum", "Dallas"]), ("d", ["Civic", "Center", "Providence"]), ("e", ["Memorial", "Coliseum", "Dallas"])],
                               "k string, location array<string>")
    out, _, new = curate_locations(ev, "k", "location", cities, venues)
    got = {r.k: (r.venue_id, r.city_id) for r in out.collect()}
    assert got["d"] == (7, 1) and all(v is not None for v, _ in got.values())
    assert len({got[k] for k in "abcd"}) == 4 and got["c"] == got["e"]
    assert {(r.slug, r.city_id) for r in new.collect()} == {("civic-center", 2), ("memorial-coliseum", 2), ("memorial-coliseum", 3)}


def test_issues_of_one_file_name_stay_apart(spark):
    from marquee.operators import quality
    df = spark.createDataFrame([("1984/10/issue.csv", -1.0), ("1984/10/issue.csv", 2.0), ("1984/11/issue.csv", 3.0)], "file string, v double")
    got = {(r.file, r["_ok_v"]) for r in quality.gate_flags(df, ["file"], ["v"]).collect()}
    assert got == {("1984/10/issue.csv", False), ("1984/11/issue.csv", True)}


def test_fuzzy_pairs_are_complete(spark):
    """Segment keys against the edit distance of all pairs, for one to three edits, short and empty texts included."""
    import random
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(0, 9)))
    rows = [(k, word(), rng.randint(0, 1)) for k in range(120)]
    mem = [(k, word(), rng.randint(0, 1)) for k in range(120)]
    df = spark.createDataFrame(rows + [(900, None, 0)], "r int, t string, b int")
    dim = spark.createDataFrame(mem, "id int, name string, bb int")

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            prev, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
        return row[-1]

    for k in (1, 2, 3):
        got = sorted((r.r, r.id, r["_dist"]) for r in conform.fuzzy_candidates(df, "t", ["b"], dim, "name", ["bb"], max_dist=k, keep=["id"]).collect())
        want = sorted((r, i, edits(t, n)) for r, t, b in rows for i, n, bb in mem if b == bb and edits(t, n) <= k)
        assert got == want


def test_preload_dimensions(spark, tmp_path):
    (tmp_path / "csv").mkdir()
    (tmp_path / "csv" / "city.csv").write_text("id,name,slug,state_id\n1,Dallas,dallas,43\n")
    files.preload_dimensions(spark, str(tmp_path / "csv"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "city")).collect()[0].asDict() == {"id": 1, "name": "Dallas", "slug": "dallas", "state_id": 43}
    assert spark.read.parquet(str(tmp_path / "out" / "artist")).count() == 0


def _most_rows(plan):
    """Rows that the busiest node of an executed plan gave."""
    name, rows = plan.nodeName(), plan.metrics().get("numOutputRows")
    inner = [plan.executedPlan()] if name == "AdaptiveSparkPlan" else [plan.plan()] if name.endswith("QueryStage") else []
    kids = [plan.children().apply(i) for i in range(plan.children().size())]
    return max([rows.get().value() if rows.isDefined() else 0, *(_most_rows(p) for p in inner + kids)])


def test_venues_of_one_name_are_not_paired_with_all_events(spark):
    """300 venues and 300 events of one name, right and misspelt: no join gives more than a few rows per event."""
    from marquee.operators.places import match_venues
    venues = spark.range(300).selectExpr("id", "'Memorial Hall' AS name", "'memorial-hall' AS slug", "id % 2 AS city_id")
    cities = spark.createDataFrame([(0, "Salem"), (1, "Troy"), (2, "Troy"), (3, "Rome")], "id long, name string")
    events = spark.range(300).selectExpr("id AS k", "IF(id % 3 = 0, 'Memorial Hxll', 'Memorial Hall') AS venue_name", "id % 4 AS city_id",
                                         "IF(id % 4 = 2, 'Troy', NULL) AS _cand")
    out = match_venues(events, "k", venues, cities)
    got = {r.k: r.venue_id for r in out.collect()}
    want = {k: k % 4 for k in range(300) if k % 4 < 2} | {k: 1 for k in range(300) if k % 4 == 2 and k % 3}
    assert got == want
    assert _most_rows(out._jdf.queryExecution().executedPlan()) < 2000
