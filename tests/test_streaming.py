"""availableNow file stream: two arrivals, duplicates suppressed by signature."""

from marquee.operators.curate import Dimensions
from marquee.streaming.ingest import start_ingest

HEADER = ("artists,dates,gross_receipts_us,gross_receipts_canadian,attendance,capacity,num_shows,num_sellouts,"
          "promoter,ticket_prices,location,source_id,schema_id,s3_uri\n")
ROW = ("\"['CULTURE CLUB']\",\"['Nov. 11']\",216736.0,,13983.0,,,,\"['Cellar Door Prods.']\",\"['15.50']\","
       "\"['Capital Centre', 'Landover, Md,']\",billboard,bb_3,s3://x\n")
ROW2 = ("\"['RATT']\",\"['Nov. 12']\",1000.0,,100.0,,,,\"['Cellar Door Prods.']\",\"['10']\","
        "\"['Capital Centre', 'Landover, Md,']\",billboard,bb_3,s3://y\n")


def test_available_now_ingest(spark, tmp_path):
    dims = Dimensions(
        artists=spark.createDataFrame([], "id int, name string, slug string, parent_id int"),
        venues=spark.createDataFrame([(2, "Capital Centre", "capital-centre", 5, 20)],
                                     "id int, name string, slug string, city_id int, state_id int"),
        cities=spark.createDataFrame([(5, "Landover", "landover", 20)], "id int, name string, slug string, state_id int"),
        promoters=spark.createDataFrame([], "id int, name string, slug string"),
        sources=spark.createDataFrame([(1, "Billboard", "billboard", 2)],
                                      "id int, name string, slug string, reliability int"))
    root = tmp_path / "processed"
    d1 = root / "1984" / "11"
    d1.mkdir(parents=True)
    (d1 / "BB-1984-11-17.csv").write_text(HEADER + ROW)
    events, ckpt = str(tmp_path / "events"), str(tmp_path / "ckpt")
    start_ingest(spark, str(root), events, ckpt, dims).awaitTermination(300)
    assert spark.read.parquet(events).count() == 1
    # a new issue arrives: one repeated event (same signature) and one new
    (d1 / "BB-1984-11-24.csv").write_text(HEADER + ROW + ROW2)
    start_ingest(spark, str(root), events, ckpt, dims).awaitTermination(300)
    got = spark.read.parquet(events)
    assert got.count() == 2
    assert sorted(r["signature"] for r in got.collect()) == [
        "culture-club-capital-centre-1984-11-11", "ratt-capital-centre-1984-11-12"]
    # a third issue brings a third artist: ids go on where the batches before ended
    (d1 / "BB-1984-12-01.csv").write_text(HEADER + ROW2.replace("RATT", "DIO") + ROW.replace("Nov. 11", "Nov. 13"))
    start_ingest(spark, str(root), events, ckpt, dims).awaitTermination(300)
    by = {}
    for r in spark.read.parquet(events).collect():
        by.setdefault(r["signature"].split("-capital")[0], set()).add(tuple(r["artist_ids"]))
    assert {k: len(v) for k, v in by.items()} == {"culture-club": 1, "ratt": 1, "dio": 1}
    assert len(set().union(*by.values())) == 3
    members = spark.read.parquet(events + "_dimensions/artists").collect()
    assert len({m["id"] for m in members}) == len(members) == 3


def test_corrections_reach_the_stream(spark, tmp_path):
    dims = Dimensions(
        artists=spark.createDataFrame([], "id int, name string, slug string, parent_id int"),
        venues=spark.createDataFrame([(2, "Capital Centre", "capital-centre", 5, 20)], "id int, name string, slug string, city_id int, state_id int"),
        cities=spark.createDataFrame([(5, "Landover", "landover", 20)], "id int, name string, slug string, state_id int"),
        promoters=spark.createDataFrame([], "id int, name string, slug string"),
        sources=spark.createDataFrame([(1, "Billboard", "billboard", 2)], "id int, name string, slug string, reliability int"))
    folder = tmp_path / "processed" / "1984" / "11"
    folder.mkdir(parents=True)
    (folder / "BB-1984-11-17.csv").write_text(HEADER + ROW)
    fixes = spark.createDataFrame([("culture-club-capital-centre-1984-11-11", "attendance", "14001", 1)],
                                  "event_signature string, field string, true_value string, seq int")
    events = str(tmp_path / "events")
    start_ingest(spark, str(tmp_path / "processed"), events, str(tmp_path / "ckpt"), dims, corrections=fixes).awaitTermination(300)
    assert [r.attendance for r in spark.read.parquet(events).collect()] == [14001]
