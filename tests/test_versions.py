"""Versioned loads, partitions that are replaced alone, files of several encodings, hierarchies."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from marquee.operators import load
from marquee.sources import files, versions


def test_a_load_is_seen_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path / "wh")
    one = lambda v: spark.createDataFrame([(v,)], "v int")
    assert versions.latest(spark, root) == 0
    with pytest.raises(ValueError):
        versions.read(spark, root, "event")
    assert versions.commit({"event": one(1), "artist": one(1)}, root) == 1
    broken = one(2).select(F.raise_error(F.lit("lost")).alias("v"))
    with pytest.raises(Exception, match="lost"):
        versions.commit({"event": one(2), "artist": broken}, root)   # stops after the first table
    assert versions.latest(spark, root) == 1
    assert [versions.read(spark, root, t).first().v for t in ("event", "artist")] == [1, 1]
    assert versions.commit({"event": one(3)}, root) == 2
    assert [versions.read(spark, root, t).first().v for t in ("event", "artist")] == [3, 1]
    assert versions.read(spark, root, "event", 1).first().v == 1


def test_only_given_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "issues")
    rows = lambda *r: spark.createDataFrame(r, "issue_year int, issue_month int, v int")
    names = lambda y: sorted(glob.glob(f"{path}/issue_year={y}/**/*.parquet", recursive=True))
    files.refresh_partitions(rows((1984, 1, 1), (1984, 2, 2), (1985, 1, 3)), path, ["issue_year", "issue_month"])
    before = names(1985)
    files.refresh_partitions(rows((1984, 2, 5), (1986, 1, 9)), path, ["issue_year", "issue_month"])
    assert names(1985) == before
    assert sorted((r.issue_year, r.issue_month, r.v) for r in spark.read.parquet(path).collect()) == [(1984, 1, 1), (1984, 2, 5), (1985, 1, 3), (1986, 1, 9)]
    got = files.read_issues(spark, path, 1984, 2)
    plan = got._jdf.queryExecution().toString()
    assert got.first().v == 5 and "PartitionFilters: [isnotnull(issue_year" in plan and "issue_month" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_files_of_three_encodings(spark, tmp_path):
    head = ",".join(files.PROCESSED_COLUMNS)
    row = lambda name: f"\"['{name}']\",['Nov. 1'],1,,2,3,,,['P'],['15'],['Hall'],billboard,bb_3,s3"
    names = {"utf-8": "Beyoncé Łódź", "iso-8859-1": "Mötley Crüe", "cp1252": "That’s naïve – œuvre"}
    for k, (encoding, name) in enumerate(names.items()):
        folder = tmp_path / "1984" / f"{k + 1}"
        os.makedirs(folder)
        (folder / "a.csv").write_bytes("\r\n".join([head, row(name), "too,few"]).encode(encoding))
    got = files.read_mixed_csvs(spark, str(tmp_path)).collect()
    good = {r.issue_month: (r.artists, r.encoding, r.capacity) for r in got if r.reason is None}
    assert good == {k + 1: ([name], "UTF-8" if e == "utf-8" else "windows-1252", "3") for k, (e, name) in enumerate(names.items())}
    assert sorted((r.issue_month, r[files.CORRUPT]) for r in got if r.reason) == [(k, "too,few") for k in (1, 2, 3)]


def test_hierarchy(spark):
    chain = [(i, i - 1 if i else None) for i in range(40)]
    rows = chain + [(100, 101), (101, 102), (102, 100), (103, 100), (200, 999), (201, 200), (300, 300), (400, None), (400, None)]
    got = {r.id: (r.root_id, r.depth, r.reason) for r in load.hierarchy(spark.createDataFrame(rows, "id long, parent_id long")).collect()}
    want = {i: (0, i, None) for i in range(40)} | {i: (None, None, "cycle") for i in (100, 101, 102, 103, 300)}
    assert got == want | {200: (200, 0, "no such parent"), 201: (200, 1, None), 400: (400, 0, None)}
    assert load.hierarchy(spark.createDataFrame([], "id long, parent_id long")).count() == 0
