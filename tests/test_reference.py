"""Alias maps and lists from files, as a literal and as a join."""
import json

from marquee.sources import reference


def test_an_alias_needs_no_code(spark, tmp_path):
    path, rows = tmp_path / "cities.json", spark.createDataFrame([("Buttato",), ("dallas",), ("ALA",), (None,)], "t string")
    content = {"buffalo": ["buttato", "bufalo"], "ala": 1}
    path.write_text(json.dumps(content))
    for limit in (10, 1):   # a literal, a join
        got = reference.with_value(rows, "t", reference.read_aliases(spark, str(path)), "v", limit).collect()
        assert {r.t: r.v for r in got} == {"Buttato": "buffalo", "dallas": None, "ALA": "1", None: None}
    path.write_text(json.dumps({**content, "dallas": ["daltas", "Dallas"]}))
    got = reference.with_value(rows, "t", reference.read_aliases(spark, str(path)), "v").collect()
    assert {r.t: r.v for r in got}["dallas"] == "dallas"
    path.write_text("{}")
    assert [r.v for r in reference.with_value(rows, "t", reference.read_aliases(spark, str(path)), "v").collect()] == [None] * 4


def test_lists(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Disney On Ice\r\n\nBlue Man Group\nDisney On Ice\n")
    (tmp_path / "b.json").write_text('["x", "y"]')
    assert sorted(r.value for r in reference.read_list(spark, str(tmp_path / "a.txt")).collect()) == ["Blue Man Group", "Disney On Ice"]
    assert sorted(r.value for r in reference.read_list(spark, str(tmp_path / "b.json")).collect()) == ["x", "y"]
