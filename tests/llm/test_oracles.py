"""Every SQL oracle of the subpackage against its query, on the smallest tables."""
import math

import duckdb
import pytest

from marquee.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, DIR)
    assert sorted(want.columns) == sorted(got.columns)
    cols = sorted(want.columns)
    fix = lambda r: tuple("null" if v is None else round(v, 9) if isinstance(v, float) and math.isfinite(v) else v for v in r)
    assert sorted(map(fix, want.select(*cols).fetchall()), key=str) == sorted((fix(r) for r in got.select(*cols).collect()), key=str)
