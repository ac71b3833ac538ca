"""Tables that change together: every load is a version, visible as a whole or not at all.

A load writes each table to a folder of its own and last of all a manifest, one
small file that Spark's commit makes appear at once.  Readers follow the latest
manifest, so a load that stops half-way leaves the version before it readable,
and its folders are never looked at.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, name string, path string"


def _manifest(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST).json(f"{root}/versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def latest(spark: SparkSession, root: str) -> int:
    """The number of the last whole version, 0 before the first."""
    found = _manifest(spark, root)
    return 0 if found is None else found.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def commit(tables: dict[str, DataFrame], root: str, keep: bool = True) -> int:
    """Write ``tables`` as the next version; with ``keep`` tables that are not given stay as they were.

    Two loads at once: the second to write its manifest fails, and its version is not seen.
    """
    spark = next(iter(tables.values())).sparkSession
    before = latest(spark, root)
    paths = {}
    if keep and before:
        paths = {r["name"]: r.path for r in _manifest(spark, root).filter(F.col("version") == before).collect()}   # one row per table
    for name, df in tables.items():
        paths[name] = f"{root}/data/{name}/{uuid.uuid4().hex}"
        df.write.parquet(paths[name])
    rows = [(before + 1, name, path) for name, path in sorted(paths.items())]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("errorifexists").json(f"{root}/versions/number={before + 1}")
    return before + 1


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table as of ``version`` (default: the latest)."""
    version = latest(spark, root) if version is None else version
    found = _manifest(spark, root)
    row = None if found is None else found.filter((F.col("version") == version) & (F.col("name") == name)).first()
    if row is None:
        raise ValueError(f"no table {name} in version {version} of {root}")
    return spark.read.parquet(row.path)
