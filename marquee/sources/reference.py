"""Reference lists and alias maps from files: a new alias needs a line in a file, no code.

A map of up to ``LITERAL_ENTRIES`` entries becomes a literal in the plan, a
larger one is joined; results are the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LITERAL_ENTRIES = 10_000


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """(value): the distinct non-empty lines of a list file, or the elements of a JSON array."""
    text = spark.read.option("wholetext", True).text(path)
    array = F.when(F.trim("value").startswith("["), F.from_json("value", "array<string>")).otherwise(F.split("value", r"\r?\n"))
    return text.select(F.explode(array).alias("value")).select(F.trim("value").alias("value")).filter("value <> ''").distinct()


def read_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(alias, value) of a JSON object: ``{"ala": 1}`` maps a name to its value, ``{"buffalo": ["buttato"]}`` the spellings
    in a list to the name.  Aliases are lower-cased; of a repeated one the smallest value counts."""
    pairs = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", "map<string,string>")).alias("k", "v"))
    listed = F.col("v").startswith("[")
    several = pairs.filter(listed).select(F.explode(F.from_json("v", "array<string>")).alias("alias"), F.col("k").alias("value"))
    single = pairs.filter(~listed).select(F.col("k").alias("alias"), F.col("v").alias("value"))
    return several.unionByName(single).groupBy(F.lower("alias").alias("alias")).agg(F.min("value").alias("value"))


def with_value(df: DataFrame, col: str, aliases: DataFrame, out: str, limit: int = LITERAL_ENTRIES) -> DataFrame:
    """Add ``out``: the value of the alias in ``col`` (any case), null where there is none."""
    some = aliases.limit(limit + 1).collect()   # bounded: decides between the literal and the join
    if len(some) <= limit:
        entries = F.create_map(*[F.lit(x) for r in some for x in (r.alias, r.value)]) if some else F.create_map().cast("map<string,string>")
        return df.withColumn(out, entries[F.lower(col)])
    named = aliases.select(F.col("alias").alias("_alias"), F.col("value").alias(out))
    return df.join(named, F.lower(col) == F.col("_alias"), "left").drop("_alias")
