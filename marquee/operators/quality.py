"""Validity gates and constraint reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_gate(df: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    """Per group (issue): a column whose non-null values are not all >= 0 is
    nulled for the whole group.  Gate flags come from one grouped aggregate
    joined back (partial aggregation; no window buffering a hot group)."""
    flags = df.groupBy(*group).agg(*[F.coalesce(F.bool_and(F.col(c) >= 0), F.lit(True)).alias(f"_ok_{c}")
                                     for c in cols])
    out = df.join(flags, group, "left")
    for c in cols:
        out = out.withColumn(c, F.when(F.col(f"_ok_{c}"), F.col(c)))
    return out.drop(*[f"_ok_{c}" for c in cols])


def gate_flags(df: DataFrame, group: list[str], cols: list[str], prefix: str = "_ok_") -> DataFrame:
    """Add ``<prefix><col>`` = every non-null value of ``col`` in the group
    is >= 0 (one grouped aggregate joined back)."""
    flags = df.groupBy(*group).agg(*[F.coalesce(F.bool_and(F.col(c) >= 0), F.lit(True)).alias(f"{prefix}{c}")
                                     for c in cols])
    return df.join(flags, group, "left")


def sellout_gate(df: DataFrame, group: list[str], shows: str = "num_shows",
                 sellouts: str = "num_sellouts") -> DataFrame:
    """Sellouts are kept for a group only if all are >= 0 and never exceed
    the shows where both are present."""
    both = F.col(shows).isNotNull() & F.col(sellouts).isNotNull()
    flags = df.groupBy(*group).agg(
        F.coalesce(F.bool_and(F.when(both, (F.col(sellouts) >= 0) & (F.col(sellouts) <= F.col(shows)))),
                   F.lit(True)).alias("_ok"))
    return (df.join(flags, group, "left")
            .withColumn(sellouts, F.when(F.col("_ok"), F.col(sellouts))).drop("_ok"))


def key_report(df: DataFrame, keys: list[str], rules: dict[str, Column], duplicates: str) -> DataFrame:
    """(check, violations): rows beyond the first per key, and rows that meet
    each violation ``rule``; one scan, one shuffle of per-key counts."""
    per_key = df.groupBy(*keys).agg((F.count("*") - 1).alias(duplicates), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    total = per_key.agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in (duplicates, *rules)])
    return total.unpivot([], [duplicates, *rules], "check", "violations")
