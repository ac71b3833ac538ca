"""Connected components of an edge table, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import saved


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node of an edge (a, b).

    Alternates two steps until nothing changes: every node ties its larger
    neighbours to its smallest one, then its smaller neighbours and itself.  A
    node with very many neighbours costs a combined minimum and a join that
    Spark can split; rounds grow with the logarithm of the longest path.
    """
    now = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), name)
    mark = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = saved(large, name)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")) \
            .select("e.a", "e.b").filter("a <> b").distinct()
        now = saved(small, name)
        got = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if got == mark:
            break
        mark = got
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select("b", "b").distinct())
