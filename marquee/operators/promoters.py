"""Promoter pipeline: split cells, resolve by slug, add new promoters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import names, text
from marquee.operators import conform


def curate_promoters(events: DataFrame, key: str, promoter_col: str, venue_name_col: str,
                     dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """-> (events + ``promoter_ids``, new promoter members).  Lookup is by
    slug; a slug repeated in the dimension resolves to its smallest id."""
    ev = events.withColumn("_pn", names.split_promoters(F.col(promoter_col), F.col(venue_name_col)))
    ex = ev.select(key, F.posexplode("_pn").alias("_pos", "_name")).withColumn("slug", text.slugify("_name"))
    ex = ex.filter(F.col("slug") != "")
    new = conform.add_members(dim, ex.select("_name"), "_name", text.slugify)
    full = dim.select("id", "slug").unionByName(new.select("id", "slug")).groupBy("slug").agg(F.min("id").alias("_id"))
    ids = (ex.join(full, "slug", "left").groupBy(key)
           .agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_id"))), lambda s: s["_id"].cast("int"))
                .alias("promoter_ids")))
    out = (ev.drop("_pn").join(ids, key, "left")
           .withColumn("promoter_ids", F.coalesce("promoter_ids", F.array().cast("array<int>"))))
    return out, new
