"""Artist pipeline: split cells into names, resolve each name against the
artist dimension, add new artists, map names to ids in list order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import names, text
from marquee.operators import conform
from marquee.session import cut_lineage


def resolve_names(distinct_names: DataFrame, col: str, dim: DataFrame) -> DataFrame:
    """Distinct raw names -> (col, resolved): corrections map first, then the
    best-priority candidate whose slug is an artist, else the name itself;
    implausible names (< 2 chars) resolve to null."""
    d = dim.select("slug").distinct().withColumn("_hit", F.lit(True))
    cands = distinct_names.select(col, F.explode(names.artist_candidates(F.col(col))).alias("c")).select(
        col, F.col("c.prio").alias("prio"), F.col("c.name").alias("name"),
        text.slugify(F.col("c.name")).alias("slug"))
    fixed = names.corrections_map()[F.col("slug")]
    j = cands.join(d, "slug", "left")
    hit = F.when(fixed.isNotNull(), F.struct(F.lit(-1).alias("p"), fixed.alias("n"))).when(
        F.col("_hit"), F.struct(F.col("prio").alias("p"), F.col("name").alias("n")))
    best = j.groupBy(col).agg(F.min(hit).alias("_best"))
    return best.select(col, F.when(~names.plausible_artist(F.col(col)), F.lit(None))
                       .otherwise(F.coalesce(F.col("_best.n"), F.col(col))).alias("resolved"))


def curate_artists(events: DataFrame, key: str, artists_col: str, in_event_col: str,
                   dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """-> (events + ``artist_ids``/``artist_names``, new artist members).

    Names are resolved, slugged and given ids once per distinct spelling (the
    distinct set is far smaller than the events and written out, as three steps
    read it), new members after ``max(id)``; then one explode/join/regroup
    maps each event's names to ids in order.
    """
    ev = events.withColumn("_names", names.split_artist_cells(F.col(artists_col), F.col(in_event_col)))
    ex = ev.select(key, F.posexplode("_names").alias("_pos", "_raw"))
    resolved = cut_lineage(resolve_names(ex.select("_raw").distinct(), "_raw", dim).filter(F.col("resolved").isNotNull()))
    new = conform.add_members(dim, resolved, "resolved", text.slugify, extra={"parent_id": F.lit(None).cast("int")})
    full = dim.select("id", "slug").unionByName(new.select("id", "slug"))
    named = resolved.withColumn("slug", text.slugify("resolved")) \
        .join(full.groupBy("slug").agg(F.min("id").alias("_id")), "slug", "left").drop("slug")
    ids = (ex.join(named, "_raw").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_id", "resolved"))).alias("_l")))
    ids = ids.select(key, F.transform("_l", lambda s: s["_id"].cast("int")).alias("artist_ids"),
                     F.transform("_l", lambda s: s["resolved"]).alias("artist_names"))
    out = (ev.drop("_names").join(ids, key, "left")
           .withColumn("artist_ids", F.coalesce("artist_ids", F.array().cast("array<int>")))
           .withColumn("artist_names", F.coalesce("artist_names", F.array().cast("array<string>"))))
    return out, new
