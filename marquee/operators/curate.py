"""Curation of processed events (all issues at once) into curated events.

Same dependency order as the per-issue original -- raw signature ->
corrections -> rank -> event name -> artists -> locations -> promoters ->
dates -> final signature -> numeric gates -> prices -> metadata -- but each
step is one DataFrame transformation over every issue, and the dimensions
grow once per batch (set-based) instead of row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import dates, money, names, places, text
from marquee.operators import artists as artist_ops
from marquee.operators import lines, places as place_ops, promoters as promoter_ops, quality
from marquee.operators.corrections import apply_corrections
from marquee.session import cut_lineage
from marquee.sources.files import LIST_COLUMNS, NUMERIC_COLUMNS

NUMERIC = ["gross_receipts_us", "gross_receipts_canadian", "attendance", "capacity", "num_shows"]
# Any field of a processed event may be corrected; numbers stay text until their own repair.
CORRECTABLE = {c: "string" for c in NUMERIC_COLUMNS + ["source_id", "schema_id", "s3_uri"]} | {c: "array<string>" for c in LIST_COLUMNS}


@dataclass
class Dimensions:
    artists: DataFrame     # id, name, slug, parent_id
    venues: DataFrame      # id, name, slug, city_id, state_id
    cities: DataFrame      # id, name, slug, state_id
    promoters: DataFrame   # id, name, slug
    sources: DataFrame     # id, name, slug, reliability


def _raw_venue_name(tokens_col: str):
    """Venue words for the raw signature: state alias after the venue word
    removed, the tail after the last venue-type word dropped."""
    t = places.state_after_venue(places.location_tokens(tokens_col))["tokens"]
    return F.array_join(places.isolate_venue(t), " ")


def curate_events(processed: DataFrame, dims: Dimensions, corrections: DataFrame | None = None
                  ) -> tuple[DataFrame, dict[str, DataFrame]]:
    """processed rows (``file``, ``row_pos``, issue_year/month, list columns as
    arrays, numbers as text) -> (curated events, new dimension members)."""
    processed = cut_lineage(processed)   # row numbers are read more than once: fix them
    d = processed.withColumn("_key", F.concat_ws("#", "file", F.col("row_pos").cast("string")))
    d = lines.rank_in_group(d, ["file"], "row_pos", "weekly_rank")
    # raw signature (keys the manual corrections)
    d = d.withColumn("_first_line", F.get("artists", 0))
    d = d.withColumn("_raw_venue", _raw_venue_name("location"))
    d = d.withColumn("_d0", dates.curate_date(F.col("dates"), F.col("issue_year"), F.col("issue_month")))
    d = d.withColumn("raw_signature", F.concat_ws(
        "-", F.lower(F.replace(F.coalesce("_first_line", F.lit("None")), F.lit(" "), F.lit("-"))),
        F.lower(F.replace("_raw_venue", F.lit(" "), F.lit("-"))),
        F.coalesce(F.col("_d0.start_date").cast("string"), F.lit("None"))))
    if corrections is not None:
        # only the first row of a repeated raw signature is corrected
        first = d.groupBy("raw_signature").agg(F.min(F.struct("file", "row_pos")).alias("_first"))
        d = d.join(first, "raw_signature").withColumn(
            "_is_first", F.struct("file", "row_pos") == F.col("_first")).drop("_first")
        d = d.withColumn("_corr_key", F.when(F.col("_is_first"), F.col("raw_signature")))
        d = apply_corrections(d, corrections, key="_corr_key", fields=CORRECTABLE).drop("_corr_key", "_is_first")
    d = cut_lineage(d)
    # special-event name and the remaining artist lines
    d = names.event_names(d, "artists", "_en")
    d = d.withColumn("event_name", F.col("_en.event_name")).withColumn("_artist_lines", F.col("_en.artists"))
    d = d.drop("_en").withColumn("_in_event", F.col("event_name").isNotNull())
    d, new_artists = artist_ops.curate_artists(d, "_key", "_artist_lines", "_in_event", dims.artists)
    d, new_artists = cut_lineage(d), cut_lineage(new_artists)
    d, new_cities, new_venues = place_ops.curate_locations(d, "_key", "location", dims.cities, dims.venues,
                                                             order=["issue_year", "issue_month", "weekly_rank", "_key"])
    d = cut_lineage(d)
    d, new_promoters = promoter_ops.curate_promoters(d, "_key", "promoter", "venue_name", dims.promoters)
    d, new_promoters = cut_lineage(d), cut_lineage(new_promoters)
    d = d.withColumn("_d", dates.curate_date(F.col("dates"), F.col("issue_year"), F.col("issue_month")))
    d = (d.withColumn("start_date", F.col("_d.start_date")).withColumn("end_date", F.col("_d.end_date"))
         .withColumn("dates", F.col("_d.dates")))
    # final signature: event or first artist slug - venue - start date
    first_artist = F.get("artist_names", 0)
    d = d.withColumn("signature", F.concat_ws(
        "-", F.coalesce(F.nullif(text.slugify("event_name"), F.lit("")), text.slugify(first_artist), F.lit("None")),
        F.lower(F.replace(F.coalesce("venue_name", F.lit("")), F.lit(" "), F.lit("-"))),
        F.coalesce(F.col("start_date").cast("string"), F.lit("None"))))
    # numeric gates per issue on the raw values, then OCR repair
    for c in NUMERIC + ["num_sellouts"]:
        d = d.withColumn(f"_raw_{c}", F.col(c).try_cast("double"))
    gated = quality.gate_flags(d, ["file"], [f"_raw_{c}" for c in NUMERIC])
    gated = quality.sellout_gate(gated, ["file"], "_raw_num_shows", "_raw_num_sellouts")
    for c in NUMERIC:
        gated = gated.withColumn(c, F.when(F.col(f"_ok__raw_{c}"), money.parse_ocr_int(F.col(c), "bigint")))
    gated = gated.withColumn("num_sellouts", F.col("_raw_num_sellouts").cast("bigint"))
    gated = gated.withColumn("ticket_prices", money.curate_prices(F.col("ticket_prices")))
    src = dims.sources.select(F.col("slug").alias("_src_slug"), F.col("id").alias("_src_id"))
    gated = gated.join(src, F.col("source_id") == F.col("_src_slug"), "left")   # AQE broadcasts it when small
    out = gated.select(
        "weekly_rank", "event_name", "artist_ids", "venue_id", F.col("promoter_ids").alias("promoters"),
        "start_date", "end_date", "dates", "signature", *NUMERIC, "num_sellouts", "ticket_prices",
        "schema_id", F.col("_src_id").alias("source_id"), "s3_uri", "issue_year", "issue_month", "file",
        "raw_signature")
    return out, {"artists": new_artists, "cities": new_cities, "venues": new_venues, "promoters": new_promoters}
