"""Sources, sinks and schema handling on the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from marquee.plans.registry import query
from marquee.session import ensure_checkpoint_dir
from marquee.sources import files
from marquee.sources.tables import table


@query("q38_union_sections", """
SELECT 'stadium' AS section, event_id, CAST(floor(value * 100) AS BIGINT) AS attendance FROM events WHERE event_type = 'view'
UNION ALL
SELECT 'arena', event_id, CAST(floor(value * 100) AS BIGINT) FROM events WHERE event_type = 'click'
UNION ALL
SELECT 'auditorium', event_id, CAST(floor(value * 100) AS BIGINT) FROM events WHERE event_type NOT IN ('view', 'click')
""")
def q38_union_sections(spark, sf):
    """Three section lists read with drifting schemas (``attendance`` vs
    ``tickets_sold``) unioned by name and the drift folded."""
    ev = table(spark, sf, "events").select("event_id", "event_type",
                                          F.floor(F.col("value") * 100).cast("bigint").alias("n"))
    stadium = ev.filter(F.col("event_type") == "view").select(F.lit("stadium").alias("section"), "event_id",
                                                              F.col("n").alias("attendance"))
    arena = ev.filter(F.col("event_type") == "click").select(F.lit("arena").alias("section"), "event_id",
                                                             F.col("n").alias("tickets_sold"))
    aud = ev.filter(~F.col("event_type").isin("view", "click")).select(
        F.lit("auditorium").alias("section"), "event_id", F.col("n").alias("attendance"))
    u = stadium.unionByName(arena, allowMissingColumns=True).unionByName(aud, allowMissingColumns=True)
    return u.select("section", "event_id", F.coalesce("attendance", "tickets_sold").alias("attendance"))


@query("q42_json_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def q42_json_props(spark, sf):
    """JSON text column -> typed field (schema given, no inference pass)."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("q45_path_parts", """
SELECT page_id,
       split_part(split_part(url, '://', 2), '/', 1) AS host,
       split_part(split_part(url, '://', 2), '/', 2) AS lang,
       TRY_CAST(regexp_extract(split_part(split_part(url, '://', 2), '/', 3), '^[0-9]+') AS INTEGER) AS page_no
FROM pages
""")
def q45_path_parts(spark, sf):
    """Partition values from object paths: segments counted from the start
    of the path (host / language / number), non-numeric -> null."""
    p = table(spark, sf, "pages")
    rest = F.split(F.substring_index(F.col("url"), "://", -1), "/")
    return p.select("page_id", F.get(rest, 0).alias("host"), F.get(rest, 1).alias("lang"),
                    F.nullif(F.regexp_extract(F.get(rest, 2), "^[0-9]+", 0), F.lit("")).try_cast("int")
                    .alias("page_no"))


@query("q45_file_listing")
def q45_file_listing(spark, sf):
    """Listing of the table files with a suffix filter; contents not read."""
    return files.list_files(spark, sf, ".parquet").select(
        F.element_at(F.split("path", "/"), -1).alias("file"), "length")


@query("q47_round_trip", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS issue_year, CAST(month(o_orderdate) AS INTEGER) AS issue_month,
       [o_orderstatus, o_orderpriority] AS tags, [o_orderstatus, o_orderpriority] AS tags_csv
FROM orders
""")
def q47_round_trip(spark, sf):
    """Parquet sink partitioned by issue year/month, read back with a
    partition filter (pruned at the scan), and a CSV copy with list columns
    carried as JSON text.  Written to the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/") + f"/round-trip-{uuid.uuid4().hex}"
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("issue_year"),
        F.month("o_orderdate").alias("issue_month"), F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    files.write_parquet(o, base + "/parquet", ["issue_year", "issue_month"])
    files.write_csv(o, base + "/csv", ["issue_year"])
    back = spark.read.parquet(base + "/parquet")
    csv = (spark.read.option("header", True).schema("o_orderkey bigint, o_totalprice double, issue_month int, "
                                                    "tags string").csv(base + "/csv")
           .select("o_orderkey", F.from_json("tags", "array<string>").alias("tags_csv")))
    return back.join(csv, "o_orderkey").select("o_orderkey", "issue_year", "issue_month", "tags", "tags_csv")
