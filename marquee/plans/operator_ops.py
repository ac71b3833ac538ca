"""Queries that run whole operators on the driver tables: the listing from
bridges, lists of names to lists of ids, venues of one name in several cities."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import text
from marquee.operators import artists, conform, load, places
from marquee.plans.conform import known_members, known_members_sql
from marquee.plans.listing import Q01_SQL
from marquee.plans.registry import query
from marquee.plans.text_ops import _slug_sql
from marquee.sources.tables import table


@query("q49_listing_from_bridges", Q01_SQL)
def q49_listing_from_bridges(spark, sf):
    """The listing of q01 through the warehouse tables: event, bridges, dimensions."""
    items = table(spark, sf, "lineitem").join(
        table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(8,2)").alias("price")), F.col("l_partkey") == F.col("p_partkey"))
    items = items.withColumnRenamed("l_orderkey", "event_id")
    facts = items.groupBy("event_id").agg(F.max(F.to_date("l_shipdate")).alias("end_date"), F.sum("l_quantity").cast("bigint").alias("attendance"))
    event = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("event_name"), F.col("o_custkey").alias("venue_id"),
        F.to_date("o_orderdate").alias("start_date"), F.round("o_totalprice").cast("bigint").alias("gross_receipts_us")) \
        .join(facts, "event_id").withColumnRenamed("event_id", "id")
    return load.event_listing(
        event, table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")),
        table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
        items.select("event_id", F.col("l_partkey").alias("artist_id")).distinct(),
        items.select("event_id", F.col("price").alias("ticket_price")).distinct())


@query("q50_ids_in_order", f"""
WITH dim AS {known_members_sql('c')},
n AS (SELECT l.l_orderkey, row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity) AS pos, p.p_name
      FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
j AS (SELECT n.*, dim.id FROM n LEFT JOIN dim ON dim.slug = {_slug_sql('n.p_name')})
SELECT l_orderkey, coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) FILTER (id IS NOT NULL), '') AS ids,
       coalesce(string_agg(p_name, ',' ORDER BY pos) FILTER (id IS NULL), '') AS missing
FROM j GROUP BY l_orderkey
""")
def q50_ids_in_order(spark, sf):
    """Lists of names (one per order) to lists of ids in list order; names without a member are reported."""
    part = table(spark, sf, "part")
    names = table(spark, sf, "lineitem").join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    lists = names.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(
        F.struct("l_linenumber", "l_partkey", "l_quantity", "p_name"))), lambda s: s["p_name"]).alias("names"))
    dim = known_members(part, "c")
    got = conform.ids_in_order(lists, "l_orderkey", "names", dim, text.slugify)
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return got.select("l_orderkey", joined("ids").alias("ids"), joined("ids_missing").alias("missing"))


@query("q51_match_venues", """
WITH v AS (SELECT s_suppkey AS id, 'Memorial Hall ' || (s_suppkey % 7) AS name, s_nationkey AS city FROM supplier),
e AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Memorial Hxll ' ELSE 'Memorial Hall ' END || (c_custkey % 9) AS name, c_nationkey AS city FROM customer),
exact AS (SELECT c_custkey, city, name AS k FROM e WHERE name IN (SELECT name FROM v)),
fuzzy AS (SELECT e.c_custkey, e.city, arg_max(v.name, v.id) AS k FROM e JOIN v ON v.city = e.city AND levenshtein(v.name, e.name) <= 2
          WHERE e.name NOT IN (SELECT name FROM v) GROUP BY ALL),
keyed AS (SELECT * FROM exact UNION ALL SELECT * FROM fuzzy),
m AS (SELECT keyed.c_custkey, min(v.id) AS venue_id, any_value(v.name) AS matched_name FROM keyed JOIN v ON v.name = keyed.k AND v.city = keyed.city GROUP BY 1)
SELECT e.c_custkey, m.venue_id, m.matched_name FROM e LEFT JOIN m ON m.c_custkey = e.c_custkey
""")
def q51_match_venues(spark, sf):
    """Venues whose names repeat over cities: by name in the event's own city,
    misspelt names within two edits there, else none."""
    nation = table(spark, sf, "nation")
    venues = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit("Memorial Hall "), (F.col("s_suppkey") % 7).cast("string")).alias("name"),
        F.col("s_nationkey").alias("city_id")).withColumn("slug", text.slugify("name"))
    cities = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    word = F.when(F.col("c_custkey") % 3 == 0, F.lit("Memorial Hxll ")).otherwise(F.lit("Memorial Hall "))
    events = table(spark, sf, "customer").select("c_custkey", F.concat(word, (F.col("c_custkey") % 9).cast("string")).alias("venue_name"),
                                                 F.col("c_nationkey").alias("city_id"), F.lit(None).cast("string").alias("_cand"))
    return events.select("c_custkey").join(places.match_venues(events, "c_custkey", venues, cities), "c_custkey", "left")


@query("q52_place_chain", """
SELECT s.s_suppkey AS venue_id, s.s_name AS venue_name, coalesce(n.n_nationkey, -1) AS city_id, coalesce(n.n_name, 'Unknown') AS city_name,
       coalesce(r.r_regionkey, -1) AS state_id, coalesce(r.r_name, 'Unknown') AS state_name,
       CASE WHEN r.r_regionkey IS NULL OR r.r_regionkey = 4 THEN -1 ELSE r.r_regionkey // 2 END AS country_id,
       CASE WHEN r.r_regionkey IS NULL OR r.r_regionkey = 4 THEN 'Unknown' ELSE 'Country ' || (r.r_regionkey // 2) END AS country_name
FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey AND n.n_nationkey % 6 <> 5
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def q52_place_chain(spark, sf):
    """Venue, city, state and country with the Unknown member for every gap (missing cities, a state without country)."""
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    named = lambda df, i, n, *more: df.select(F.col(i).alias("id"), F.col(n).alias("name"), *more)
    number = F.floor(F.col("r_regionkey") / 2).cast("int")
    country = region.filter("r_regionkey <> 4").select(number.alias("id"), F.concat(F.lit("Country "), number.cast("string")).alias("name")).distinct()
    state = named(region, "r_regionkey", "r_name", number.alias("country_id"))
    city = named(nation.filter("n_nationkey % 6 <> 5"), "n_nationkey", "n_name", F.col("n_regionkey").alias("state_id"))
    venue = named(table(spark, sf, "supplier"), "s_suppkey", "s_name", F.col("s_nationkey").alias("city_id"))
    return load.place_chain(venue, city, state, country)


@query("q53_artist_parent", """
WITH a AS (SELECT p_partkey AS id, p_name || ' ' || p_partkey AS name, CASE WHEN p_partkey % 10 <> 0 THEN p_partkey - p_partkey % 10 END AS parent_id FROM part)
SELECT a.id, a.name, a.parent_id, b.name AS parent_name FROM a LEFT JOIN a b ON b.id = a.parent_id
""")
def q53_artist_parent(spark, sf):
    """Artists with the name of their parent artist (self join; some parents do not exist)."""
    k = F.col("p_partkey")
    artist = table(spark, sf, "part").select(k.alias("id"), F.concat_ws(" ", "p_name", k.cast("string")).alias("name"),
                                             F.when(k % 10 != 0, k - k % 10).alias("parent_id"))
    return load.with_parent(artist)


@query("q59_artist_lists", f"""
WITH dim AS {known_members_sql('4')},
x AS (SELECT l.l_orderkey, l.l_orderkey % 3 AS kind, upper(p.p_name) AS name,
             row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity) AS pos,
             count(*) OVER (PARTITION BY l.l_orderkey) AS n FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
r AS (SELECT a.l_orderkey, a.pos, CASE WHEN a.kind = 0 AND a.n > 2 AND a.pos = 2 THEN a.name || '/' || b.name ELSE a.name END AS raw, a.name AS lft, b.name AS rgt
      FROM x a LEFT JOIN x b ON b.l_orderkey = a.l_orderkey AND b.pos = a.pos + 1 WHERE NOT (a.kind = 0 AND a.n > 2 AND a.pos = 3)),
s AS (SELECT l_orderkey, pos, CASE WHEN NOT contains(raw, '/') OR {_slug_sql('raw')} IN (SELECT slug FROM dim) THEN raw
             WHEN {_slug_sql("replace(raw, '/', ' ')")} IN (SELECT slug FROM dim) THEN replace(raw, '/', ' ')
             WHEN {_slug_sql('lft')} IN (SELECT slug FROM dim) THEN lft WHEN {_slug_sql('rgt')} IN (SELECT slug FROM dim) THEN rgt ELSE raw END AS name FROM r),
k AS (SELECT *, {_slug_sql('name')} AS slug FROM s),
new AS (SELECT slug, (SELECT max(id) FROM dim) + row_number() OVER (ORDER BY slug) AS id FROM (SELECT DISTINCT slug FROM k WHERE slug NOT IN (SELECT slug FROM dim))),
every AS (SELECT slug, id FROM dim UNION ALL SELECT slug, id FROM new)
SELECT l_orderkey, string_agg(name, '; ' ORDER BY pos) AS names, string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) AS ids
FROM k JOIN every ON every.slug = k.slug GROUP BY l_orderkey
""")
def q59_artist_lists(spark, sf):
    """Artist cells to ids end to end: plain cells, a slash whose right half takes in the next cell, festival lines cut at
    commas; names resolved to known members by their candidates, new members after the largest id."""
    part = table(spark, sf, "part")
    li = table(spark, sf, "lineitem").join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    lists = li.groupBy("l_orderkey").agg(F.transform(F.sort_array(F.collect_list(
        F.struct("l_linenumber", "l_partkey", "l_quantity", F.upper("p_name").alias("n")))), lambda s: s["n"]).alias("n"))
    kind, n = F.col("l_orderkey") % 3, F.size("n")
    slash = F.when(n > 1, F.concat(F.array(F.concat_ws("/", F.get("n", 0), F.get("n", 1))), F.slice("n", F.lit(3), F.greatest(n - 2, F.lit(0))))).otherwise(F.col("n"))
    festival = F.transform("n", lambda x, i: F.when(i < n - 1, F.concat(x, F.lit(","))).otherwise(x))
    events = lists.select("l_orderkey", F.when(kind == 0, slash).when(kind == 1, festival).otherwise(F.col("n")).alias("cells"), (kind == 1).alias("festival"))
    out, _ = artists.curate_artists(events, "l_orderkey", "cells", "festival", known_members(part, "4"))
    return out.select("l_orderkey", F.array_join("artist_names", "; ").alias("names"),
                      F.array_join(F.transform("artist_ids", lambda i: i.cast("string")), ",").alias("ids"))
