"""Growing dimensions on the driver tables: near-duplicate names brought together, locations resolved end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import text
from marquee.operators import conform, load, places
from marquee.plans.registry import query
from marquee.sources.tables import table


@query("q55_near_duplicate_members", """
WITH seq AS (SELECT c_nationkey, list([c_name] ORDER BY c_acctbal, c_name) AS names FROM customer GROUP BY c_nationkey),
fold AS (SELECT c_nationkey, list_reduce(names, lambda stay, x: CASE WHEN len(list_filter(stay, lambda k: levenshtein(k, x[1]) <= 2)) > 0
                                                                      THEN stay ELSE list_concat(stay, x) END) AS stay FROM seq)
SELECT c.c_nationkey AS city_id, c.c_name AS name, list_filter(f.stay, lambda k: levenshtein(k, c.c_name) <= 2)[1] AS kept
FROM customer c JOIN fold f ON f.c_nationkey = c.c_nationkey
""")
def q55_near_duplicate_members(spark, sf):
    """Names of each nation in the order of their balances: a name within two edits of an earlier one that stays folds into it."""
    names = table(spark, sf, "customer").select(F.col("c_nationkey").alias("city_id"), F.col("c_name").alias("name"), "c_acctbal")
    return conform.collapse_near(names, "name", ["city_id"], ["c_acctbal"])


# One city per nation, far from one another in spelling, and one state alias per region with the id of its state.
_CITIES = ["Albuquerque", "Birmingham", "Cincinnati", "Dubuque", "Evansville", "Flagstaff", "Galveston", "Harrisburg", "Iowa Falls",
           "Jackson", "Kalamazoo", "Lubbock", "Milwaukee", "Norfolk", "Oakland", "Pittsburgh", "Quincy", "Rochester", "Sacramento",
           "Tuscaloosa", "Utica", "Vicksburg", "Wheeling", "Youngstown", "Zanesville"]
_STATES = {"Ala.": 1, "Ariz.": 3, "Ark.": 4, "Calif.": 5, "Conn.": 7}
_CITIES_SQL = "[" + ", ".join(f"'{c}'" for c in _CITIES) + "]"
_STATE_IDS_SQL = "[" + ", ".join(map(str, _STATES.values())) + "]"


@query("q56_locations", f"""
WITH x AS (
  SELECT c.c_custkey, c.c_nationkey, {_CITIES_SQL}[c.c_nationkey + 1] AS city, {_STATE_IDS_SQL}[n.n_regionkey + 1] AS state_id, c.c_nationkey % 5 <> 4 AS old_city,
         c.c_custkey % 7 = 0 AS bad_city, c.c_custkey % 11 = 0 AS bad_venue, upper(c.c_mktsegment[1]) || lower(c.c_mktsegment[2:]) || ' Hall' AS venue, c.c_mktsegment AS seg
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
), s AS (
  SELECT *, CASE WHEN bad_city THEN city[1] || 'x' || city[3:] ELSE city END AS city_seen, CASE WHEN bad_venue THEN venue[1] || 'x' || venue[3:] ELSE venue END AS venue_seen FROM x
), first_city AS (
  SELECT c_nationkey, state_id, replace(lower(arg_min(city_seen, c_custkey)), ' ', '-') AS slug FROM s WHERE NOT old_city GROUP BY ALL
), new_city AS (
  SELECT c_nationkey, (SELECT max(c_nationkey) FROM s WHERE old_city) + row_number() OVER (ORDER BY slug || '|' || state_id) AS city_id FROM first_city
), c AS (
  SELECT s.*, CASE WHEN old_city THEN s.c_nationkey ELSE new_city.city_id END AS city_id, old_city AND s.c_nationkey % 2 = 0 AND seg = 'BUILDING' AS old_venue
  FROM s LEFT JOIN new_city ON new_city.c_nationkey = s.c_nationkey
), first_venue AS (
  SELECT city_id, seg, arg_min(venue_seen, c_custkey) AS venue_name FROM c WHERE NOT old_venue GROUP BY ALL
), new_venue AS (
  SELECT city_id, seg, venue_name, 100 + row_number() OVER (ORDER BY replace(lower(venue_name), ' ', '-') || '|' || city_id) AS venue_id FROM first_venue
)
SELECT c.c_custkey, CAST(CASE WHEN old_venue THEN c.c_nationkey + 76 ELSE v.venue_id END AS BIGINT) AS venue_id,
       CASE WHEN old_venue THEN venue ELSE v.venue_name END AS venue_name, CAST(c.city_id AS BIGINT) AS city_id, c.state_id
FROM c LEFT JOIN new_venue v ON v.city_id = c.city_id AND v.seg = c.seg
""")
def q56_locations(spark, sf):
    """Location cells to venues, cities and states end to end: known and new
    cities and venues, both misspelt in some cells; a new member has the spelling
    that was seen first and its misspellings fold into it."""
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    at = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), i + 1)
    bad = lambda col, k: F.when(F.col("c_custkey") % k == 0, F.concat(F.substring(col, 1, 1), F.lit("x"), F.substr(col, F.lit(3)))).otherwise(col)
    k = F.col("c_nationkey")
    venue = F.concat(F.initcap("c_mktsegment"), F.lit(" Hall"))
    cell = F.array(bad(venue, 11), F.concat(bad(at(_CITIES, k), 7), F.lit(", "), at(list(_STATES), F.col("n_regionkey"))))
    events = c.join(n, k == F.col("n_nationkey")).select("c_custkey", cell.alias("location"))
    # of the cities every fifth is new; venues known so far: one per second known city
    known = n.filter("n_nationkey % 5 <> 4").withColumn("c_nationkey", F.col("n_nationkey"))
    cities = known.select(F.col("n_nationkey").cast("long").alias("id"), at(_CITIES, k).alias("name"), text.slugify(at(_CITIES, k)).alias("slug"),
                          at(list(_STATES.values()), F.col("n_regionkey")).alias("state_id"))
    old = known.filter("n_nationkey % 2 = 0").select((F.col("n_nationkey") + 76).cast("long").alias("id"), F.lit("Building Hall").alias("name"),
                                                    F.lit("building-hall").alias("slug"), F.col("n_nationkey").cast("long").alias("city_id"))
    top = spark.createDataFrame([(100, "Elsewhere Dome", "elsewhere-dome", -1)], "id long, name string, slug string, city_id long")
    out, _, _ = places.curate_locations(events, "c_custkey", "location", cities, old.unionByName(top), order=["c_custkey"])
    return out.select("c_custkey", "venue_id", "venue_name", "city_id", "state_id")


@query("q58_hierarchy", """
WITH RECURSIVE n AS (
  SELECT p_partkey AS id, CASE WHEN p_partkey = 4 THEN 40 WHEN p_partkey % 50 = 49 THEN -p_partkey WHEN p_partkey >= 3 THEN p_partkey // 3 END AS parent_id FROM part
), r AS (
  SELECT id, id AS root_id, 0 AS depth, CASE WHEN parent_id IS NOT NULL THEN 'no such parent' END AS reason FROM n
  WHERE parent_id IS NULL OR parent_id NOT IN (SELECT id FROM n)
  UNION ALL SELECT n.id, r.root_id, r.depth + 1, NULL FROM n JOIN r ON n.parent_id = r.id
)
SELECT n.id, r.root_id, CAST(r.depth AS BIGINT) AS depth, CASE WHEN r.id IS NULL THEN 'cycle' ELSE r.reason END AS reason FROM n LEFT JOIN r ON r.id = n.id
""")
def q58_hierarchy(spark, sf):
    """Parents of parents up to the root, at any depth: parents that do not exist, and a planted cycle (4, 40, 13) with all below it."""
    k = F.col("p_partkey")
    parent = F.when(k == 4, F.lit(40)).when(k % 50 == 49, -k).when(k >= 3, F.floor(k / 3).cast("long"))
    return load.hierarchy(table(spark, sf, "part").select(k.alias("id"), parent.alias("parent_id")))
