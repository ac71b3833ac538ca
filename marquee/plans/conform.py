"""Dimension conforming on the driver tables: new members with ids, name ->
id, composite-key n-gram match, unique-only match, blocked fuzzy match,
best-match priority pick, exclusion anti join, snowflake chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import places, text
from marquee.operators import conform
from marquee.plans.registry import query
from marquee.plans.text_ops import _slug_sql
from marquee.sources.tables import table

# --- fixed values -----------------------------------------------------------
# Month words for nearest-month repair.
MONTH_WORDS = ["january", "february", "march", "april", "may", "june", "july", "august", "september",
               "october", "november", "december"]


def known_members(parts, below: str):
    """A dimension that lacks some names, the feature of the queries on new and missing members: (slug, id, name) of the
    part names whose slug's md5 is below ``below`` (hexadecimal); the id is the smallest part key per slug."""
    slugs = parts.select(text.slugify("p_name").alias("slug"), F.col("p_name").alias("name"), F.col("p_partkey").alias("id"))
    return slugs.filter(F.md5(F.col("slug").cast("binary")) < below).groupBy("slug").agg(F.min("id").alias("id"), F.min_by("name", "id").alias("name"))


def known_members_sql(below: str) -> str:
    return f"(SELECT slug, min(id) AS id FROM (SELECT {_slug_sql('p_name')} AS slug, p_partkey AS id FROM part) WHERE md5(slug) < '{below}' GROUP BY slug)"


@query("q05_conform_new_members", f"""
WITH dim AS {known_members_sql('4')},
cand AS (SELECT {_slug_sql('p.p_name')} AS slug, min(p.p_name) AS name
         FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey GROUP BY 1)
SELECT slug, name, CAST((SELECT max(id) FROM dim) + row_number() OVER (ORDER BY slug) AS BIGINT) AS id
FROM cand WHERE slug NOT IN (SELECT slug FROM dim)
""")
def q05_conform_new_members(spark, sf):
    """Names sold but not yet in the artist dimension get ids after max(id),
    in slug order (anti join + scalable dense ids)."""
    dim = known_members(table(spark, sf, "part"), "4")
    sold = (table(spark, sf, "lineitem").select("l_partkey")
            .join(table(spark, sf, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")))
    return conform.add_members(dim, sold, "p_name", text.slugify).select("slug", "name", "id")


@query("q06_name_to_id", f"""
WITH seg AS (SELECT slug, CAST(row_number() OVER (ORDER BY slug) AS BIGINT) AS id
             FROM (SELECT DISTINCT {_slug_sql('c_mktsegment')} AS slug FROM customer))
SELECT c.c_custkey, coalesce(n.n_name, '') AS nation_name, seg.id AS segment_id, n.n_name IS NULL AS is_orphan
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN seg ON seg.slug = {_slug_sql('c.c_mktsegment')}
""")
def q06_name_to_id(spark, sf):
    """id -> name (null-safe, empty when missing) and name -> slug -> id."""
    c = table(spark, sf, "customer")
    seg = conform.dense_ids(c.select(text.slugify("c_mktsegment").alias("slug")).distinct(), "slug", 0)
    nat = table(spark, sf, "nation").select("n_nationkey", "n_name")
    out = conform.resolve_exact(c.withColumn("_slug", text.slugify("c_mktsegment")), seg,
                                {"_slug": "slug"}, {"id": "segment_id"})
    out = out.join(nat, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.select("c_custkey", F.coalesce("n_name", F.lit("")).alias("nation_name"), "segment_id",
                      F.col("n_name").isNull().alias("is_orphan"))


def _customer_locations(spark, sf):
    """Location cells per customer: ``<Segment> Arena NATION_n REGION``; the
    'state' is the nation's region, shifted for BUILDING (no exact city)."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    x = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    state = F.when(F.col("c_mktsegment") == "BUILDING", (F.col("n_regionkey") + 1) % 5).otherwise(F.col("n_regionkey"))
    toks = F.split(F.concat_ws(" ", F.initcap("c_mktsegment"), F.lit("Arena"), "n_name", "r_name"), " ")
    return x.select("c_custkey", toks.alias("tokens"), state.alias("state_id"))


@query("q07_composite_key", f"""
WITH loc AS (
  SELECT c.c_custkey, string_split(concat_ws(' ', upper(c.c_mktsegment[1]) || lower(c.c_mktsegment[2:]), 'Arena',
                                             n.n_name, r.r_name), ' ') AS toks,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN (n.n_regionkey + 1) % 5 ELSE n.n_regionkey END AS state_id
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey),
post AS (SELECT c_custkey, state_id, list_position(toks, 'Arena') AS v, toks[list_position(toks, 'Arena') + 1:] AS p
         FROM loc),
s1 AS (SELECT *, unnest(generate_series(1, len(p))) AS s FROM post),
g AS (SELECT *, unnest(generate_series(1, len(p) - s + 1)) AS l FROM s1),
m AS (SELECT g.c_custkey, n.n_nationkey AS city_id, g.s, g.l, g.v
      FROM g JOIN nation n ON {_slug_sql('n.n_name')} = {_slug_sql("array_to_string(g.p[g.s:g.s + g.l - 1], ' ')")}
                          AND n.n_regionkey = g.state_id),
b AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY s, l DESC) AS rn FROM m)
SELECT c.c_custkey, b.city_id, CAST(b.s - 1 + b.v AS INTEGER) AS city_index
FROM customer c LEFT JOIN b ON b.c_custkey = c.c_custkey AND b.rn = 1
""")
def q07_composite_key(spark, sf):
    """City after the venue word by composite key (slug, state): n-grams of
    the tail, earliest start first, longest first."""
    loc = _customer_locations(spark, sf)
    v = places.first_venue_type_pos("tokens")
    post = loc.select("c_custkey", "state_id", v.alias("v"),
                      F.slice("tokens", v + 1, F.greatest(F.size("tokens") - v, F.lit(0))).alias("p"))
    g = post.select("c_custkey", "state_id", "v", F.explode(places.ngrams("p")).alias("g"))
    g = g.select("c_custkey", "state_id", "v", "g.start", "g.len", text.slugify("g.text").alias("slug"))
    cities = table(spark, sf, "nation").select(text.slugify("n_name").alias("slug"),
                                               F.col("n_regionkey").alias("state_id"),
                                               F.col("n_nationkey").alias("city_id"))
    m = g.join(cities, ["slug", "state_id"])
    best = conform.pick_first(m, ["c_custkey"], ["start", ("len", "desc")])
    best = best.select("c_custkey", "city_id", (F.col("start") - 1 + F.col("v")).cast("int").alias("city_index"))
    return table(spark, sf, "customer").select("c_custkey").join(best, "c_custkey", "left")


@query("q08_unique_only", f"""
WITH d AS (SELECT p_partkey, {_slug_sql("p_brand || ' ' || p_name")} AS slug FROM part),
u AS (SELECT slug, min(p_partkey) AS id FROM d GROUP BY slug HAVING count(*) = 1)
SELECT d.p_partkey, u.id AS unique_id FROM d LEFT JOIN u ON u.slug = d.slug
""")
def q08_unique_only(spark, sf):
    """Match only names that identify exactly one member."""
    d = table(spark, sf, "part").select("p_partkey", text.slugify(F.concat_ws(" ", "p_brand", "p_name")).alias("slug"))
    return conform.resolve_unique(d, "slug", d.withColumnRenamed("p_partkey", "id"), "slug", "id", "unique_id").select(
        "p_partkey", "unique_id")


@query("q09_fuzzy_block", """
WITH probe AS (SELECT p_partkey, p_brand, replace(p_name, 'e', 'a') AS typo FROM part),
dim AS (SELECT DISTINCT p_brand, p_name FROM part),
m AS (SELECT probe.p_partkey, dim.p_name, levenshtein(probe.typo, dim.p_name) AS dist
      FROM probe JOIN dim ON dim.p_brand = probe.p_brand
      WHERE length(dim.p_name) >= 5 AND abs(length(dim.p_name) - length(probe.typo)) <= 2
        AND levenshtein(probe.typo, dim.p_name) <= 2),
b AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY dist, p_name) AS rn FROM m)
SELECT p_partkey, p_name AS matched_name, CAST(dist AS INTEGER) AS dist FROM b WHERE rn = 1
""")
def q09_fuzzy_block(spark, sf):
    """Fuzzy match inside a block (same brand): names of >= 5 chars within 2
    edits; closest wins, then the smallest name."""
    part = table(spark, sf, "part")
    probe = part.select("p_partkey", F.col("p_brand").alias("brand"),
                        F.replace("p_name", F.lit("e"), F.lit("a")).alias("typo"))
    dim = part.select("p_brand", "p_name").distinct()
    m = conform.fuzzy_candidates(probe, "typo", ["brand"], dim, "p_name", ["p_brand"], max_dist=2, min_len=5,
                                 keep=["p_name"])
    best = conform.pick_first(m, ["p_partkey"], ["_dist", "p_name"])
    return best.select("p_partkey", F.col("p_name").alias("matched_name"), F.col("_dist").cast("int").alias("dist"))


_MONTHS_SQL = "(VALUES " + ", ".join(f"({i + 1}, '{m}')" for i, m in enumerate(MONTH_WORDS)) + ") AS mw(m, w)"


@query("q10_best_match", f"""
WITH probe AS (
  SELECT l.l_orderkey, l.l_linenumber, s.s_nationkey AS city,
         CASE WHEN l.l_returnflag = 'R' THEN replace(s.s_name, '#', 'H') ELSE s.s_name END AS venue_text,
         CASE WHEN l.l_linestatus = 'O' THEN substr(lower(monthname(l.l_shipdate)), 2)
              ELSE lower(monthname(l.l_shipdate)) END AS month_text
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey),
keys AS (SELECT DISTINCT venue_text, city FROM probe),
exact AS (SELECT p.venue_text, p.city, v.s_suppkey AS id, 0 AS dist
          FROM keys p JOIN supplier v ON {_slug_sql('v.s_name')} = {_slug_sql('p.venue_text')}),
fuzzy AS (SELECT p.venue_text, p.city, v.s_suppkey AS id, levenshtein(v.s_name, p.venue_text) AS dist
          FROM keys p JOIN supplier v ON v.s_nationkey = p.city
          WHERE length(p.venue_text) > 7 AND levenshtein(v.s_name, p.venue_text) <= 2),
cand AS (SELECT * FROM exact UNION ALL SELECT * FROM fuzzy),
best AS (SELECT venue_text, city, id, dist, row_number() OVER (PARTITION BY venue_text, city ORDER BY dist, id) AS rn
         FROM cand),
mon AS (SELECT p.month_text, mw.m, levenshtein(p.month_text, mw.w) AS d,
               row_number() OVER (PARTITION BY p.month_text ORDER BY levenshtein(p.month_text, mw.w), mw.m) AS rn
        FROM (SELECT DISTINCT month_text FROM probe) p, {_MONTHS_SQL})
SELECT p.l_orderkey, p.l_linenumber, b.id AS venue_id,
       CASE WHEN mo.d <= 1 THEN mo.m END AS month_no
FROM probe p
LEFT JOIN best b ON b.venue_text = p.venue_text AND b.city = p.city AND b.rn = 1
LEFT JOIN mon mo ON mo.month_text = p.month_text AND mo.rn = 1
""")
def q10_best_match(spark, sf):
    """Venue resolution: exact slug first, else fuzzy among the venues of
    the same city (> 7 chars, <= 2 edits), closest then lowest id; month
    word repair to the nearest month within one edit (12-row table)."""
    sup = table(spark, sf, "supplier")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_returnflag",
                                             "l_linestatus", "l_shipdate")
    probe = li.join(sup.select("s_suppkey", "s_name", F.col("s_nationkey").alias("city")),
                    F.col("l_suppkey") == F.col("s_suppkey"))
    mname = F.lower(F.date_format("l_shipdate", "MMMM"))
    probe = probe.select("l_orderkey", "l_linenumber", "city",
                         F.when(F.col("l_returnflag") == "R", F.replace("s_name", F.lit("#"), F.lit("H")))
                         .otherwise(F.col("s_name")).alias("venue_text"),
                         F.when(F.col("l_linestatus") == "O", F.substring(mname, 2, 100)).otherwise(mname)
                         .alias("month_text"))
    # resolve each distinct (text, city) once, then join back
    keys = probe.select("venue_text", "city").distinct()
    venues = sup.select(F.col("s_suppkey").alias("id"), "s_name", "s_nationkey",
                        text.slugify("s_name").alias("vslug"))
    exact = (keys.join(venues, text.slugify("venue_text") == F.col("vslug"))
             .select("venue_text", "city", "id", F.lit(0).alias("_dist")))
    fuzzy = conform.fuzzy_candidates(keys.filter(F.length("venue_text") > 7), "venue_text", ["city"], venues,
                                     "s_name", ["s_nationkey"], max_dist=2, keep=["id"]).select(
        "venue_text", "city", "id", "_dist")
    best = conform.pick_first(exact.unionByName(fuzzy), ["venue_text", "city"], ["_dist", "id"])
    months = spark.createDataFrame([(i + 1, w) for i, w in enumerate(MONTH_WORDS)], "m int, w string")
    mkeys = probe.select("month_text").distinct()
    mon = (mkeys.crossJoin(F.broadcast(months))      # fixed 12-row table
           .withColumn("d", F.levenshtein("month_text", "w"))
           .groupBy("month_text").agg(F.min_by("m", F.struct("d", "m")).alias("m"), F.min("d").alias("d")))
    out = (probe.join(best.select("venue_text", "city", F.col("id").alias("venue_id")), ["venue_text", "city"], "left")
           .join(mon, "month_text", "left"))
    return out.select("l_orderkey", "l_linenumber", "venue_id",
                      F.when(F.col("d") <= 1, F.col("m")).alias("month_no"))


@query("q11_exclusion", """
SELECT d.doc_id, d.source FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)
""")
def q11_exclusion(spark, sf):
    """Exclusion list as a left anti join (flagged rows removed)."""
    ex = table(spark, sf, "labels").filter(F.col("toxic") == 1).select("doc_id")
    return table(spark, sf, "documents").select("doc_id", "source").join(ex, "doc_id", "left_anti")


@query("q39_snowflake", """
SELECT c.c_custkey, coalesce(n.n_nationkey, -1) AS city_id, coalesce(n.n_name, 'Unknown') AS city_name,
       coalesce(r.r_regionkey, -1) AS state_id, coalesce(r.r_name, 'Unknown') AS state_name
FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def q39_snowflake(spark, sf):
    """venue -> city -> state chain with the -1 'Unknown' member for gaps."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    x = (c.join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left")
         .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left"))
    return x.select("c_custkey", F.coalesce("n_nationkey", F.lit(-1)).alias("city_id"),
                    F.coalesce("n_name", F.lit("Unknown")).alias("city_name"),
                    F.coalesce("r_regionkey", F.lit(-1)).alias("state_id"),
                    F.coalesce("r_name", F.lit("Unknown")).alias("state_name"))
