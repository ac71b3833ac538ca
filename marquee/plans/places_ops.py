"""Location operators on the driver tables: city inside the venue name,
state aliases after / inside the venue, venue isolation, typo repair."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import places, text
from marquee.operators import places as place_ops
from marquee.plans.registry import query
from marquee.plans.text_ops import _slug_sql
from marquee.sources.tables import table

_ALIASES = list(places.STATE_ALIASES.items())
_ALIAS_KEYS_SQL = "[" + ", ".join(f"'{k}'" for k, _ in _ALIASES) + "]"
_ALIAS_IDS_SQL = "[" + ", ".join(str(v) for _, v in _ALIASES) + "]"
_VENUE_ALIASES = [(a, c) for c, al in places.VENUE_TYPES.items() for a in al]
_CITY_TYPOS = [(w, r) for r, ws in places.CITY_TYPOS.items() for w in ws]


def _title_word_sql(e: str) -> str:
    return f"(upper({e}[1]) || lower({e}[2:]))"


def _title_words_sql(e: str) -> str:
    return f"array_to_string(list_transform(string_split({e}, ' '), lambda w: {_title_word_sql('w')}), ' ')"


def _lits(values):
    return F.array(*[F.lit(v) for v in values])


@query("q32_ngram_place", f"""
WITH loc AS (
  SELECT c.c_custkey,
         string_split({_title_word_sql('c.c_mktsegment')} || ' ' || n.n_name || ' ' || r.r_name || ' Arena', ' ') AS toks,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN (n.n_regionkey + 1) % 5 ELSE n.n_regionkey END AS st
  FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey),
s1 AS (SELECT *, unnest(generate_series(1, len(toks))) AS s FROM loc),
w AS (SELECT c_custkey, st, s, l, array_to_string(toks[s:s + l - 1], ' ') AS txt,
             {_slug_sql("array_to_string(toks[s:s + l - 1], ' ')")} AS slug
      FROM (SELECT *, unnest(generate_series(1, 3)) AS l FROM s1) WHERE s + l - 1 <= len(toks)),
cities AS (SELECT n_nationkey AS id, {_slug_sql('n_name')} AS slug, n_regionkey AS state_id FROM nation),
ex AS (SELECT c_custkey, id AS exact_id FROM (
         SELECT w.c_custkey, c.id, row_number() OVER (PARTITION BY w.c_custkey ORDER BY w.s DESC, w.l) AS rn
         FROM w JOIN cities c ON c.slug = w.slug AND c.state_id = w.st) WHERE rn = 1),
u AS (SELECT slug, min(id) AS id FROM cities GROUP BY slug HAVING count(*) = 1),
un AS (SELECT c_custkey, id AS unique_id FROM (
         SELECT w.c_custkey, u.id, row_number() OVER (PARTITION BY w.c_custkey ORDER BY w.s DESC, w.l) AS rn
         FROM w JOIN u ON u.slug = w.slug) WHERE rn = 1),
fz AS (SELECT w.c_custkey, min(c.id) AS fuzzy_id FROM w JOIN cities c ON c.state_id = w.st
       WHERE length(w.slug) > 7 AND abs(length(w.slug) - length(c.slug)) <= 2 AND levenshtein(w.slug, c.slug) <= 2
       GROUP BY w.c_custkey),
hint AS (SELECT c_custkey, txt AS city_hint FROM (
         SELECT w.c_custkey, w.txt, row_number() OVER (PARTITION BY w.c_custkey ORDER BY w.s DESC, w.l) AS rn
         FROM w WHERE w.slug IN (SELECT slug FROM cities)) WHERE rn = 1)
SELECT loc.c_custkey,
       CASE WHEN ex.exact_id IS NOT NULL THEN coalesce(un.unique_id, ex.exact_id)
            WHEN fz.fuzzy_id IS NOT NULL THEN fz.fuzzy_id ELSE un.unique_id END AS city_id,
       hint.city_hint
FROM loc LEFT JOIN ex ON ex.c_custkey = loc.c_custkey LEFT JOIN un ON un.c_custkey = loc.c_custkey
LEFT JOIN fz ON fz.c_custkey = loc.c_custkey LEFT JOIN hint ON hint.c_custkey = loc.c_custkey
""")
def q32_ngram_place(spark, sf):
    """City named inside the venue (1-3 token windows): exact (slug, state),
    fuzzy in state, unique-slug override, advisory name hint."""
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region").select("r_regionkey", "r_name")
    x = c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    loc = x.select("c_custkey",
                   F.split(F.concat_ws(" ", F.initcap("c_mktsegment"), "n_name", "r_name", F.lit("Arena")), " ")
                   .alias("toks"),
                   F.when(F.col("c_mktsegment") == "BUILDING", (F.col("n_regionkey") + 1) % 5)
                   .otherwise(F.col("n_regionkey")).alias("st"))
    cities = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), text.slugify("n_name").alias("slug"),
                                               F.col("n_regionkey").alias("state_id"))
    return place_ops.city_in_venue(loc, "c_custkey", "toks", "st", cities)


@query("q33_alias_lookup", f"""
SELECT c.c_custkey,
       {_ALIAS_IDS_SQL}[c.c_nationkey + 1] AS state_after,
       {_title_word_sql('c.c_mktsegment')} || ' Civic Center ' || {_title_word_sql('n.n_name')} AS venue_after,
       {_ALIAS_IDS_SQL}[c.c_nationkey + 1] AS state_in,
       {_title_word_sql('n.n_name')} || ' Civic Center' AS venue_in
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
""")
def q33_alias_lookup(spark, sf):
    """State alias after the venue-type word (``... Center Nation_3 Ala.``)
    and bracketed inside the venue (``Nation_3 (Ala.) Civic Center``)."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    alias = F.element_at(_lits([k for k, _ in _ALIASES]), F.col("c_nationkey") + 1)
    city = F.initcap("n_name")
    after = F.array(F.initcap("c_mktsegment"), F.lit("Civic"), F.lit("Center"), city,
                    F.concat(F.initcap(alias), F.lit(".")))
    inside = F.array(city, F.concat(F.lit("("), F.initcap(alias), F.lit(".)")), F.lit("Civic"), F.lit("Center"))
    a = places.state_after_venue(after)
    b = places.state_in_venue(inside)
    return c.select("c_custkey", a["state_id"].alias("state_after"),
                    F.array_join(a["tokens"], " ").alias("venue_after"),
                    b["state_id"].alias("state_in"), F.array_join(b["tokens"], " ").alias("venue_in"))


_VENUE_CANON = list(places.VENUE_TYPES)
_VENUE_CANON_SQL = "[" + ", ".join(f"'{v}'" for v in _VENUE_CANON) + "]"


@query("q34_name_isolation", f"""
SELECT p_partkey,
       {_title_words_sql('p_name')} || CASE WHEN p_size < 5 THEN ' univ' ELSE '' END || ' '
         || {_title_word_sql(f'{_VENUE_CANON_SQL}[p_size % {len(_VENUE_CANON)} + 1]')} AS venue_name,
       {_title_word_sql('p_type')} || ' City' AS city_candidate,
       p_size < 5 AS is_educational
FROM part
""")
def q34_name_isolation(spark, sf):
    """Venue name = tokens up to the last venue-type word; city candidate =
    the tokens after it; educational token check."""
    p = table(spark, sf, "part")
    vt = F.initcap(F.element_at(_lits(_VENUE_CANON), F.col("p_size") % len(_VENUE_CANON) + 1))
    toks = F.concat(F.split(F.initcap("p_name"), " "),
                    F.when(F.col("p_size") < 5, F.array(F.lit("univ"))).otherwise(F.array().cast("array<string>")),
                    F.array(vt, F.initcap("p_type"), F.lit("City")))
    return p.select("p_partkey", F.array_join(places.isolate_venue(toks), " ").alias("venue_name"),
                    places.city_candidate(toks).alias("city_candidate"),
                    places.looks_educational(toks).alias("is_educational"))


_VA_SQL = "[" + ", ".join(f"'{a}'" for a, _ in _VENUE_ALIASES) + "]"
_VC_SQL = "[" + ", ".join(f"'{c}'" for _, c in _VENUE_ALIASES) + "]"
_CW_SQL = "[" + ", ".join(f"'{w}'" for w, _ in _CITY_TYPOS) + "]"
_CR_SQL = "[" + ", ".join(f"'{r}'" for _, r in _CITY_TYPOS) + "]"


@query("q35_typo_fix", f"""
WITH x AS (SELECT p_partkey, p_name, p_brand,
                  {_VC_SQL}[p_size % {len(_VENUE_ALIASES)} + 1] AS vcanon,
                  {_CW_SQL}[p_partkey % {len(_CITY_TYPOS)} + 1] AS wrong,
                  {_CR_SQL}[p_partkey % {len(_CITY_TYPOS)} + 1] AS right_
           FROM part)
SELECT p_partkey,
       {_title_words_sql('p_name')} || ' ' || {_title_word_sql('vcanon')} || ' '
       || {_title_words_sql('right_')} AS location
FROM x
""")
def q35_typo_fix(spark, sf):
    """Location cleaning: noise words and URLs dropped, venue-type
    misspellings canonicalised, known city misspellings (of one and two words) repaired."""
    p = table(spark, sf, "part")
    va = F.element_at(_lits([a for a, _ in _VENUE_ALIASES]), F.col("p_size") % len(_VENUE_ALIASES) + 1)
    wrong = F.element_at(_lits([w for w, _ in _CITY_TYPOS]), (F.col("p_partkey") % len(_CITY_TYPOS) + 1).cast("int"))
    toks = F.concat(F.split(F.upper("p_name"), " "), F.array(F.lit("Prods."), F.initcap(va)),
                    F.array(F.concat(F.lit("www."), F.lower(F.replace("p_brand", F.lit("#"), F.lit(""))),
                                     F.lit(".com,"))),
                    F.split(F.initcap(wrong), " "))
    cleaned = places.correct_typos(places.clean_location(toks))
    return p.select("p_partkey", F.array_join(cleaned, " ").alias("location"))
