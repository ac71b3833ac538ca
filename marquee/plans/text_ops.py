"""Name and text operators on the driver tables: festival scoring, event
name split, title case, slugs, artist cell merging, candidate resolution,
promoter splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import names, text
from marquee.operators import artists
from marquee.plans.registry import query
from marquee.sources.tables import table


def _any_sql(expr: str, kws) -> str:
    return "(" + " OR ".join(f"contains({expr}, '{k}')" for k in kws) + ")"


STRONG, WEAK, TAGS = names.STRONG_EVENT_KEYWORDS, names.WEAK_EVENT_KEYWORDS, names.TAG_KEYWORDS

SCORE_SQL_EXPR = f"""
  (CASE WHEN {_any_sql('t', STRONG)} THEN {names.SCORE_STRONG} ELSE 0 END)
  + (CASE WHEN {_any_sql('t', TAGS)} AND regexp_matches(array_to_string(
        CASE WHEN tag_pos IS NOT NULL THEN lines[tag_pos:] ELSE lines[-1:] END, ' '), '[0-9]')
        THEN {names.SCORE_TAG} ELSE 0 END)
  + (CASE WHEN {_any_sql('t', WEAK)} THEN {names.SCORE_WEAK} ELSE 0 END)
  + (CASE WHEN contains(t, ':') THEN {names.SCORE_COLON} ELSE 0 END)
  + (CASE WHEN contains(CASE WHEN contains(t, ':') THEN split_part(t, ':', 1)
                        ELSE array_to_string(lines[1:coalesce(kw_pos, 0)], ' ') END, '''')
        THEN {names.SCORE_APOSTROPHE} ELSE 0 END)
  + (CASE WHEN contains(t, ',') THEN {names.SCORE_COMMA} ELSE 0 END)
"""

DOC_LINES_CTE = f"""
d AS (SELECT doc_id, string_split(text, chr(10)) AS lines, lower(replace(text, chr(10), '')) AS t
      FROM documents),
f AS (SELECT doc_id, lines, t,
             list_transform(lines, lambda l: lower(l)) AS low,
             list_position(list_transform(lines, lambda l: {_any_sql('lower(l)', TAGS)}), true) AS tag_pos,
             list_position(list_transform(lines, lambda l: {_any_sql('lower(l)', STRONG + WEAK)}), true) AS kw_pos
      FROM d)
"""

Q26_SQL = f"""
WITH {DOC_LINES_CTE}
SELECT doc_id, CAST({SCORE_SQL_EXPR} AS INTEGER) AS score,
       CAST({SCORE_SQL_EXPR} AS INTEGER) >= {names.EVENT_SCORE_THRESHOLD} AS is_special_event,
       CAST(coalesce(kw_pos, 0) - 1 AS INTEGER) AS event_end_line,
       CAST(coalesce(tag_pos, 0) - 1 AS INTEGER) AS tag_line
FROM f
"""


@query("q26_keyword_score", Q26_SQL)
def q26_keyword_score(spark, sf):
    """Festival score over every line of every document, the first keyword
    line (-1 = none) and the first tag line."""
    d = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    low = F.transform("lines", lambda l: F.lower(l))
    score = names.special_event_score("lines")
    kw_line = F.array_position(F.transform(low, lambda l: names.any_keyword(l, STRONG + WEAK)), True)
    tag_line = F.array_position(F.transform(low, lambda l: names.any_keyword(l, TAGS)), True)
    return d.select("doc_id", score.alias("score"),
                    (score >= names.EVENT_SCORE_THRESHOLD).alias("is_special_event"),
                    (kw_line - 1).cast("int").alias("event_end_line"),
                    (tag_line - 1).cast("int").alias("tag_line"))


def _title_sql(expr: str) -> str:
    t = (f"array_to_string(list_transform(regexp_extract_all(lower({expr}), '\\p{{L}}+|\\P{{L}}+'), "
         f"lambda p: upper(p[1]) || p[2:]), '')")
    for suf in ("St", "Nd", "Rd", "Th"):
        t = f"regexp_replace({t}, '\\b([0-9]+){suf}\\b', '\\1{suf.lower()}', 'g')"
    t = f"regexp_replace({t}, '([''’])S\\b', '\\1s', 'g')"
    for w in text.TITLE_SMALL_WORDS:
        t = f"regexp_replace({t}, '(\\s){w.title()}\\b', '\\1{w}', 'g')"
    return t


Q27_SQL = f"""
WITH {DOC_LINES_CTE},
g AS (SELECT *, CAST({SCORE_SQL_EXPR} AS INTEGER) AS score,
             list_transform(low, lambda l: {_any_sql('l', STRONG + WEAK)}) AS kw,
             list_transform(low, lambda l: contains(l, ':')) AS colon
      FROM f),
h AS (SELECT *, coalesce(list_position(kw, true), 0) AS k, coalesce(list_position(colon, true), 0) AS c FROM g),
s AS (SELECT *, list_min(list_filter(list_transform(generate_series(1, len(lines)), lambda i:
             CASE WHEN (kw[i] AND (c = 0 OR c <= i)) OR (NOT kw[i] AND colon[i] AND (k = 0 OR k < i)) THEN i END),
             lambda x: x IS NOT NULL)) AS stop
      FROM h),
n AS (SELECT *,
        CASE WHEN stop IS NULL THEN low
             ELSE list_append(low[1:stop - 1],
                              CASE WHEN contains(low[stop], ':') THEN trim(split_part(low[stop], ':', 1))
                                   ELSE low[stop] END) END AS parts,
        CASE WHEN stop IS NULL THEN []::VARCHAR[]
             ELSE (CASE WHEN contains(low[stop], ':')
                             AND trim(low[stop][strpos(low[stop], ':') + 1:]) <> ''
                        THEN [trim(low[stop][strpos(low[stop], ':') + 1:])] ELSE []::VARCHAR[] END)
                  || lines[stop + 1:] END AS artists
      FROM s)
SELECT doc_id,
       CASE WHEN score >= {names.EVENT_SCORE_THRESHOLD} THEN {_title_sql("array_to_string(parts, ' ')")} END
         AS event_name,
       CAST(CASE WHEN score >= {names.EVENT_SCORE_THRESHOLD} THEN len(artists) ELSE len(lines) END AS BIGINT)
         AS n_artist_lines
FROM n
"""


@query("q27_name_split", Q27_SQL)
def q27_name_split(spark, sf):
    """Special-event name split: name lines up to the line completing the
    keyword/colon signals, the rest are artist lines (whole documents)."""
    d = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    r = names.event_names(d, "lines", "r")
    return r.select("doc_id", F.col("r.event_name").alias("event_name"),
                    F.size("r.artists").cast("bigint").alias("n_artist_lines"))


@query("q28_title_case", f"""
SELECT p_partkey,
       {_title_sql("p_name || ' of the ' || p_type || ' ' || CAST(p_size AS VARCHAR) || 'th o''neil''s'")} AS title
FROM part
""")
def q28_title_case(spark, sf):
    """Title case with ordinal, possessive and small-word fixes."""
    p = table(spark, sf, "part")
    s = F.concat_ws(" ", "p_name", F.lit("of the"), "p_type", F.concat(F.col("p_size").cast("string"), F.lit("th")),
                    F.lit("o'neil's"))
    return p.select("p_partkey", text.event_title(s).alias("title"))


def _slug_sql(expr: str) -> str:
    s = f"lower(regexp_replace({expr}, '''+', '-', 'g'))"
    s = f"regexp_replace({s}, '[^-a-z0-9]+', '-', 'g')"
    s = f"regexp_replace({s}, '-{{2,}}', '-', 'g')"
    return f"regexp_replace({s}, '^-+|-+$', '', 'g')"


# Names beyond ASCII and how they are written in ASCII: stroke and dotless letters, carons, cedillas, ligatures, eszett, decomposed marks.
ACCENTED_NAMES = {"Dvořák": "Dvorak", "Łódź": "Lodz", "Şebnem": "Sebnem", "Đorđe": "Dorde", "Ísland": "Island", "Straße": "Strasse",
                  "Þór": "Thor", "Œuvre": "Oeuvre", "Ősi": "Osi", "Iğdır": "Igdir", "Håkon Ærø": "Hakon AEro", "Zoe\u0308": "Zoe"}
_PLAIN_SQL = "[" + ", ".join(f"'{v}'" for v in ACCENTED_NAMES.values()) + "]"


@query("q29_slug", f"""
SELECT 'part' AS kind, p_partkey AS id, {_slug_sql("p_name || ' ' || p_brand || ' RJ''s'")} AS slug FROM part
UNION ALL
SELECT 'page' AS kind, page_id AS id, {_slug_sql('url')} AS slug FROM pages
UNION ALL
SELECT 'accented' AS kind, p_partkey AS id, {_slug_sql(f"{_PLAIN_SQL}[p_partkey % {len(ACCENTED_NAMES)} + 1] || ' ' || p_name")} AS slug FROM part
""")
def q29_slug(spark, sf):
    """Slug keys for names and URLs."""
    p = table(spark, sf, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"),
                                        text.slugify(F.concat_ws(" ", "p_name", "p_brand", F.lit("RJ's"))).alias("slug"))
    g = table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"),
                                         text.slugify("url").alias("slug"))
    names_ = F.array(*[F.lit(n) for n in ACCENTED_NAMES])
    accented = table(spark, sf, "part").select(
        F.lit("accented").alias("kind"), F.col("p_partkey").alias("id"),
        text.slugify(F.concat_ws(" ", F.element_at(names_, (F.col("p_partkey") % len(ACCENTED_NAMES) + 1).cast("int")), "p_name")).alias("slug"))
    return p.unionByName(g).unionByName(accented)


@query("q30_merge_split", """
SELECT l.l_orderkey,
       string_agg(upper(p.p_name) || ' & THE ' || upper(p.p_brand), '; '
                  ORDER BY l.l_linenumber, upper(p.p_name) || ' & THE ' || upper(p.p_brand)) AS artists,
       CAST(count(*) AS BIGINT) AS n_artists,
       arg_min(upper(p.p_name) || ' & THE ' || upper(p.p_brand),
               [l.l_linenumber::VARCHAR, upper(p.p_name) || ' & THE ' || upper(p.p_brand)]) AS first_artist
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
GROUP BY l.l_orderkey
""")
def q30_merge_split(spark, sf):
    """Artist cells that overflow (``KOOL &`` + ``THE GANG``, ``... & THE`` +
    ``BRAND#2,``) are merged and cleaned back into one name per artist."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    nm, br = F.upper("p_name"), F.upper("p_brand")
    cells = (F.when(F.col("l_returnflag") == "R", F.array(F.concat(nm, F.lit(" &")), F.concat(F.lit("THE "), br)))
             .when(F.col("l_returnflag") == "A", F.array(F.concat(nm, F.lit(" & THE")), F.concat(br, F.lit(","))))
             .otherwise(F.array(F.concat(nm, F.lit(" & THE "), br, F.lit(".")))))
    per_order = (li.groupBy("l_orderkey")
                 .agg(F.array_sort(F.collect_list(F.struct(
                     "l_linenumber", F.concat_ws(" & THE ", nm, br).alias("k"), cells.alias("cells")))).alias("c"))
                 .select("l_orderkey", F.flatten(F.transform("c", lambda s: s["cells"])).alias("cells")))
    artists = names.split_artist_cells("cells", F.lit(False))
    return per_order.select("l_orderkey", F.array_join(artists, "; ").alias("artists"),
                            F.size(artists).cast("bigint").alias("n_artists"),
                            F.get(artists, 0).alias("first_artist"))


Q31_SQL = f"""
WITH dim AS (SELECT DISTINCT slug FROM (SELECT {_slug_sql('p_name')} AS slug FROM part) WHERE md5(slug) < '4'),
x AS (SELECT l.l_orderkey, l.l_linenumber, upper(a.p_name) || '/' || upper(b.p_name) AS s,
             upper(a.p_name) AS lft, upper(b.p_name) AS rgt
      FROM lineitem l JOIN part a ON a.p_partkey = l.l_partkey JOIN part b ON b.p_partkey = l.l_suppkey)
SELECT l_orderkey, l_linenumber,
       CASE WHEN {_slug_sql('s')} IN (SELECT slug FROM dim) THEN s
            WHEN {_slug_sql("replace(s, '/', ' ')")} IN (SELECT slug FROM dim) THEN replace(s, '/', ' ')
            WHEN {_slug_sql('lft')} IN (SELECT slug FROM dim) THEN lft
            WHEN {_slug_sql('rgt')} IN (SELECT slug FROM dim) THEN rgt
            ELSE s END AS artist
FROM x
"""


@query("q31_candidates", Q31_SQL)
def q31_candidates(spark, sf):
    """Candidate resolution: a ``LEFT/RIGHT`` cell resolves to the first
    candidate (itself, without delimiter, left, right) that is a known
    artist; known are the part names whose slug's md5 is below 4 (that others are not is the feature)."""
    part = table(spark, sf, "part")
    dim = part.select(text.slugify("p_name").alias("slug")).distinct().filter(F.md5(F.col("slug").cast("binary")) < "4")
    a = part.select(F.col("p_partkey").alias("_ak"), F.upper("p_name").alias("_an"))
    b = part.select(F.col("p_partkey").alias("_bk"), F.upper("p_name").alias("_bn"))
    x = (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
         .join(a, F.col("l_partkey") == F.col("_ak")).join(b, F.col("l_suppkey") == F.col("_bk"))
         .select("l_orderkey", "l_linenumber", F.concat_ws("/", "_an", "_bn").alias("s")))
    # resolve each distinct cell text once, then join back to the rows
    resolved = artists.resolve_names(x.select("s").distinct(), "s", dim)
    return x.join(resolved, "s", "left").select("l_orderkey", "l_linenumber", F.col("resolved").alias("artist"))


@query("q36_multi_owner_split", """
SELECT l.l_orderkey, l.l_linenumber,
       upper(p.p_name) || ' Prods.' || '; ' ||
       CASE WHEN o.o_orderstatus = 'P' THEN c.c_name ELSE 'Cellar Door' END AS promoters
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
JOIN orders o ON o.o_orderkey = l.l_orderkey JOIN customer c ON c.c_custkey = o.o_custkey
""")
def q36_multi_owner_split(spark, sf):
    """Promoter cells split on ``/``; tokens with digits or ``$`` dropped;
    ``In-House`` becomes the venue name."""
    li = (table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
          .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
          .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")))
    cells = F.array(F.concat(F.upper("p_name"), F.lit(" Prods./")),
                    F.when(F.col("o_orderstatus") == "P", F.lit("In-House $15"))
                    .otherwise(F.concat(F.lit("Cellar Door "), F.col("l_linenumber").cast("string"))))
    return li.select("l_orderkey", "l_linenumber",
                     F.array_join(names.split_promoters(cells, F.col("c_name")), "; ").alias("promoters"))
