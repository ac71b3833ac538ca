"""Text -> record operators on the driver tables: box-score event strings,
two-layout report lines, number words, symbol cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import numbers, text
from marquee.operators import records
from marquee.plans.curation import PRINTED_MONTHS
from marquee.plans.registry import query
from marquee.sources.tables import table

_NUM_WORDS = list(numbers.NUMBER_WORDS)   # index = value for 0..20
_NUM_WORDS_SQL = "[" + ", ".join(f"'{w}'" for w in _NUM_WORDS[:21]) + "]"
_MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in PRINTED_MONTHS) + "]"
# How text recognition misreads the twelve months in every fourth line of the event queries.
_MISREAD = ["Jqn.", "Feh.", "Marn", "Aprl", "May", "dune", "duly", "Augg.", "Seph.", "Ooet.", "Now.", "Deo."]
_MISREAD_SQL = "[" + ", ".join(f"'{m}'" for m in _MISREAD) + "]"

# The fields of an event string from l, p, o, c and r: every rule of the grammar is in some of the lines.
_EVENT_SQL = f"""
       upper(p.p_name) || '; ' || upper(p.p_type) AS artists,
       upper(c.c_mktsegment[1]) || lower(c.c_mktsegment[2:]) || ' Arena; '
         || array_to_string(list_transform(string_split(lower(r.r_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ')
         AS location,
       CASE WHEN l.l_linenumber = 4 THEN {_MISREAD_SQL}[month(o.o_orderdate)] ELSE {_MONTHS_SQL}[month(o.o_orderdate)] END || ' '
         || CASE WHEN l.l_linenumber = 5 AND day(o.o_orderdate) BETWEEN 10 AND 19 THEN 'l' || (day(o.o_orderdate) - 10) ELSE CAST(day(o.o_orderdate) AS VARCHAR) END AS dates,
       CAST(floor(o.o_totalprice) AS BIGINT) AS gross_receipts_us,
       CASE WHEN l.l_linenumber = 3 AND l.l_returnflag = 'A' THEN CAST(floor(o.o_totalprice) AS BIGINT) + 1000 END AS gross_receipts_canadian,
       CAST(l.l_quantity * 100 AS BIGINT) AS attendance,
       CASE WHEN l.l_returnflag = 'R' THEN NULL ELSE CAST(l.l_quantity * 100 AS BIGINT) + 500 END AS capacity,
       CASE WHEN l.l_linestatus = 'O' THEN CAST(l.l_linenumber + CASE l.l_linenumber WHEN 7 THEN 20 WHEN 4 THEN 2100 ELSE 0 END AS BIGINT) END AS num_shows,
       CASE WHEN l.l_linestatus <> 'O' THEN CAST(l.l_linenumber + CASE l.l_linenumber WHEN 7 THEN 20 WHEN 4 THEN 2100 ELSE 0 END AS BIGINT) END AS num_sellouts,
       CASE WHEN l.l_linenumber = 2 THEN 'Cellar Door Prods.; K101 Concerts' ELSE 'Cellar Door Prods.' END AS promoter,
       CASE WHEN l.l_linenumber = 6 THEN p.p_size || ' & $16.50' ELSE p.p_size || '/' || (l.l_linenumber + 10) END AS ticket_prices"""


def _event_strings(spark, sf):
    # the patterns take far more time than the bytes suggest by which files are split and partitions put together:
    # several even tasks per core, by the key that the joins and the pages need anyway
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                             "l_returnflag", "l_linestatus").repartition(tasks, "l_orderkey")
    x = (li.join(table(spark, sf, "part").select("p_partkey", "p_name", "p_type", "p_size"),
                 F.col("l_partkey") == F.col("p_partkey"))
         .join(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"),
               F.col("l_orderkey") == F.col("o_orderkey"))
         .join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey"),
               F.col("o_custkey") == F.col("c_custkey"))
         .join(table(spark, sf, "nation").select("n_nationkey", "n_regionkey"),
               F.col("c_nationkey") == F.col("n_nationkey"))
         .join(table(spark, sf, "region").select("r_regionkey", "r_name"),
               F.col("n_regionkey") == F.col("r_regionkey")))
    att = (F.col("l_quantity") * 100).cast("bigint")
    cap = F.when(F.col("l_returnflag") == "R", att - 50).otherwise(att + 500)
    n, of = F.col("l_linenumber"), lambda words, at: F.element_at(F.array(*[F.lit(w) for w in words]), at)
    month = F.when(n == 4, of(_MISREAD, F.month("o_orderdate"))).otherwise(of(PRINTED_MONTHS, F.month("o_orderdate")))
    day = F.dayofmonth("o_orderdate")
    day = F.when((n == 5) & day.between(10, 19), F.concat(F.lit("l"), day - 10)).otherwise(day.cast("string"))
    word = F.when(n == 7, "twenty-seven").when(n == 4, "two thousand one hundred and four").otherwise(of(_NUM_WORDS, n + 1))
    price = F.when(n == 6, F.format_string("$%d & $16.50", "p_size")).otherwise(F.format_string("$%d/$%d", F.col("p_size"), n + 10))
    canadian = F.when((n == 3) & (F.col("l_returnflag") == "A"), F.format_string("($%,d Canadian)", F.floor("o_totalprice") + 1000))
    count = F.when(F.col("l_linestatus") == "O", F.concat_ws(" ", word, F.lit("shows"))).when(n == 1, "sellout").otherwise(F.concat_ws(" ", word, F.lit("sellouts")))
    s = F.concat_ws(" ", F.upper("p_name"), F.initcap("c_mktsegment"), F.lit("Arena"), month, day,
                    F.concat(F.lit("$"), F.format_string("%,d", F.floor("o_totalprice"))),
                    F.format_string("%,d", att), F.lit("Cellar Door Prods. |"), F.upper("p_type"),
                    F.initcap("r_name"), price, canadian, F.format_string("(%,d) |", cap), count,
                    F.when(n == 2, F.lit("| K101 Concerts")))
    return x.select("l_orderkey", "l_linenumber", s.alias("event_text"), F.struct("l_linenumber", "l_partkey", "l_quantity").alias("at"))


@query("q41_event_records", f"""
SELECT l.l_orderkey, l.l_linenumber, {_EVENT_SQL}
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def q41_event_records(spark, sf):
    """Box-score event strings -> processed-event records: misread months and
    days, Canadian gross, joined prices, counts in words, a lone sellout,
    promoters that go on in the next line."""
    ev = records.parse_events(_event_strings(spark, sf), "event_text")
    e = F.col("event")
    return ev.select("l_orderkey", "l_linenumber",
                     F.array_join(e["artists"], "; ").alias("artists"),
                     F.array_join(e["location"], "; ").alias("location"),
                     F.array_join(e["dates"], "; ").alias("dates"),
                     e["gross_receipts_us"].cast("bigint").alias("gross_receipts_us"),
                     e["gross_receipts_canadian"].cast("bigint").alias("gross_receipts_canadian"),
                     e["attendance"].cast("bigint").alias("attendance"),
                     e["capacity"].cast("bigint").alias("capacity"),
                     e["num_shows"].cast("bigint").alias("num_shows"),
                     e["num_sellouts"].cast("bigint").alias("num_sellouts"),
                     F.array_join(e["promoter"], "; ").alias("promoter"),
                     F.array_join(e["ticket_prices"], "; ").alias("ticket_prices"))


_EVENT_FIELDS = ["artists", "location", "dates", "gross_receipts_us", "gross_receipts_canadian", "attendance", "capacity", "num_shows", "num_sellouts",
                 "promoter", "ticket_prices"]


@query("q48_page_records", f"""
WITH e AS (
  SELECT l.l_orderkey, l.l_linenumber, o.o_orderstatus AS st, l.l_orderkey % 5 = 0 AS noted,
         row_number() OVER (PARTITION BY l.l_orderkey ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity) - 1 AS event_no,
{_EVENT_SQL}
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey)
SELECT l_orderkey, CAST(event_no AS INTEGER) AS event_no, CAST(NULL AS VARCHAR) AS reason, {", ".join(_EVENT_FIELDS)} FROM e WHERE st <> 'P'
UNION ALL
SELECT l_orderkey, CAST(count(*) AS INTEGER), 'before the first event', {", ".join("NULL" for _ in _EVENT_FIELDS)} FROM e WHERE st <> 'P' AND noted GROUP BY l_orderkey
UNION ALL
SELECT DISTINCT l_orderkey, 0, 'no section', {", ".join("NULL" for _ in _EVENT_FIELDS)} FROM e WHERE st = 'P'
""")
def q48_page_records(spark, sf):
    """Whole pages (one per order) -> section -> events -> records: other
    matter around the section, a stray line in front of the first event on
    some pages, pages without the section; every line a record or a reason."""
    ev = _event_strings(spark, sf)
    body = F.replace(F.array_join(F.sort_array(F.collect_list(F.struct("at", "event_text")))["event_text"], "\n"), F.lit(" | "), F.lit("\n"))
    pages = ev.groupBy("l_orderkey").agg(body.alias("body")) \
        .join(table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus"), "l_orderkey")
    head = F.when(F.col("o_orderstatus") == "P", F.lit("TOP ALBUMS")).otherwise(F.lit(records.SECTION_HEADER))
    note = F.when(F.col("l_orderkey") % 5 == 0, F.lit("continued from page 3"))
    page = F.concat_ws("\n", F.lit("BILLBOARD NOVEMBER 24, 1984"), head, note, F.col("body"),
                       F.lit("Copyrighted and compiled by the chart department"), F.lit("AN ADVERTISEMENT Hall Nov. 3 $1 1 X"))
    got = records.extract_events(pages.select("l_orderkey", page.alias("page")), ["l_orderkey"], "page")
    e = F.col("event")
    text_of = lambda f: F.array_join(e[f], "; ") if f in ("artists", "location", "dates", "promoter", "ticket_prices") else e[f].cast("bigint")
    return got.select("l_orderkey", "event_no", "reason", *[text_of(f).alias(f) for f in _EVENT_FIELDS])


@query("q54_rank_continuity", """
WITH x AS (
  SELECT l.l_orderkey, l.l_returnflag AS f, upper(p.p_name) AS name, l.l_partkey AS pk, l.l_linestatus AS st,
         row_number() OVER (PARTITION BY l.l_orderkey, l.l_linestatus ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity) AS k
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)
SELECT l_orderkey, CASE WHEN st = 'O' THEN 'Arena' ELSE 'Auditorium' END AS section, CAST(k AS INTEGER) AS rank,
       k || ' | ' || name || ' AND SUPPORT overflow of ' || pk || CASE WHEN f = 'A' THEN ' ' || (k + 300) || ' | is not the next rank' ELSE '' END AS line
FROM x
""")
def q54_rank_continuity(spark, sf):
    """Tours of ranked sections (one page per order): misread ranks put right,
    overflow and out-of-order lines joined to the tour before them."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    t = lambda c: c.cast("string")

    def section(status: str, head: str):
        rows = F.sort_array(F.collect_list(F.when(F.col("l_linestatus") == status, F.struct("l_linenumber", "l_partkey", "l_quantity", "l_returnflag", "p_name"))))
        def tour(s, i):
            k = i + 1
            rank = F.when(s["l_returnflag"] == "R", F.concat(F.lit("7"), t(k))).when(s["l_partkey"] % 4 == 0, F.concat(F.lit("*"), t(k), F.lit("1"))).otherwise(t(k))
            return F.array_join(F.array_compact(F.array(
                F.concat(rank, F.lit(" | "), F.upper(s["p_name"]), F.lit(" AND SUPPORT")), F.concat(F.lit("overflow of "), t(s["l_partkey"])),
                F.when(s["l_returnflag"] == "A", F.concat(t(k + 300), F.lit(" | is not the next rank"))))), "\n")
        return F.concat_ws("\n", F.lit(head), F.array_join(F.transform(rows, tour), "\n"))

    arenas, halls = section("O", "Arenas (6,000 To 20,000)"), section("F", "Auditoriums (Under 6,000)")
    pages = li.groupBy("l_orderkey").agg(F.concat_ws("\n", F.lit("TOP BOXOFFICE"), arenas, halls).alias("page"))
    return pages.select("l_orderkey", F.explode(records.ranked_tours("page")).alias("r")).select("l_orderkey", "r.section", "r.rank", "r.line")


_REPORT_SQL = """
WITH x AS (
  SELECT l.l_orderkey, l.l_linenumber AS n, l.l_returnflag AS f, CAST(l.l_quantity AS BIGINT) AS q, p.p_size, l.l_partkey % 7 = 0 AS broken,
         CAST(CAST(floor(l.l_extendedprice) AS BIGINT) AS VARCHAR) AS gross, upper(p.p_name) AS artist, upper(p.p_type) AS other,
         CAST(year(l.l_shipdate) AS VARCHAR) AS year, CASE WHEN l.l_linestatus = 'O' THEN 'worldwide' ELSE 'north_america' END AS scope
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
), k AS (
  SELECT *, n || ' ' || q || '.5 ' || artist || ' ' || q || '.25 ' || (q * 10) || ' ' AS head,
         CASE WHEN f = 'N' THEN (q * 100) || ' ' || gross || ' ' || p_size || '/' || n || ' ' || other || ' AGENCY'
              ELSE gross || ' ' || (n + 50) || ' ' || (q + 1) || '.5 ' || other || ' ' || (q + 2) || '.75 ' || (q * 20) || ' ' || CASE WHEN broken THEN '' ELSE gross END END AS tail
  FROM x
), m AS (
  SELECT *, CASE WHEN f = 'R' AND n = 1 THEN 'total' WHEN f = 'R' AND n = 2 THEN head ELSE head || tail END AS line FROM k
), r AS (
  SELECT *, CASE WHEN line = 'total' OR length(line) < 40 THEN 'not a report row'
                 WHEN line = head OR (f <> 'N' AND broken) THEN 'fits neither layout' END AS reason FROM m
)
SELECT l_orderkey, n AS l_linenumber, year, CAST(n AS VARCHAR) AS rank, q || '.5' AS revenue, 'usd' AS currency, artist,
       regexp_replace(lower(artist), '[^a-z0-9]+', '-', 'g') AS artist_id, q || '.25' AS avg_ticket_price, CAST(q * 10 AS VARCHAR) AS avg_tickets_per_show,
       CASE WHEN f = 'N' THEN CAST(q * 100 AS VARCHAR) END AS total_tickets_sold, gross AS avg_revenue_per_show,
       CASE WHEN f = 'N' THEN p_size || '/' || n END AS num_cities_shows,
       CASE WHEN f = 'N' THEN regexp_replace(lower(other || ' AGENCY'), '[^a-z0-9]+', '-', 'g') END AS agency_id,
       scope, 'pollstar_dir' AS source_id, CAST(NULL AS VARCHAR) AS reason, artist NOT IN (SELECT upper(p_name) FROM part WHERE p_partkey % 50 = 1) AS is_musician
FROM r WHERE reason IS NULL
UNION ALL
SELECT l_orderkey, n, year, CAST(n + 50 AS VARCHAR), (q + 1) || '.5', 'usd', other, regexp_replace(lower(other), '[^a-z0-9]+', '-', 'g'),
       (q + 2) || '.75', CAST(q * 20 AS VARCHAR), NULL, gross, NULL, NULL, scope, 'pollstar_dir', NULL,
       other NOT IN (SELECT upper(p_name) FROM part WHERE p_partkey % 50 = 1)
FROM r WHERE reason IS NULL AND f <> 'N'
UNION ALL
SELECT l_orderkey, n, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, reason, NULL FROM r WHERE reason IS NOT NULL
"""


@query("q41_two_layouts", _REPORT_SQL)
def q41_two_layouts(spark, sf):
    """Annual-report lines in both layouts (one tour with total tickets,
    cities/shows and agency, or two tours side by side), rows that are none
    and rows cut short; every line ends as records or a reason."""
    part = table(spark, sf, "part")
    li = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    t = lambda c: c.cast("string")
    n, q, gross = F.col("l_linenumber"), F.col("l_quantity").cast("bigint"), t(F.floor("l_extendedprice").cast("bigint"))
    dec = lambda c, d: F.concat(t(c), F.lit(d))
    head = F.concat_ws(" ", t(n), dec(q, ".5"), F.upper("p_name"), dec(q, ".25"), t(q * 10), F.lit(""))
    one = F.concat_ws(" ", t(q * 100), gross, F.concat(t(F.col("p_size")), F.lit("/"), t(n)), F.upper("p_type"), F.lit("AGENCY"))
    two = F.concat_ws(" ", gross, t(n + 50), dec(q + 1, ".5"), F.upper("p_type"), dec(q + 2, ".75"), t(q * 20),
                      F.when(F.col("l_partkey") % 7 == 0, F.lit("")).otherwise(gross))
    flag = F.col("l_returnflag")
    line = F.when((flag == "R") & (n == 1), F.lit("total")).when((flag == "R") & (n == 2), head) \
        .otherwise(F.concat(head, F.when(flag == "N", one).otherwise(two)))
    path = F.concat_ws("/", F.lit("reports"), t(F.year("l_shipdate")),
                       F.when(F.col("l_linestatus") == "O", F.lit("worldwide")).otherwise(F.lit("north_america")), F.lit("top.pdf"))
    lines = li.select("l_orderkey", "l_linenumber", line.alias("line"), path.alias("path"))
    listed = part.filter(F.col("p_partkey") % 50 == 1).select(F.upper("p_name").alias("name"))
    return records.parse_report_lines(lines, "line", "path", listed).drop("line", "path")


@query("q43_number_words", """
WITH x AS (
  SELECT *, CAST(CASE l_returnflag WHEN 'R' THEN 20 + l_linenumber WHEN 'A' THEN 100 + l_linenumber ELSE 1000 * l_linenumber + 100 END AS BIGINT) AS k FROM lineitem)
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linestatus = 'O' THEN k END AS num_shows,
       CASE WHEN l_linestatus <> 'O' THEN k END AS num_sellouts
FROM x
""")
def q43_number_words(spark, sf):
    """Counts written as words with OCR-damaged metric words
    (``three shovs``, ``seven satlouts``)."""
    li = table(spark, sf, "lineitem")
    word = F.element_at(F.array(*[F.lit(w) for w in _NUM_WORDS]), F.col("l_linenumber") + 1)
    word = (F.when(F.col("l_returnflag") == "R", F.concat(F.lit("twenty-"), word))
            .when(F.col("l_returnflag") == "A", F.concat(F.lit("One hundred and "), word)).otherwise(F.concat(word, F.lit(" thousand a hundred"))))
    metric = F.when(F.col("l_linestatus") == "O", F.when(F.col("l_returnflag") == "R", F.lit("shovs"))
                    .otherwise(F.lit("shows"))).otherwise(
        F.when(F.col("l_returnflag") == "R", F.lit("satlouts")).otherwise(F.lit("sellouts")))
    c = numbers.parse_count(word, metric)
    return li.select("l_orderkey", "l_linenumber", c["num_shows"].alias("num_shows"),
                     c["num_sellouts"].alias("num_sellouts"))


@query("q44_symbol_clean", f"""
SELECT doc_id,
       trim(regexp_replace(translate(text, '{"".join(text.NOISY_SYMBOLS)}', ''), '\\s+', ' ', 'g')) AS text
FROM documents
""")
def q44_symbol_clean(spark, sf):
    """Noisy-symbol removal and whitespace squeeze over whole documents."""
    return table(spark, sf, "documents").select("doc_id", text.remove_noisy_symbols("text").alias("text"))


_TOUR_MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in records.TOUR_MONTHS) + "]"


@query("q41_tour_lines", f"""
WITH x AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_linenumber AS n, l.l_returnflag AS f, l.l_linestatus AS st, upper(p.p_name) AS artist,
         array_to_string(list_transform(string_split(lower(r.r_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS city,
         CAST(l.l_quantity AS INTEGER) AS sold, CAST(day(l.l_shipdate) AS INTEGER) AS d1, {_TOUR_MONTHS_SQL}[month(l.l_shipdate)] AS m1,
         {_TOUR_MONTHS_SQL}[month(l.l_shipdate) % 12 + 1] AS m2, CAST(p.p_size AS DOUBLE) AS p1,
         CAST(floor(l.l_extendedprice) AS BIGINT) AS gross, l.l_partkey % 10 = 0 AS odd
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey
  JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey
), e AS (
  SELECT *, CASE WHEN st = 'O' AND f = 'R' AND odd AND n = 3 THEN 'not four comma parts'  -- no city and no comma in the sales
                 WHEN f = 'R' AND (st = 'O' OR n = 1) THEN 'digit in city'
                 WHEN odd AND n = 2 THEN 'no dates' WHEN odd AND n = 3 THEN 'no sales' END AS tour_error FROM x
), k AS (SELECT *, tour_error IS NULL OR tour_error = 'no sales' AS ok, tour_error IS NULL AS sales FROM e)
SELECT l_orderkey, l_linenumber, tour_error, CASE WHEN ok THEN artist END AS artist,
       CASE WHEN ok AND f = 'A' THEN 'Calif' END AS state_abbr, CASE WHEN ok THEN m1 END AS month_1, CASE WHEN ok THEN d1 END AS first_day,
       CASE WHEN ok AND n = 5 THEN m2 WHEN ok AND n = 6 THEN m2 END AS month_2,
       CASE WHEN ok THEN CASE n WHEN 2 THEN d1 + 1 WHEN 3 THEN d1 + 2 WHEN 4 THEN d1 + 3 WHEN 5 THEN 2 WHEN 6 THEN 4 ELSE d1 END END AS last_day,
       CASE WHEN ok THEN CASE WHEN n IN (2, 4) THEN n ELSE 1 END END AS num_shows,
       CASE WHEN sales THEN sold * 1000 END AS tickets_sold, CASE WHEN sales THEN p1 END AS ticket_price_1,
       CASE WHEN sales AND f = 'A' THEN p1 + 5.5 END AS ticket_price_2,
       CASE WHEN sales THEN gross END AS gross_receipts, CASE WHEN sales THEN f = 'N' END AS was_sold_out
FROM k
""")
def q41_tour_lines(spark, sf):
    """Older one-line tour layout: ``rank | ARTIST — promoter, venue, city,
    [State.] dates [|shows|] sales``, in every form of dates (one day, ``&``,
    ``a/b/c``, a range, a second month, a misread month, a day that sticks to
    its month), with one or two prices, bars, dollar signs and sell-outs;
    malformed lines are kept with a reason."""
    li = (table(spark, sf, "lineitem")
          .join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
          .join(table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
          .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
          .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    t = lambda c: c.cast("string")
    n, flag, status, odd = F.col("l_linenumber"), F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_partkey") % 10 == 0
    months = F.array(*[F.lit(m) for m in records.TOUR_MONTHS])
    # each part that the line repeats is a column: spelt out, they make the compiled code too large for the JVM to optimise
    li = (li.withColumn("_m1", F.element_at(months, F.month("l_shipdate"))).withColumn("_m2", F.element_at(months, F.month("l_shipdate") % 12 + 1))
          .withColumn("_d1", F.dayofmonth("l_shipdate")))
    m1, m2, d1 = F.col("_m1"), F.col("_m2"), F.col("_d1")
    li = li.withColumn("_first", F.concat(m1, F.lit(". "), t(d1)))
    first = F.col("_first")
    dates = (F.when(odd & (n == 2), F.lit("sometime 12th"))
             .when(n == 2, F.concat(first, F.lit(" & "), t(d1 + 1), F.lit(" |2|")))
             .when(n == 3, F.concat(first, F.lit("/"), t(d1 + 1), F.lit("/"), t(d1 + 2)))
             .when(n == 4, F.concat(first, F.lit("-"), t(d1 + 3), F.lit(" |4|")))
             .when(n == 5, F.concat(first, F.lit(" & "), m2, F.lit(" 2")))
             .when(n == 6, F.concat(first, F.lit(" "), m2, F.lit(". 4")))
             .when(n == 7, F.concat(m1, t(d1)))
             .otherwise(F.concat(m1, F.lit("x "), t(d1))))
    price = F.when(flag == "A", F.concat(t(F.col("p_size")), F.lit(".00-"), t(F.col("p_size") + 5), F.lit(".50"))) \
        .when(flag == "N", F.concat(F.lit("$"), t(F.col("p_size")))).otherwise(F.concat(F.lit("| "), t(F.col("p_size")), F.lit(".00 |")))
    sales = F.when(odd & (n == 3), F.lit("none")).otherwise(F.concat_ws(
        " ", F.concat(t(F.col("l_quantity").cast("int")), F.lit(",000")), price, F.format_string("%,d", F.floor("l_extendedprice")),
        F.when(flag == "N", F.lit("*"))))
    state = F.when(flag == "A", F.lit("Calif. ")).otherwise(F.lit(""))
    city = F.concat(F.initcap("r_name"), F.when((flag == "R") & (status == "F") & (n == 1), F.lit(" 2")).otherwise(F.lit("")))
    promoter = F.concat(F.lit("Promo "), F.initcap("p_brand"))
    parts = F.when((status == "O") & (flag == "R"), F.concat_ws(", ", promoter, "s_name")).otherwise(F.concat_ws(", ", promoter, "s_name", city))
    line = F.concat(t(n), F.lit(" | "), F.upper("p_name"), F.lit(" — "), parts, F.lit(", "), state, dates, F.lit(" "), sales)
    tours = records.parse_tour_lines(li.select("l_orderkey", "l_linenumber", line.alias("line")), "line")
    fields = ["artist", "state_abbr", "month_1", "first_day", "month_2", "last_day", "num_shows", "tickets_sold",
              "ticket_price_1", "ticket_price_2", "gross_receipts", "was_sold_out"]
    return tours.select("l_orderkey", "l_linenumber", "tour_error", *[F.col("tour")[c].alias(c) for c in fields])
