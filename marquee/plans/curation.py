"""Curation operators on the driver tables.

Each query synthesises the messy cell text the operator is built for from
clean columns (in the Spark plan), runs the operator, and the oracle SQL
computes the expected clean value straight from the clean columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import dates, money, text
from marquee.operators import quality
from marquee.plans.registry import query
from marquee.sources.tables import table

# --- fixed values -----------------------------------------------------------
# Month words as printed in the listings (abbreviations carry a period).
PRINTED_MONTHS = ["Jan.", "Feb.", "March", "April", "May", "June", "July", "Aug.", "Sept.", "Oct.", "Nov.", "Dec."]


def _month_word(m):
    return F.element_at(F.array(*[F.lit(x) for x in PRINTED_MONTHS]), m)


def _sql_list(values):
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


CLEAN_MONTHS_SQL = _sql_list([m.rstrip(".") for m in PRINTED_MONTHS])

# ---------------------------------------------------------------------------


@query("q15_ocr_int", """
SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice) AS BIGINT) AS attendance
FROM lineitem
""")
def q15_ocr_int(spark, sf):
    """OCR integer repair (thousands commas, trailing ``.0``, ``$``, blanks)."""
    li = table(spark, sf, "lineitem")
    n = F.floor("l_extendedprice")
    pretty = F.format_string("%,d", n)
    raw = (F.when(F.col("l_returnflag") == "A", F.concat(pretty, F.lit(".0")))
           .when(F.col("l_returnflag") == "N", F.concat(F.lit(" "), F.replace(pretty, F.lit(","), F.lit(" ")), F.lit(" ")))
           .otherwise(F.concat(F.lit("$"), pretty)))
    return li.select("l_orderkey", "l_linenumber", money.parse_ocr_int(raw).alias("attendance"))


@query("q16_price_parse", """
SELECT l.l_orderkey, l.l_linenumber, CAST(2 AS BIGINT) AS n_prices,
       CAST(p.p_size * 100 + CAST(round(l.l_discount * 100) AS BIGINT) AS BIGINT) AS price_1_cents,
       CAST(CAST(l.l_quantity AS BIGINT) * 100 AS BIGINT) AS price_2_cents,
       CAST(NULL AS BIGINT) AS noisy_price
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
""")
def q16_price_parse(spark, sf):
    """Ticket-price cells: ``$11,05/S23_`` -> [11.05, 23.0]; a bracketed
    cell is noise (null)."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    cents = F.round(F.col("l_discount") * 100).cast("int")
    cell = F.concat(F.lit("$"), F.format_string("%d,%02d", F.col("p_size"), cents), F.lit("/S"),
                    F.col("l_quantity").cast("bigint").cast("string"), F.lit("_"))
    prices = money.curate_prices(F.array(cell))
    noisy = money.curate_price(F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit(")")))
    return li.select("l_orderkey", "l_linenumber", F.size(prices).cast("bigint").alias("n_prices"),
                     F.round(F.get(prices, 0) * 100).cast("bigint").alias("price_1_cents"),
                     F.round(F.get(prices, 1) * 100).cast("bigint").alias("price_2_cents"),
                     noisy.cast("bigint").alias("noisy_price"))


@query("q17_year_inference", """
SELECT o_orderkey AS event_id,
       CAST(month(o_orderdate) AS INTEGER) AS event_month,
       CAST(year(CAST(o_orderdate AS DATE) + 45) AS INTEGER) AS issue_year,
       CAST(month(CAST(o_orderdate AS DATE) + 45) AS INTEGER) AS issue_month,
       CAST(year(o_orderdate) AS INTEGER) AS event_year
FROM orders
""")
def q17_year_inference(spark, sf):
    """Event year from the issue date and the event month (issue 45 days later)."""
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    issue = F.date_add("d", 45)
    return o.select(F.col("o_orderkey").alias("event_id"), F.month("d").alias("event_month"),
                    F.year(issue).alias("issue_year"), F.month(issue).alias("issue_month")
                    ).withColumn("event_year", dates.event_year("issue_year", "issue_month", "event_month")
                                 .cast("int"))


Q18_SQL = f"""
WITH e AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS s,
         CAST(o_orderdate AS DATE) + (CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 3 END) AS e
  FROM orders)
SELECT o_orderkey AS event_id, s AS start_date, e AS end_date,
       CASE WHEN s = e THEN {CLEAN_MONTHS_SQL}[month(s)] || ' ' || CAST(day(s) AS VARCHAR)
            WHEN month(s) = month(e) THEN {CLEAN_MONTHS_SQL}[month(s)] || ' ' || CAST(day(s) AS VARCHAR)
                 || '-' || CAST(day(e) AS VARCHAR)
            ELSE {CLEAN_MONTHS_SQL}[month(s)] || ' ' || CAST(day(s) AS VARCHAR) || '-'
                 || {CLEAN_MONTHS_SQL}[month(e)] || ' ' || CAST(day(e) AS VARCHAR) END AS dates
FROM e
"""


@query("q18_date_range", Q18_SQL)
def q18_date_range(spark, sf):
    """Date-range parsing with per-month year inference from printed cells:
    ``['Nov. 3 112,946']``, ``['Oct. 3-', '5']``, ``['Dec. 30-', 'Jan. 2']``."""
    o = table(spark, sf, "orders")
    s = F.to_date("o_orderdate")
    off = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(3)
    o = o.select("o_orderkey", "o_totalprice", s.alias("s"), F.date_add(s, off).alias("e"))
    d = lambda c: F.dayofmonth(c).cast("string")
    cells = (F.when(F.col("s") == F.col("e"),
                    F.array(F.concat_ws(" ", _month_word(F.month("s")), d("s"),
                                        F.format_string("%,d", F.floor("o_totalprice")))))
             .when(F.month("s") == F.month("e"),
                   F.array(F.concat(_month_word(F.month("s")), F.lit(" "), d("s"), F.lit("-")), d("e")))
             .otherwise(F.array(F.concat(_month_word(F.month("s")), F.lit(" "), d("s"), F.lit("-")),
                                F.concat_ws(" ", _month_word(F.month("e")), d("e")))))
    issue = F.date_add("e", 10)
    r = dates.curate_date(cells, F.year(issue), F.month(issue))
    return o.select(F.col("o_orderkey").alias("event_id"), r["start_date"].alias("start_date"),
                    r["end_date"].alias("end_date"), r["dates"].alias("dates"))


Q19_SQL = f"""
WITH e AS (SELECT event_id, CAST(ts AS DATE) AS d, CAST(floor(value) AS BIGINT) AS n FROM events)
SELECT event_id,
       {CLEAN_MONTHS_SQL}[month(d)] || ' ' || CAST(day(d) AS VARCHAR)
       || CASE WHEN n BETWEEN 1 AND 31 AND n > day(d) THEN ' ' || CAST(n AS VARCHAR) ELSE '' END AS dates
FROM e
"""


@query("q19_date_clean", Q19_SQL)
def q19_date_clean(spark, sf):
    """Date-cell cleaning: ``Jan.6`` glued, ``Sept: 21`` colon, numbers and
    thousands mixed in, and a stray second cell kept only if it is a later day."""
    ev = table(spark, sf, "events").select("event_id", "event_type", "value", F.to_date("ts").alias("d"))
    m, day = _month_word(F.month("d")), F.dayofmonth("d").cast("string")
    first = (F.when(F.col("event_type") == "click", F.concat(m, day))
             .when(F.col("event_type") == "view", F.concat(F.regexp_replace(m, r"\.$", ""), F.lit(": "), day))
             .otherwise(F.concat_ws(" ", m, day, F.format_string("%,d", F.floor(F.col("value") * 1000) + 1000))))
    cells = F.array(first, F.floor("value").cast("string"))
    return ev.select("event_id", dates.clean_dates(cells).alias("dates"))


@query("q13_column_gate", """
SELECT c_custkey, c_nationkey, c_mktsegment,
       CASE WHEN bool_and(c_acctbal >= 0) OVER (PARTITION BY c_nationkey, c_mktsegment)
            THEN CAST(round(c_acctbal * 100) AS BIGINT) END AS acctbal_cents
FROM customer
""")
def q13_column_gate(spark, sf):
    """Per-issue numeric gate: one negative value nulls the column for its group."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment",
                                            F.round(F.col("c_acctbal") * 100).cast("bigint").alias("acctbal_cents"))
    return quality.column_gate(c, ["c_nationkey", "c_mktsegment"], ["acctbal_cents"]).select(
        "c_custkey", "c_nationkey", "c_mktsegment", "acctbal_cents")


@query("q14_cross_gate", """
WITH x AS (
  SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS num_shows,
         CAST(floor(l_tax * 500) AS BIGINT) AS num_sellouts,
         CAST(floor(l_extendedprice / 1000) AS BIGINT) AS cap
  FROM lineitem)
SELECT l_orderkey, l_linenumber, num_shows,
       CASE WHEN bool_and(num_sellouts >= 0 AND num_sellouts <= num_shows) OVER (PARTITION BY l_orderkey)
            THEN num_sellouts END AS num_sellouts,
       CASE WHEN cap < num_shows THEN NULL ELSE cap END AS capacity
FROM x
""")
def q14_cross_gate(spark, sf):
    """Cross-column gate (sellouts <= shows for the whole group) and the
    capacity-below-attendance rejection."""
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("num_shows"),
        F.floor(F.col("l_tax") * 500).cast("bigint").alias("num_sellouts"),
        F.floor(F.col("l_extendedprice") / 1000).cast("bigint").alias("cap"))
    g = quality.sellout_gate(li, ["l_orderkey"])
    return g.select("l_orderkey", "l_linenumber", "num_shows", "num_sellouts",
                    money.capacity_checked("cap", "num_shows").alias("capacity"))


@query("q37_revenue_check", """
SELECT l.l_orderkey, l.l_linenumber,
       CAST(l.l_quantity AS BIGINT) AS tickets_sold,
       CAST(round(p.p_retailprice * 100) AS BIGINT) AS price_1_cents,
       CAST(round(l.l_extendedprice / l.l_quantity * 100) AS BIGINT) AS price_2_cents,
       CAST(floor(l.l_extendedprice) AS BIGINT) AS gross,
       l.l_returnflag = 'R' AS was_sold_out,
       abs(floor(l.l_extendedprice) - ((round(p.p_retailprice * 100) + round(l.l_extendedprice / l.l_quantity * 100)) / 200.0)
           * l.l_quantity) > 0.2 * floor(l.l_extendedprice) AS revenue_mismatch
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
""")
def q37_revenue_check(spark, sf):
    """Sales-cell parse (``12 $900.10-$1,234.56 $14,815*``: sold, price
    range, gross, ``*`` = sold out) and the revenue plausibility flag."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    p1 = F.round(F.col("p_retailprice") * 100).cast("bigint")
    p2 = F.round(F.col("l_extendedprice") / F.col("l_quantity") * 100).cast("bigint")
    money_txt = lambda c: F.format_string("%,d.%02d", F.floor(c / 100), c % 100)
    sales = F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(" $"), money_txt(p1), F.lit("-$"),
                     money_txt(p2), F.lit(" $"), F.format_string("%,d", F.floor("l_extendedprice")),
                     F.when(F.col("l_returnflag") == "R", F.lit("*")).otherwise(F.lit("")))
    s = li.select("l_orderkey", "l_linenumber", sales.alias("sales"))
    pat = r"^([0-9,]+) \$([0-9,.]+)(?:-\$([0-9,.]+))? \$([0-9,]+)(\*?)$"
    # one regex pass: the five groups written into a delimited string
    s = s.withColumn("_g", F.split(F.regexp_replace("sales", pat, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01"))
    g = lambda i: F.get("_g", i - 1)
    price = lambda i: F.round(F.regexp_replace(g(i), ",", "").try_cast("double") * 100).cast("bigint")
    out = s.select("l_orderkey", "l_linenumber",
                   money.parse_ocr_int(g(1)).alias("tickets_sold"),
                   price(2).alias("price_1_cents"), price(3).alias("price_2_cents"),
                   money.parse_ocr_int(g(4)).alias("gross"),
                   (g(5) == "*").alias("was_sold_out"))
    return out.withColumn("revenue_mismatch", money.revenue_mismatch(
        "tickets_sold", F.col("price_1_cents") / 100, F.col("price_2_cents") / 100, "gross"))
