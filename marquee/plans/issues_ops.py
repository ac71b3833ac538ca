"""Whole issues as lines on the driver tables: ranked sections to tour records."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators import issues, records
from marquee.plans.registry import query
from marquee.sources.tables import table

_MONTHS_SQL = "[" + ", ".join(f"'{m}'" for m in records.TOUR_MONTHS) + "]"


@query("q57_issue_tours", f"""
WITH x AS (
  SELECT l.l_suppkey, l.l_linestatus AS st, l.l_returnflag AS f, upper(p.p_name) AS artist, CAST(l.l_quantity AS BIGINT) * 1000 AS sold,
         {_MONTHS_SQL}[month(l.l_shipdate)] AS m, CAST(day(l.l_shipdate) AS INTEGER) AS d, CAST(floor(l.l_extendedprice) AS BIGINT) AS gross, l.l_partkey % 10 = 0 AS odd,
         row_number() OVER (PARTITION BY l.l_suppkey, l.l_linestatus ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity) AS k
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
), n AS (SELECT l_suppkey, st, max(k) AS last FROM x GROUP BY ALL)
SELECT x.l_suppkey, CASE WHEN x.st = 'O' THEN 'Arena' ELSE 'Auditorium' END AS size, CAST(k AS INTEGER) AS rank, artist,
       CASE WHEN odd THEN 'no sales' END AS reason, m AS month_1, d AS first_day,
       CASE WHEN NOT odd THEN sold END AS tickets_sold, CASE WHEN NOT odd THEN gross END AS gross_receipts, CASE WHEN NOT odd THEN f = 'N' END AS was_sold_out
FROM x
UNION ALL
SELECT l_suppkey, 'Arena', NULL, 'a note under the heading', 'before the first record', NULL, NULL, NULL, NULL, NULL FROM n WHERE st = 'O'
UNION ALL
SELECT x.l_suppkey, 'Auditorium', NULL, 'AN ADVERTISEMENT', 'behind the last tour', NULL, NULL, NULL, NULL, NULL
FROM x JOIN n ON n.l_suppkey = x.l_suppkey AND n.st = x.st AND n.last = x.k WHERE x.st = 'F' AND x.f = 'N' AND NOT odd
""")
def q57_issue_tours(spark, sf):
    """Issues of many lines (one per supplier): two ranked sections with
    misread ranks, overflow lines and lines that are not the next rank, a note
    before the first tour, matter behind the last one and behind the section's
    end; every tour a record with its venue size, or a reason."""
    part = table(spark, sf, "part").select("p_partkey", "p_name")
    items = table(spark, sf, "lineitem")
    # what the lines are made of comes together once, by issue
    li = items.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_suppkey", "l_linestatus", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate", "p_name").repartition("l_suppkey")
    n = Window.partitionBy("l_suppkey", "l_linestatus").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    x = li.withColumn("k", F.row_number().over(n)).withColumn("last", F.lead(F.lit(True)).over(n).isNull())
    t = lambda c: c.cast("string")
    k, flag, months = t(F.col("k")), F.col("l_returnflag"), F.array(*[F.lit(m) for m in records.TOUR_MONTHS])
    rank = F.when(flag == "R", F.concat(F.lit("7"), k)).when(F.col("l_partkey") % 4 == 0, F.concat(F.lit("*"), k, F.lit("1"))).otherwise(k)
    opening = F.concat(rank, F.lit(" | "), F.upper("p_name"), F.lit(" — Avalon, Hall, Tampa,"))
    date = F.concat(F.element_at(months, F.month("l_shipdate")), F.lit(". "), t(F.dayofmonth("l_shipdate")))
    sales = F.when(F.col("l_partkey") % 10 == 0, F.lit("none")).otherwise(F.concat(
        t(F.col("l_quantity").cast("bigint")), F.lit(",000 $8.50 $"), F.format_string("%,d", F.floor("l_extendedprice")), F.when(flag == "N", F.lit("*")).otherwise(F.lit(""))))
    other = F.when(flag == "A", F.concat(t(F.col("k") + 30000), F.lit(" | is not the next rank")))
    status, at = F.col("l_linestatus"), 10 * F.col("k")
    base = F.when(status == "O", F.lit(0)).otherwise(F.lit(1 << 40)).cast("long")
    heads = {name: head for head, name in records.TOUR_SECTIONS.items()}
    rows = lambda *some: F.array(*[F.struct(no.cast("long").alias("no"), text.alias("line")) for no, text in some])
    fixed = lambda *some: rows(*[(no, F.lit(text)) for no, text in some])
    before = F.when((F.col("k") == 1) & (status == "O"), fixed((F.lit(0), heads["Arena"]), (F.lit(1), "a note under the heading"))) \
        .when((F.col("k") == 1) & (status == "F"), fixed((F.lit(0), heads["Auditorium"])))
    behind = F.when(F.col("last") & (status == "F"), fixed(
        (at + 7, "AN ADVERTISEMENT"), (at + 8, "Copyrighted and compiled by the chart department"), (at + 9, "1 | NOT A TOUR — Avalon, Hall, Tampa, May 1 1,000 8.00 8,000")))
    own = F.transform(F.array_compact(F.array(opening, F.concat_ws(" ", date, sales), other)), lambda text, i: F.struct((at + i).cast("long").alias("no"), text.alias("line")))
    none = F.array().cast("array<struct<no:bigint,line:string>>")
    # most rows have no lines but their own
    body = x.select("l_suppkey", base.alias("base"), F.explode(F.when(before.isNull() & behind.isNull(), own).otherwise(
        F.concat(F.coalesce(before, none), own, F.coalesce(behind, none)))).alias("r")).select("l_suppkey", (F.col("base") + F.col("r.no")).alias("line_no"), "r.line")
    sizes = items.groupBy("l_suppkey").agg((3 * F.count("*") + 6).alias("lines"))   # a row has three lines at most
    got = issues.issue_tours(body, ["l_suppkey"], sizes=sizes)
    name = F.when(F.col("rank").isNull(), F.col("raw")).otherwise(F.col("tour.artist"))
    return got.select("l_suppkey", "size", "rank", name.alias("artist"), "reason", "tour.month_1", "tour.first_day", "tour.tickets_sold",
                      "tour.gross_receipts", "tour.was_sold_out")
