"""q01: the warehouse's analytical listing, on the driver tables.

Mapping: orders = event, customer = venue, lineitem -> part = event_to_artist
(part name = artist), part retail price = ticket price.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.plans.registry import query
from marquee.sources.tables import table

Q01_SQL = """
SELECT o.o_orderkey AS event_id,
       o.o_orderpriority AS event_name,
       a.artists,
       strftime(CAST(o.o_orderdate AS DATE), '%m/%d/%Y') AS start_date,
       strftime(t.end_date, '%m/%d/%Y') AS end_date,
       c.c_name AS venue,
       p.ticket_prices,
       CAST(round(o.o_totalprice) AS BIGINT) AS gross_revenue,
       t.attendance
FROM orders o
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN (SELECT eta.event_id, string_agg(pt.p_name, ', ' ORDER BY pt.p_name) AS artists
      FROM (SELECT DISTINCT l_orderkey AS event_id, l_partkey AS artist_id FROM lineitem) eta
      JOIN part pt ON pt.p_partkey = eta.artist_id
      GROUP BY eta.event_id) a ON a.event_id = o.o_orderkey
JOIN (SELECT event_id, string_agg(CAST(ticket_price AS VARCHAR), ', ' ORDER BY ticket_price) AS ticket_prices
      FROM (SELECT DISTINCT l.l_orderkey AS event_id, CAST(pt.p_retailprice AS DECIMAL(8,2)) AS ticket_price
            FROM lineitem l JOIN part pt ON pt.p_partkey = l.l_partkey) d
      GROUP BY event_id) p ON p.event_id = o.o_orderkey
JOIN (SELECT l.l_orderkey AS event_id, CAST(max(l.l_shipdate) AS DATE) AS end_date,
             CAST(sum(l.l_quantity) AS BIGINT) AS attendance
      FROM lineitem l JOIN part pt ON pt.p_partkey = l.l_partkey
      GROUP BY l.l_orderkey) t ON t.event_id = o.o_orderkey
ORDER BY CAST(o.o_orderdate AS DATE), o.o_orderkey
"""


@query("q01_event_listing", Q01_SQL)
def q01_event_listing(spark, sf):
    """Per-event artist and price lists, joined to event and venue, by date.

    Plan: lineitem is joined to part (AQE broadcasts part when its runtime
    size is under the threshold, otherwise a shuffle join on partkey), then
    ONE aggregation per event builds both distinct lists, the end date and
    the attendance (partial collect_set on the map side).  orders joins the
    per-event aggregate on the key it is already partitioned by; customer is
    the venue dimension.  Inner joins drop events lacking artist or price.
    """
    items = (table(spark, sf, "lineitem")
             .select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
             .join(table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"),
                   F.col("l_partkey") == F.col("p_partkey")))
    per_event = (items.groupBy(F.col("l_orderkey").alias("event_id"))
                 .agg(F.collect_set(F.struct("p_name", "p_partkey")).alias("_artists"),
                      F.collect_set(F.col("p_retailprice").cast("decimal(8,2)")).alias("_prices"),
                      F.max(F.to_date("l_shipdate")).alias("end_date"),
                      F.sum("l_quantity").cast("bigint").alias("attendance"))
                 .select("event_id", "end_date", "attendance",
                         F.array_join(F.transform(F.array_sort("_artists"), lambda s: s["p_name"]),
                                      ", ").alias("artists"),
                         F.array_join(F.transform(F.array_sort("_prices"), lambda p: p.cast("string")),
                                      ", ").alias("ticket_prices")))
    events = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("venue_id"),
        F.col("o_orderpriority").alias("event_name"),
        F.to_date("o_orderdate").alias("start_date"),
        F.round("o_totalprice").cast("bigint").alias("gross_revenue"))
    venues = table(spark, sf, "customer").select(F.col("c_custkey").alias("venue_id"),
                                                 F.col("c_name").alias("venue"))
    return (events.join(per_event, "event_id").join(venues, "venue_id")
            .orderBy("start_date", "event_id")
            .select("event_id", "event_name", "artists",
                    F.date_format("start_date", "MM/dd/yyyy").alias("start_date"),
                    F.date_format("end_date", "MM/dd/yyyy").alias("end_date"),
                    "venue", "ticket_prices", "gross_revenue", "attendance"))
