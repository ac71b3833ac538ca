"""Warehouse load operators on the driver tables: signature dedupe, list
text -> bridge tables, price bridge, corrections overlay, constraint report,
dimension statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.functions import money, text
from marquee.operators import load, quality
from marquee.operators.corrections import apply_corrections
from marquee.plans.registry import query
from marquee.plans.text_ops import _slug_sql
from marquee.sources.tables import table


def _events_with_signature(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    e = (o.join(c, F.col("o_custkey") == F.col("c_custkey"))
         .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    sig = F.concat_ws("-", text.slugify("c_mktsegment"), F.lower(F.replace("n_name", F.lit(" "), F.lit("-"))),
                      F.to_date("o_orderdate").cast("string"))
    return e.select(F.col("o_orderkey").alias("event_id"), sig.alias("signature"))


@query("q02_dedupe_signature", f"""
SELECT signature, min(o.o_orderkey) AS event_id, count(*) AS n_copies
FROM (SELECT o.o_orderkey,
             {_slug_sql('c.c_mktsegment')} || '-' || lower(replace(n.n_name, ' ', '-')) || '-'
             || CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) AS signature
      FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
      JOIN nation n ON n.n_nationkey = c.c_nationkey) o
GROUP BY signature
""")
def q02_dedupe_signature(spark, sf):
    """Event signature ``slug(first name)-venue-start_date`` and dedupe with a
    deterministic survivor (lowest event id)."""
    e = _events_with_signature(spark, sf)
    return load.dedupe_by_key(e, "signature", ["event_id"], count_col="n_copies").select(
        "signature", "event_id", "n_copies")


@query("q03_list_text_to_bridge", """
SELECT DISTINCT o.o_orderkey AS event_id, l.l_partkey AS artist_id
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
""")
def q03_list_text_to_bridge(spark, sf):
    """List text (``[12, 7, None]``, ``[]``) -> array -> distinct bridge rows;
    empty lists and null elements vanish."""
    li = table(spark, sf, "lineitem")
    per = li.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("a"))
    txt = F.concat(F.lit("["), F.array_join(F.transform("a", lambda s: s["l_partkey"].cast("string")), ", "),
                   F.lit("]"))
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    ev = o.join(per.select("l_orderkey", txt.alias("t")), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    ids_text = F.coalesce(F.when(F.col("o_orderstatus") == "P", F.regexp_replace("t", r"\]$", ", None]"))
                          .otherwise(F.col("t")), F.lit("[]"))
    staged = ev.select(F.col("o_orderkey").alias("event_id"),
                       text.py_list_text_to_array(ids_text, "bigint").alias("artist_ids"))
    return load.bridge(staged, "event_id", "artist_ids", "artist_id")


@query("q04_price_bridge", """
SELECT DISTINCT l.l_orderkey AS event_id, CAST(p.p_retailprice AS DECIMAL(8,2)) AS ticket_price,
       CAST(round(CAST(p.p_retailprice AS DECIMAL(8,2))) AS INTEGER) AS whole_price
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
""")
def q04_price_bridge(spark, sf):
    """Price list per event -> DECIMAL(8,2) bridge (cents kept), plus the
    whole-unit rounding an integer cast would apply."""
    li = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    per = li.groupBy(F.col("l_orderkey").alias("event_id")).agg(F.collect_list("p_retailprice").alias("prices"))
    per = per.select("event_id", money.prices_to_decimal("prices").alias("ticket_prices"))
    b = load.bridge(per, "event_id", "ticket_prices", "ticket_price")
    return b.withColumn("whole_price", F.round("ticket_price").cast("int"))


@query("q12_corrections", """
WITH c AS (
  SELECT 'o' || CAST(l_orderkey AS VARCHAR) AS sig, 'attendance' AS field,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS v, l_linenumber AS seq
  FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL
  SELECT 'o' || CAST(l_orderkey AS VARCHAR), 'capacity', CAST(CAST(floor(l_extendedprice / 10) AS BIGINT) AS VARCHAR),
         l_linenumber
  FROM lineitem WHERE l_linestatus = 'O'
  UNION ALL
  SELECT 'o' || CAST(o_orderkey AS VARCHAR), 'capacity', 'n/a', 1000 FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT 'o' || CAST(l_orderkey AS VARCHAR), 'start_date', CAST(CAST(l_shipdate AS DATE) AS VARCHAR), l_linenumber
  FROM lineitem WHERE l_returnflag = 'A'
  UNION ALL
  SELECT 'o' || CAST(o_orderkey AS VARCHAR), 'event_name', 'Renamed ' || o_orderstatus, 1 FROM orders WHERE o_orderpriority = '2-HIGH'),
w AS (SELECT sig, field, v, row_number() OVER (PARTITION BY sig, field ORDER BY seq DESC, v DESC) AS rn FROM c)
SELECT o.o_orderkey AS event_id,
       coalesce(TRY_CAST(a.v AS BIGINT), CAST(0 AS BIGINT)) AS attendance,
       coalesce(TRY_CAST(k.v AS BIGINT), CAST(floor(o.o_totalprice / 100) AS BIGINT)) AS capacity,
       coalesce(TRY_CAST(s.v AS DATE), CAST(o.o_orderdate AS DATE)) AS start_date,
       coalesce(n.v, o.o_orderpriority) AS event_name,
       CASE WHEN o.o_orderpriority = '3-MEDIUM' THEN 'FIRST OF ' || o.o_custkey || '; SECOND' ELSE 'AS PRINTED' END AS artists
FROM orders o
LEFT JOIN w a ON a.sig = 'o' || CAST(o.o_orderkey AS VARCHAR) AND a.field = 'attendance' AND a.rn = 1
LEFT JOIN w k ON k.sig = 'o' || CAST(o.o_orderkey AS VARCHAR) AND k.field = 'capacity' AND k.rn = 1
LEFT JOIN w s ON s.sig = 'o' || CAST(o.o_orderkey AS VARCHAR) AND s.field = 'start_date' AND s.rn = 1
LEFT JOIN w n ON n.sig = 'o' || CAST(o.o_orderkey AS VARCHAR) AND n.field = 'event_name' AND n.rn = 1
""")
def q12_corrections(spark, sf):
    """Corrections overlay keyed by signature: last ``seq`` wins per field;
    numbers, a date, a name and a list, typed on apply, unparsable values ignored."""
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders")
    sig = lambda k: F.concat(F.lit("o"), F.col(k).cast("string"))

    def rows(df, key, field, value, seq):
        return df.select(sig(key).alias("event_signature"), F.lit(field).alias("field"), value.cast("string").alias("true_value"),
                         seq.cast("int").alias("seq"))

    n = F.col("l_linenumber")
    corr = rows(li.filter("l_returnflag = 'R'"), "l_orderkey", "attendance", F.col("l_quantity").cast("bigint"), n)
    for more in (rows(li.filter("l_linestatus = 'O'"), "l_orderkey", "capacity", F.floor(F.col("l_extendedprice") / 10).cast("bigint"), n),
                 rows(o.filter("o_orderpriority = '1-URGENT'"), "o_orderkey", "capacity", F.lit("n/a"), F.lit(1000)),
                 rows(li.filter("l_returnflag = 'A'"), "l_orderkey", "start_date", F.to_date("l_shipdate"), n),
                 rows(o.filter("o_orderpriority = '2-HIGH'"), "o_orderkey", "event_name", F.concat(F.lit("Renamed "), "o_orderstatus"), F.lit(1)),
                 rows(o.filter("o_orderpriority = '3-MEDIUM'"), "o_orderkey", "artists",
                      F.concat(F.lit("['FIRST OF "), F.col("o_custkey").cast("string"), F.lit("', 'SECOND']")), F.lit(1))):
        corr = corr.unionByName(more)
    events = o.select(F.col("o_orderkey").alias("event_id"), sig("o_orderkey").alias("signature"),
                      F.lit(0).cast("bigint").alias("attendance"), F.floor(F.col("o_totalprice") / 100).cast("bigint").alias("capacity"),
                      F.to_date("o_orderdate").alias("start_date"), F.col("o_orderpriority").alias("event_name"),
                      F.array(F.lit("AS PRINTED")).alias("artists"))
    fixed = apply_corrections(events, corr, fields={"attendance": "bigint", "capacity": "bigint", "start_date": "date",
                                                    "event_name": "string", "artists": "array<string>"})
    return fixed.select("event_id", "attendance", "capacity", "start_date", "event_name", F.array_join("artists", "; ").alias("artists"))


@query("q40_constraints", """
SELECT 'lineitem_duplicate_key' AS "check", CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS violations FROM lineitem
UNION ALL SELECT 'lineitem_orphan_order', CAST(count(*) AS BIGINT) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL SELECT 'lineitem_orphan_part', CAST(count(*) AS BIGINT) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL SELECT 'orders_orphan_customer', CAST(count(*) AS BIGINT) FROM orders o WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)
UNION ALL SELECT 'customer_orphan_nation', CAST(count(*) AS BIGINT) FROM customer c WHERE NOT EXISTS (SELECT 1 FROM nation n WHERE n.n_nationkey = c.c_nationkey)
UNION ALL SELECT 'orders_null_total', CAST(count(*) AS BIGINT) FROM orders WHERE o_totalprice IS NULL
UNION ALL SELECT 'orders_negative_total', CAST(count(*) AS BIGINT) FROM orders WHERE o_totalprice < 0
UNION ALL SELECT 'orders_duplicate_key', CAST(count(*) - count(DISTINCT o_orderkey) AS BIGINT) FROM orders
UNION ALL SELECT 'lineitem_unparsable_status', CAST(count(*) AS BIGINT) FROM lineitem WHERE NOT regexp_matches(l_linestatus, '^[A-Z]$')
""")
def q40_constraints(spark, sf):
    """Constraint report: duplicate keys, orphans (anti joins), nulls and
    negative values, rows that fail a parse rule (quarantine count)."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    c, n, p = table(spark, sf, "customer"), table(spark, sf, "nation"), table(spark, sf, "part")

    def orphans(df, key, ref, ref_key):
        return df.select(key).join(ref.select(ref_key), F.col(key) == F.col(ref_key), "left_anti").agg(F.count("*").alias("n"))

    # per key: copies beyond the first and rows that break a rule, from one scan per table
    rules = quality.key_report(li, ["l_orderkey", "l_linenumber"], {"lineitem_unparsable_status": ~F.col("l_linestatus").rlike("^[A-Z]$")},
                               "lineitem_duplicate_key")
    rules = rules.unionByName(quality.key_report(o, ["o_orderkey"], {
        "orders_null_total": F.col("o_totalprice").isNull(), "orders_negative_total": F.col("o_totalprice") < 0}, "orders_duplicate_key"))
    for name, df in {"lineitem_orphan_order": orphans(li, "l_orderkey", o, "o_orderkey"),
                     "lineitem_orphan_part": orphans(li, "l_partkey", p, "p_partkey"),
                     "orders_orphan_customer": orphans(o, "o_custkey", c, "c_custkey"),
                     "customer_orphan_nation": orphans(c, "c_nationkey", n, "n_nationkey")}.items():
        rules = rules.unionByName(df.select(F.lit(name).alias("check"), F.col("n").cast("bigint").alias("violations")))
    return rules


@query("q46_dim_stats", f"""
WITH d AS (
  SELECT 'nation' AS dim, n_nationkey AS id, {_slug_sql('n_name')} AS slug FROM nation
  UNION ALL SELECT 'region', r_regionkey, {_slug_sql('r_name')} FROM region
  UNION ALL SELECT 'part', p_partkey, {_slug_sql('p_name')} FROM part
  UNION ALL SELECT 'supplier', s_suppkey, {_slug_sql('s_name')} FROM supplier
  UNION ALL SELECT 'segment', c_custkey, {_slug_sql('c_mktsegment')} FROM customer),
s AS (SELECT dim, slug, count(*) AS n FROM d GROUP BY dim, slug)
SELECT d.dim, CAST(count(*) AS BIGINT) AS n_rows, CAST(max(id) AS BIGINT) AS max_id,
       CAST((SELECT count(*) FROM s WHERE s.dim = d.dim) AS BIGINT) AS n_slugs,
       CAST((SELECT count(*) FROM s WHERE s.dim = d.dim AND s.n > 1) AS BIGINT) AS n_repeated_slugs
FROM d GROUP BY d.dim
""")
def q46_dim_stats(spark, sf):
    """Dimension index statistics: rows, ``max(id)`` (next id base), slug
    count and slugs shared by several members."""
    dims = [("nation", "n_nationkey", "n_name"), ("region", "r_regionkey", "r_name"),
            ("part", "p_partkey", "p_name"), ("supplier", "s_suppkey", "s_name"),
            ("segment", "c_custkey", "c_mktsegment")]
    src = {"nation": "nation", "region": "region", "part": "part", "supplier": "supplier", "segment": "customer"}
    d = None
    for name, idc, nm in dims:
        x = table(spark, sf, src[name]).select(F.lit(name).alias("dim"), F.col(idc).cast("bigint").alias("id"),
                                              text.slugify(nm).alias("slug"))
        d = x if d is None else d.unionByName(x)
    per_slug = d.groupBy("dim", "slug").agg(F.count("*").alias("n"))
    slugs = per_slug.groupBy("dim").agg(F.count("*").alias("n_slugs"),
                                        F.count(F.when(F.col("n") > 1, 1)).alias("n_repeated_slugs"))
    base = d.groupBy("dim").agg(F.count("*").alias("n_rows"), F.max("id").alias("max_id"))
    return base.join(slugs, "dim").select("dim", "n_rows", "max_id", "n_slugs", "n_repeated_slugs")
