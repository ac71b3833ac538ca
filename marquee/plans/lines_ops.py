"""Ordered-line operators on the driver tables: text -> lines, grouping of
lines into records, header forward fill, section slicing, first marker page,
rank within issue, re-rank after a filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from marquee.operators import lines
from marquee.plans.registry import query
from marquee.sources.tables import table


@query("q20_lines", """
SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS line_no, unnest(l) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)
""")
def q20_lines(spark, sf):
    """Page text -> ordered lines (whole texts)."""
    return lines.explode_lines(table(spark, sf, "documents"), ["doc_id"], "text").select(
        "doc_id", F.col("line_no").cast("int").alias("line_no"), "line")


@query("q21_group_lines", """
WITH g AS (SELECT conv_id, turn, text,
                  sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END)
                    OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS group_no
           FROM conversations)
SELECT conv_id, CAST(group_no AS BIGINT) AS group_no, min(turn) AS first_line, count(*) AS n_lines,
       string_agg(text, ' | ' ORDER BY turn) AS text
FROM g GROUP BY conv_id, group_no
""")
def q21_group_lines(spark, sf):
    """Ordered lines -> records: a start line (here: a user turn) opens a
    record; following lines join it with `` | ``."""
    c = table(spark, sf, "conversations")
    return lines.group_lines(c, ["conv_id"], "turn", "text", F.col("role") == "user")


@query("q22_forward_fill", """
SELECT conv_id, turn, role,
       last_value(CASE WHEN role IN ('system', 'user') THEN role || ':' || CAST(turn AS VARCHAR) END IGNORE NULLS)
         OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section
FROM conversations
""")
def q22_forward_fill(spark, sf):
    """Section header forward fill: every line carries the last header seen."""
    c = table(spark, sf, "conversations").select(
        "conv_id", "turn", "role",
        F.when(F.col("role").isin("system", "user"), F.concat_ws(":", "role", F.col("turn").cast("string")))
        .alias("header"))
    return lines.forward_fill(c, ["conv_id"], "turn", "header", "section").select("conv_id", "turn", "role", "section")


Q23_SQL = """
WITH l AS (SELECT doc_id, generate_subscripts(a, 1) - 1 AS line_no, unnest(a) AS line
           FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)),
h AS (SELECT doc_id, min(line_no) AS header_line FROM l WHERE length(line) < 25 GROUP BY doc_id),
e AS (SELECT l.doc_id, min(l.line_no) AS end_line FROM l JOIN h ON h.doc_id = l.doc_id
      WHERE (contains(l.line, ' | ') OR contains(l.line, 'License')) AND l.line_no > h.header_line
      GROUP BY l.doc_id),
s AS (SELECT l.* FROM l JOIN h ON h.doc_id = l.doc_id LEFT JOIN e ON e.doc_id = l.doc_id
      WHERE l.line_no > h.header_line AND (e.end_line IS NULL OR l.line_no < e.end_line)),
m AS (SELECT doc_id, max(line_no) AS last_line FROM s GROUP BY doc_id)
SELECT s.doc_id, CAST(s.line_no AS INTEGER) AS line_no,
       CASE WHEN s.line_no = m.last_line AND contains(s.line, '*') THEN split_part(s.line, '*', 1) ELSE s.line END AS line
FROM s JOIN m ON m.doc_id = s.doc_id
"""


@query("q23_section_slice", Q23_SQL)
def q23_section_slice(spark, sf):
    """Section slice: lines strictly after the first header line (a short
    heading line) up to the next end marker (a table-junk or license line);
    the last kept line is cut at its first ``*``."""
    section = lines.section_lines(F.col("text"), lambda x: F.length(x) < 25,
                                  lambda x: x.contains(" | ") | x.contains("License"))
    rows = table(spark, sf, "documents").select("doc_id", F.explode(section).alias("s"))
    return rows.select("doc_id", F.col("s.line_no").cast("int").alias("line_no"), F.col("s.line").alias("line"))


@query("q23_first_marker_page", """
SELECT conv_id, min(turn) AS page FROM conversations WHERE contains(text, ',') GROUP BY conv_id
""")
def q23_first_marker_page(spark, sf):
    """First page (turn) of each file (conversation) containing the marker."""
    return lines.first_page_with(table(spark, sf, "conversations"), ["conv_id"], "turn", "text", ",")


@query("q24_rank_in_issue", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS issue_year, CAST(month(o_orderdate) AS INTEGER) AS issue_month,
       row_number() OVER (PARTITION BY year(o_orderdate), month(o_orderdate) ORDER BY o_orderkey) AS weekly_rank
FROM orders
""")
def q24_rank_in_issue(spark, sf):
    """Rank = 1-based position of the event within its issue (two-level
    running count: no single-task window even for a huge issue)."""
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("issue_year"),
                                          F.month("o_orderdate").alias("issue_month"))
    return lines.rank_in_group(o, ["issue_year", "issue_month"], "o_orderkey", "weekly_rank")


@query("q25_rerank_after_filter", """
WITH d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS org_rank FROM documents),
k AS (SELECT * FROM d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1))
SELECT doc_id, source, org_rank, row_number() OVER (PARTITION BY source ORDER BY org_rank) AS rank FROM k
""")
def q25_rerank_after_filter(spark, sf):
    """Exclusion anti join, then re-rank within each report keeping the
    original rank."""
    d = lines.rank_in_group(table(spark, sf, "documents").select("doc_id", "source"), ["source"], "doc_id", "org_rank")
    ex = table(spark, sf, "labels").filter(F.col("toxic") == 1).select("doc_id")
    kept = d.join(ex, "doc_id", "left_anti")
    return lines.rank_in_group(kept, ["source"], "org_rank", "rank").select("doc_id", "source", "org_rank", "rank")
