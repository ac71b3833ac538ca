"""Registered queries of the training-data operators (DuckDB SQL where SQL can express them)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import bpe, fingerprint, langid, neardup, packing, quality, runs, search, secrets, substrings, tokenfile, toxicity, warc
from marquee.llm.common import bounded_batches, documents, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bounded_batches(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return register


@query("op1_token_files")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op2_suffix_dedup", """
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, s, md5(substr(h, 2 * s + 1, 200)) AS g FROM (SELECT doc_id, h, unnest(range(greatest(n - 99, 0))) AS s FROM d)
), m AS (
  SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) > 1 AS later FROM w
), r AS (
  SELECT doc_id, s, CASE WHEN s - lag(s) OVER (PARTITION BY doc_id ORDER BY s) <= 100 THEN 0 ELSE 1 END AS fresh FROM m WHERE later
), k AS (
  SELECT doc_id, s, sum(fresh) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM r
), spans AS (
  SELECT doc_id, run, min(s) AS a, max(s) + 100 AS b FROM k GROUP BY ALL
), kept AS (
  SELECT doc_id, a AS stop, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS start FROM spans
  UNION ALL SELECT d.doc_id, d.n, coalesce(x.b, 0) FROM d LEFT JOIN (SELECT doc_id, max(b) AS b FROM spans GROUP BY doc_id) x ON x.doc_id = d.doc_id
), t AS (
  SELECT kept.doc_id, string_agg(substr(h, 2 * start + 1, 2 * (stop - start)), '' ORDER BY start, stop) AS h FROM kept JOIN d ON d.doc_id = kept.doc_id GROUP BY kept.doc_id
), c AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS n_spans FROM spans GROUP BY doc_id
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_bytes, CAST(coalesce(c.removed, 0) AS BIGINT) AS n_removed, coalesce(c.n_spans, 0) AS n_spans, sha256(unhex(t.h)) AS kept_sha256
FROM d JOIN t ON t.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op3_near_duplicates", """
WITH RECURSIVE w AS (
  SELECT doc_id, [x FOR x IN regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+') IF x <> ''] AS words FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, len(words) - 3)] END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS hits FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * hits >= 75 * (x.n + y.n - hits)
), r AS (
  SELECT doc_id, doc_id AS reach FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reach
), c AS (
  SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id
)
SELECT c.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir))


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.score_toxicity(docs, toxicity.train(docs, labels))


@query("op5_fingerprints")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, sf_dir))


@query("op6_warc", """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, strlen(html) AS payload_bytes, sha1(html) || '00' AS h, max(page_id) OVER (PARTITION BY html) AS keeper FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(h, 1 + (5 * i) // 4, 3) AS INTEGER) >> CAST(7 - (5 * i) % 4 AS INTEGER)) & 31), 1) FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM d
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir.rstrip('/')}/pages.parquet")
    archives = warc.write_warc(pages, scratch(spark, "warc"))
    return warc.page_records(warc.read_warc(archives, with_payload=False))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.score_quality(documents(spark, sf_dir))
    return scored.drop(*quality.X)


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.train(docs))


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_sequences(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                              public_tokenizers.PATTERN)


@query("op11_periodic_runs", r"""
WITH h AS (
  SELECT doc_id, text, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))) AS inverted FROM documents
), d AS (
  SELECT doc_id, xor(inverted, 4294967295) AS h, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w FROM h
), g AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS chosen, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a, 3 + (h // 10) % 8 AS parts FROM d
), p AS (
  SELECT doc_id, n, CASE WHEN chosen THEN list_transform(range(n), lambda i: w[CAST(1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END AS BIGINT)]) ELSE w END AS w FROM g
), grams AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 5], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(greatest(n - 4, 0))) AS i FROM p)
), pairs AS (
  SELECT x.doc_id, x.i, y.i - x.i AS lag FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i
), stretches AS (
  SELECT doc_id, lag, min(i) AS start, max(i) + 5 + lag - min(i) AS length
  FROM (SELECT doc_id, lag, i, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM pairs) GROUP BY doc_id, lag, island
), long AS (
  SELECT * FROM stretches WHERE length >= greatest(6, 4 * lag)
), found AS (
  SELECT * FROM long r WHERE NOT EXISTS (SELECT 1 FROM long s WHERE s.doc_id = r.doc_id AND s.lag < r.lag AND s.start <= r.start AND s.start + s.length >= r.start + r.length)
), per_doc AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || lag || chr(10), '' ORDER BY start, lag) AS listing FROM found GROUP BY doc_id
), best AS (
  SELECT r.doc_id, r.start, r.length, r.lag AS period FROM found r
  WHERE NOT EXISTS (SELECT 1 FROM found s WHERE s.doc_id = r.doc_id AND (s.length * r.lag > r.length * s.lag
    OR s.length * r.lag = r.length * s.lag AND (s.start < r.start OR s.start = r.start AND s.lag < r.lag)))
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start + lag, start + length)) AS i FROM found
), each_word AS (
  SELECT doc_id, unnest(range(n)) AS i, unnest(w) AS word FROM p
), kept AS (
  SELECT e.doc_id, string_agg(word, ' ' ORDER BY e.i) AS t FROM each_word e LEFT JOIN gone ON gone.doc_id = e.doc_id AND gone.i = e.i WHERE gone.i IS NULL GROUP BY e.doc_id
)
SELECT p.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start, CAST(b.length AS BIGINT) AS length, CAST(b.period AS BIGINT) AS period,
  CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli, sha256(coalesce(listing, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM p LEFT JOIN per_doc ON per_doc.doc_id = p.doc_id LEFT JOIN best b ON b.doc_id = p.doc_id LEFT JOIN kept ON kept.doc_id = p.doc_id
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(runs.with_planted_runs(documents(spark, sf_dir))).withColumn("best", runs.strongest(F.col("runs")))
    listing = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    best = [F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")]
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *best,
                        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                        F.sha2(listing.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


_LOOKS_RANDOM = """CASE WHEN regexp_full_match({v}, '[0-9A-Fa-f]+') THEN len(list_distinct(string_split({v}, ''))) >= 8 AND len(regexp_extract_all({v}, '[0-9]+')) >= 4
    ELSE len(list_distinct(string_split({v}, ''))) >= 12 AND len(regexp_extract_all({v}, '[0-9]+')) >= 3 AND regexp_matches({v}, '[A-Z]') AND regexp_matches({v}, '[a-z]') END"""
_ASSIGN = r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


@query("op12_secrets", rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), m AS (
  SELECT doc_id, source, 1 AS place, 'assign' AS kind, regexp_split_to_array(t, '{_ASSIGN}') AS gaps, regexp_extract_all(t, '{_ASSIGN}') AS found, regexp_extract_all(t, '{_ASSIGN}', 2) AS held FROM d
  UNION ALL SELECT doc_id, source, 2, 'access', regexp_split_to_array(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') AS f, f FROM d
  UNION ALL SELECT doc_id, source, 3, 'hex', regexp_split_to_array(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') AS f, f FROM d
  UNION ALL SELECT doc_id, source, 4, 'owned', regexp_split_to_array(t, '[A-Za-z0-9+/_=-]+'), regexp_extract_all(t, '[A-Za-z0-9+/_=-]+') AS f, f FROM d
), e AS (
  SELECT doc_id, source, place, kind, unnest(gaps[:len(found)]) AS gap, unnest(found) AS f, unnest(held) AS v, unnest(range(len(found))) AS k FROM m
), s AS (
  SELECT doc_id, source, place, kind, f, v, sum(length(gap) + length(f)) OVER (PARTITION BY doc_id, place ORDER BY k) AS stop FROM e
), base AS (
  SELECT doc_id, source, place, kind, stop - length(f) AS start, stop, v FROM s WHERE length(v) >= CASE kind WHEN 'assign' THEN 8 WHEN 'access' THEN 16 WHEN 'hex' THEN 32 END
), wide AS (
  SELECT doc_id, source, place, kind, stop - length(ltrim(f, '=/+-_')) AS start, stop - length(ltrim(f, '=/+-_')) + length(trim(f, '=/+-_')) AS stop, trim(f, '=/+-_') AS v FROM s
  WHERE kind = 'owned' AND length(trim(f, '=/+-_')) >= 20 AND NOT regexp_matches(f, '[0-9a-f]{{32,}}|AKIA[A-Z0-9]{{12,}}')
), more AS (
  SELECT * FROM wide w WHERE {_LOOKS_RANDOM.format(v="v")} AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.place = 1 AND b.start < w.stop AND w.start < b.stop)
), spans AS (
  SELECT * FROM base UNION ALL SELECT * FROM more
), holders AS (
  SELECT v, count(DISTINCT coalesce('=' || source, '')) < 3 AS few FROM spans GROUP BY v
), judged AS (
  SELECT doc_id, place, kind, start, kind || ':' || start || ':' || stop AS span, few AND {_LOOKS_RANDOM.format(v="spans.v")} AS live FROM spans JOIN holders ON holders.v = spans.v
), per_doc AS (
  SELECT doc_id, count(*) FILTER (place = 1) AS n_assign, count(*) FILTER (place = 2) AS n_access, count(*) FILTER (place = 3) AS n_hex,
    string_agg(span, ',' ORDER BY start, place) FILTER (place < 4) AS base, string_agg(span, ',' ORDER BY start, place) AS spans,
    string_agg(span, ',' ORDER BY start, place) FILTER (live) AS live
  FROM judged WHERE place < 4 OR live GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(live, '') AS live
FROM d LEFT JOIN per_doc ON per_doc.doc_id = d.doc_id
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir))
    joined = lambda some: F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] != "owned")
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in secrets.KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"),
                        joined(F.filter("spans", lambda s: s["live"])).alias("live"))


@query("op13_lexical_search", r"""
WITH t AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), d AS (
  SELECT row, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM t WHERE len(w) > 0
), c AS (
  SELECT count(*) AS nn, CAST(coalesce(sum(n), 0) AS BIGINT) AS ll FROM d
), tf AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY row, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * CAST(any_value(nn) AS DOUBLE) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term
), q AS (
  SELECT item_id, text, term, count(*) AS times FROM (
    SELECT item_id, text, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL
), s AS (
  SELECT q.item_id, q.text, d.row, d.doc_id, CAST(sum(times * w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * d.n * nn) // ll)))) AS BIGINT) AS score
  FROM q JOIN w ON w.term = q.term JOIN tf ON tf.term = q.term JOIN d ON d.row = tf.row, c GROUP BY ALL
), r AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return search.search(search.build_index(documents(spark, sf_dir)), items, 20)
