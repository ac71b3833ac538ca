"""Secrets in texts, told apart by who holds them in the corpus.

Base patterns (assignments, access keys, long hexadecimal runs) find spans in
every text.  On top of them any long run of credential characters that looks
random is a candidate.  The value of every span is hashed, and the hashes are
counted over the corpus by distinct repositories and distinct owners: a value
that ``EXAMPLE_OWNERS`` owners or more hold is a copied example (a sample from
a manual, a lock file's checksum); one that fewer hold belongs to them.
Candidates of the second sort are added as spans of kind ``owned``; base spans
stay whatever their count, and say with ``live`` which sort they are.

Scale: texts are read once, where they lie, and only spans go on.  Counting
drops repeats of (value, repository, owner) before and after the shuffle, so a
value on a third of all rows is a row per repository, spread by repository.  On
the way back the values with more than a thousandth of all spans - at most a
thousand - are broadcast, and no other value is frequent enough to make a large
partition of the join.

Rows are told apart by a number of their own, so repeated rows and null ids get
a row each; repeated rows count as one repository.  Null and empty texts have no
spans.  A null owner or repository counts as one more, unnamed one.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import saved

EXAMPLE_OWNERS = 3
HOT_SHARE = 1000  # values with more than 1 / HOT_SHARE of all spans are broadcast: fewer than HOT_SHARE of them

# Fixed by the task: the base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
KEYWORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "owned")

# Runs of credential characters that can hold an access key, a hexadecimal run or a candidate.
LONG = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}")
CANDIDATE = 20  # least characters of a candidate
_DIGITS, _UPPER, _LOWER, _HEXADECIMAL = (re.compile(p) for p in ("[0-9]+", "[A-Z]", "[a-z]", "[0-9A-Fa-f]+"))

SPAN = "struct<kind: string, start: long, end: long, secret: string, random: boolean>"


def looks_random(value: str) -> bool:
    """Whether a value could be a generated key: letters and digits well mixed.

    Hexadecimal values need 8 different characters and four separate runs of
    digits; others capitals, small letters, three runs of digits and 12
    different characters.  Words, numbers, paths and rulers fail.
    """
    runs, different = len(_DIGITS.findall(value)), len(set(value))
    if _HEXADECIMAL.fullmatch(value):
        return different >= 8 and runs >= 4
    return different >= 12 and runs >= 3 and bool(_UPPER.search(value)) and bool(_LOWER.search(value))


def spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of the base spans and of the candidates (kind ``owned``) that no base span covers."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found = [("assign", m.start(), m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    covered = [(a, b) for _, a, b, _ in found]
    for run in LONG.finditer(text):
        a, value = run.start(), run.group()
        own = [(kind, a + m.start(), a + m.end(), m.group()) for kind, pattern in (("access", ACCESS), ("hex", HEX))
               for m in pattern.finditer(value) if m.end() - m.start() >= LEAST[kind]]
        found += own
        core = value.strip("=/+-_")
        if len(core) >= CANDIDATE and not own and looks_random(core):
            a += value.index(core)
            if not any(s < a + len(core) and a < e for s, e in covered):
                found.append(("owned", a, a + len(core), core))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """(row, doc_id, repo, owner, spans): one row per row of ``docs``; values as sha256."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("secret", pa.string()), ("random", pa.bool_())]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for text in rows.column("text"):
                out.append([{"kind": k, "start": a, "end": b, "secret": hashlib.sha256(v.encode()).hexdigest(), "random": looks_random(v)}
                            for k, a, b, v in spans(text.as_py())])
            yield pa.RecordBatch.from_arrays([*rows.columns[:4], pa.array(out, kind)], names=["row", "doc_id", "repo", "owner", "spans"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(read, f"row long, doc_id long, repo string, owner string, spans array<{SPAN}>")


def ownership(found: DataFrame) -> DataFrame:
    """(secret, n_spans, n_repos, n_owners): how many spans, distinct repositories and distinct owners hold each value."""
    named = {c: F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("repo", "owner")}
    return found.select(F.explode("spans.secret").alias("secret"), *[v.alias(c) for c, v in named.items()]).groupBy("secret") \
        .agg(F.count("*").alias("n_spans"), F.count_distinct("repo").alias("n_repos"), F.count_distinct("owner").alias("n_owners"))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_col: str = "doc_id") -> DataFrame:
    """(doc_id, spans): the spans of every text by start and kind, each with how many repositories and owners hold its
    value and whether it is live: looks random, and fewer than EXAMPLE_OWNERS owners hold it.

    Spans of kind ``owned`` are there only where they are live.  A document is a
    repository of its own unless ``repo_col`` names something larger.
    """
    found = saved(scan(docs, id_col, text_col, owner_col, repo_col), "spans")
    holders = saved(ownership(found), "holders")
    hot = holders.crossJoin(F.broadcast(holders.agg(F.sum("n_spans").alias("total")))) \
        .filter(F.col("n_spans") * HOT_SHARE > F.col("total")).select("secret", "n_repos", "n_owners")
    each = found.select("row", F.explode("spans").alias("s")).select("row", "s.*")
    frequent = each.join(F.broadcast(hot), "secret")
    others = each.join(F.broadcast(hot.select("secret")), "secret", "left_anti").join(holders.drop("n_spans"), "secret")
    judged = frequent.unionByName(others).withColumn("live", F.col("random") & (F.col("n_owners") < EXAMPLE_OWNERS)) \
        .filter("kind <> 'owned' or live")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", order.alias("place"), "kind", "end", "live", "n_repos", "n_owners")
    per_row = judged.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    plain = F.transform("spans", lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "live", "n_repos", "n_owners")]))
    kind = "array<struct<kind: string, start: bigint, end: bigint, live: boolean, n_repos: bigint, n_owners: bigint>>"
    return found.select("row", "doc_id").join(per_row, "row", "left") \
        .select("doc_id", F.coalesce(plain, F.array().cast(kind)).alias("spans"))
