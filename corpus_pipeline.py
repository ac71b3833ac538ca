"""The corpus pipeline: documents to packed training sequences.

Five stages, each on all rows that the one before has kept; each result is
written to the shared folder as Parquet and read again, so a lost executor
repeats a part of one stage only.  All stages but the last return the columns
of ``documents``.

Rows are judged one by one; rows that repeat both id and text are judged alike.
A row without id passes through the near-duplicate stage, and of rows that
repeat an id that stage keeps one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import neardup, packing, quality, substrings, toxicity
from marquee.llm.common import bounded_batches, documents, saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or lie far outside the bulk of their language and source."""
    name = next(n for n in ("row", *(f"row{k}" for k in range(len(docs.columns)))) if n not in docs.columns)
    row = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.coalesce("text", F.lit("")), F.col("doc_id").isNull())
    rows = docs.select(row.alias(name), *docs.columns)
    judged = quality.score_quality(rows, id_col=name)
    good = judged.filter("kept").select(F.col("doc_id").alias(name))
    return rows.join(good, name, "left_semi").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score as toxic."""
    bounded_batches(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    bounded_batches(spark)
    found = neardup.near_duplicates(docs)
    keep = found.filter("kept and doc_id is not null").select("doc_id").distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    one = docs.join(keep, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("r"))
    return one.select(*[F.col(c) if c == "doc_id" else F.col(f"r.{c}") for c in docs.columns]).unionByName(docs.filter("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of 100 bytes or more that an earlier document holds; documents stay, with what is left of their text."""
    bounded_batches(spark)
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    out = substrings.remove_repeats(docs, carry=others, as_text=True)
    column = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[column.get(c, F.col(f"extra.{c}")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences of 2048."""
    bounded_batches(spark)
    return packing.pack_sequences(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [("quality_rules", quality_rules), ("toxicity", drop_toxic), ("near_duplicates", near_duplicates),
          ("suffix_dedup", repeated_passages), ("packing", pack)]

# SQL cannot express the estimates, the learned lexicon or the tokenizer: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
