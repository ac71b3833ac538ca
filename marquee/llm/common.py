"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.session import ensure_checkpoint_dir

# Words are runs of anything but ASCII white space.
WHITE = r"[\x20\x09-\x0D]+"
_WHITE_BYTE = re.compile(rb"[\x20\x09-\x0D]")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: what follows survives lost executors, and a result that
    two later steps use is computed once.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand whole texts to Python ``rows`` at a time (the default of 10000 is meant for short rows), on both sides of the pipe."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the id and the text, as ``doc_id`` and ``text`` (null text: empty); other columns cannot clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def word_slices(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in slices of about ``size`` bytes that end at white space, so that no word is cut."""
    if len(text) <= size:
        yield text
        return
    at = 0
    while at < len(text):
        found = _WHITE_BYTE.search(text, at + size)
        end = found.end() if found else len(text)
        yield text[at:end]
        at = end


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; null ids fall into fold -1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds, F.lit(-1))
