"""Incremental curation: new processed issue files are picked up by a file
stream and each micro-batch runs the same batch functions.

The batch engine is the source of truth; streaming only schedules it.  With
``trigger(availableNow=True)`` every file present is processed once (in as
many micro-batches as the rate limit needs) and the query stops; the
checkpoint remembers which files were done, so a rerun only sees new files.
Each batch first writes its new dimension members under its number, then its
events; the next batch starts from all members written before it, so an id is
given once.  Duplicates across batches are suppressed by the event signature:
rows whose signature is already in the event table are dropped (anti join) --
the same contract as an insert-or-ignore on a unique key.
"""

from __future__ import annotations

from dataclasses import fields, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators.curate import Dimensions, curate_events
from marquee.sources.files import PROCESSED_SCHEMA, with_issue_columns


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None before its first write."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def load_dimensions(spark: SparkSession, dims: Dimensions, path: str, before: int) -> Dimensions:
    """``dims`` and the members that batches before number ``before`` have added."""
    grown = {}
    for f in fields(dims):
        added = _existing(spark, f"{path}/{f.name}")
        if added is not None:
            base = getattr(dims, f.name)
            added = added.filter(F.col("batch") < before).drop("batch")
            grown[f.name] = base.unionByName(added.select(*[c for c in base.columns if c in added.columns]), allowMissingColumns=True)
    return replace(dims, **grown)


def start_ingest(spark: SparkSession, processed_root: str, events_path: str, checkpoint: str,
                 dims: Dimensions, max_files_per_trigger: int = 100, dims_path: str | None = None,
                 corrections: DataFrame | None = None):
    """Start the availableNow stream; returns the StreamingQuery.

    ``corrections`` are applied to every batch as they are when it runs.

    ``dims`` are the dimensions before the first batch; new members are kept
    below ``dims_path`` (by default beside the events), one folder per batch,
    which a batch that runs again overwrites.
    """
    dims_path = dims_path or f"{events_path.rstrip('/')}_dimensions"
    stream = (spark.readStream.schema(PROCESSED_SCHEMA).option("header", True).option("multiLine", True)
              .option("escape", '"').option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
              .option("maxFilesPerTrigger", max_files_per_trigger).csv(processed_root)
              .select("*", "_metadata"))

    def run_batch(batch: DataFrame, epoch: int) -> None:
        curated, members = curate_events(with_issue_columns(batch), load_dimensions(spark, dims, dims_path, epoch), corrections)
        for name, new in members.items():
            new.write.mode("overwrite").parquet(f"{dims_path}/{name}/batch={epoch}")
        known = _existing(spark, events_path)
        if known is not None:
            curated = curated.join(known.select("signature"), "signature", "left_anti")
        # first copy of a signature inside this batch wins (file, rank order)
        first = curated.groupBy("signature").agg(F.min(F.struct("file", "weekly_rank")).alias("_f"))
        curated = (curated.join(first, "signature")
                   .filter(F.struct("file", "weekly_rank") == F.col("_f")).drop("_f"))
        curated.write.mode("append").partitionBy("issue_year", "issue_month").parquet(events_path)

    return (stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
