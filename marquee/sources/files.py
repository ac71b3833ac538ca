"""File sources and sinks: issue CSVs, dimension CSVs, listings, writers.

One reader call covers a whole directory tree (no per-file driver loop);
partition values come from the file path; lists travel through CSV as JSON
text; writes are partitioned by issue year/month so later reads prune.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions.dates import issue_part
from marquee.functions.text import py_list_text_to_array

LIST_COLUMNS = ["artists", "dates", "promoter", "ticket_prices", "location"]
NUMERIC_COLUMNS = ["gross_receipts_us", "gross_receipts_canadian", "attendance", "capacity", "num_shows",
                   "num_sellouts"]

# processed issue files, in their fixed column order: list columns arrive as
# Python-repr text; numbers are read as text so OCR repair sees every digit.
# Some files name the fifth column ``tickets_sold`` instead of ``attendance``:
# the schema is applied by position, which folds that rename.
PROCESSED_COLUMNS = ["artists", "dates", "gross_receipts_us", "gross_receipts_canadian", "attendance", "capacity",
                     "num_shows", "num_sellouts", "promoter", "ticket_prices", "location", "source_id",
                     "schema_id", "s3_uri"]
CORRUPT = "_corrupt_record"
PROCESSED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in PROCESSED_COLUMNS])

DIMENSION_SCHEMAS = {
    "country": "id int, name string, slug string, abbr string",
    "state": "id int, name string, slug string, abbr string, country_id int",
    "city": "id int, name string, slug string, state_id int",
    "venue": "id int, name string, slug string, city_id int, state_id int",
    "promoter": "id int, name string, slug string",
    "artist": "id int, name string, slug string, parent_id int",
    "special_event": "id int, name string, slug string",
    "source": "id int, name string, slug string, reliability int",
}


def with_issue_columns(df: DataFrame) -> DataFrame:
    """Raw issue rows (with ``_metadata``) -> list columns as arrays, ``row_pos``,
    the issue's year and month from ``.../<year>/<month>/<file>.csv``, and
    ``file``: the full path, so issues of one file name stay apart."""
    df = df.withColumn("path", F.col("_metadata.file_path")).withColumn("row_pos", F.monotonically_increasing_id())
    for c in LIST_COLUMNS:
        df = df.withColumn(c, F.coalesce(py_list_text_to_array(F.col(c)), F.array().cast("array<string>")))
    return (df.withColumn("issue_year", issue_part("path", -3)).withColumn("issue_month", issue_part("path", -2))
            .withColumn("file", F.col("path")))


def _scan_issue_csvs(spark: SparkSession, root: str, encoding: str) -> DataFrame:
    schema = T.StructType([*PROCESSED_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
            .option("encoding", encoding).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("enforceSchema", True).option("columnPruning", False).schema(schema).csv(root).select("*", "_metadata"))


def _is_reject() -> Column:
    """Spark answers no query on the record column alone, so the first cell is read with it."""
    return F.col(CORRUPT).isNotNull() & (F.coalesce(F.col("artists"), F.lit("")) != "\0")


def read_issue_csvs(spark: SparkSession, root: str, encoding: str = "UTF-8") -> DataFrame:
    """All processed issue CSVs under ``root`` (recursive) in one scan.

    The header line is skipped and the fixed schema applied by position; rows
    with too few or too many cells are left to ``read_issue_rejects``;
    ``row_pos`` keeps the row order inside each file (a multi-line CSV file is
    read by one task, in order).
    """
    scan = _scan_issue_csvs(spark, root, encoding)
    return with_issue_columns(scan.filter(~_is_reject()).drop(CORRUPT))


def read_issue_rejects(spark: SparkSession, root: str, encoding: str = "UTF-8") -> DataFrame:
    """Quarantine of ``read_issue_csvs``: (file, record, reason) of every row that does not fit the schema."""
    scan = _scan_issue_csvs(spark, root, encoding)
    return scan.filter(_is_reject()).select(
        F.col("_metadata.file_path").alias("file"), F.col(CORRUPT).alias("record"),
        F.lit("wrong number of cells").alias("reason"))


# The bytes in which windows-1252 differs from ISO-8859-1 (a reader that Spark has), except the five it leaves undefined.
_CP1252 = {b: bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}


def from_cp1252(col: Column) -> Column:
    """Text read as ISO-8859-1 -> the text that its bytes mean in windows-1252."""
    return F.translate(col, "".join(map(chr, _CP1252)), "".join(_CP1252.values()))


def read_mixed_csvs(spark: SparkSession, root: str) -> DataFrame:
    """Processed issue CSVs of different encodings below ``root`` in one plan -> as ``read_issue_csvs``, and ``encoding``, ``reason``.

    Lines are read as bytes.  A file all of whose lines are valid UTF-8 is
    UTF-8; any other is windows-1252, which holds ISO-8859-1's letters at the
    same bytes.  Records are single lines; one with a wrong number of cells
    keeps its text in ``_corrupt_record`` and has a ``reason``.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root).select("value", "_metadata")
    file = F.col("_metadata.file_path")
    kinds = raw.groupBy(file.alias("_file")).agg(F.min(F.is_valid_utf8("value")).alias("_utf8"))
    rows = raw.withColumn("_file", file).join(kinds, "_file")
    line = F.when(F.col("_utf8"), F.col("value")).otherwise(from_cp1252(F.decode(F.col("value").cast("binary"), "ISO-8859-1")))
    rows = rows.withColumn("_line", F.regexp_replace(line, "^\ufeff|\r$", "")) \
        .filter((F.col("_line") != "") & ~F.col("_line").startswith(",".join(PROCESSED_COLUMNS[:2]) + ","))   # the header line
    schema = T.StructType([*PROCESSED_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    cells = F.from_csv("_line", schema.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"', "columnNameOfCorruptRecord": CORRUPT})
    rows = rows.select(cells.alias("_c"), "_metadata", F.when(F.col("_utf8"), "UTF-8").otherwise("windows-1252").alias("encoding"))
    out = with_issue_columns(rows.select("_c.*", "_metadata", "encoding"))
    return out.withColumn("reason", F.when(F.col(CORRUPT).isNotNull(), F.lit("wrong number of cells")))


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """Corrections table in windows-1252: (event_signature, field, true_value,
    seq); ``seq`` is the order in the file, so a later line wins."""
    rows = (spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "ISO-8859-1")
            .schema("event_signature string, field string, true_value string").csv(path))
    return rows.select(*[from_cp1252(F.col(c)).alias(c) for c in rows.columns], F.monotonically_increasing_id().alias("seq"))


def read_dimension(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A dimension CSV with its fixed column list; a missing file is an empty
    dimension (``max(id)`` then starts ids at 1)."""
    schema = DIMENSION_SCHEMAS[name]
    try:
        return spark.read.option("header", True).schema(schema).csv(path)
    except Exception as e:  # noqa: BLE001 - only a missing path is expected here
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def preload_dimensions(spark: SparkSession, csv_root: str, out_root: str) -> None:
    """Write every dimension CSV below ``csv_root`` (``<name>.csv``) as a Parquet table ``out_root/<name>``; a missing file is an empty table."""
    for name in DIMENSION_SCHEMAS:
        read_dimension(spark, f"{csv_root}/{name}.csv", name).write.mode("overwrite").parquet(f"{out_root}/{name}")


def compact_ragged(lines: DataFrame, value: str = "value", sep: str = ",") -> DataFrame:
    """Ragged CSV rows (blank cells in the middle) -> cells shifted left."""
    cells = F.filter(F.split(F.col(value), sep), lambda c: F.trim(c) != "")
    return lines.select(F.array_join(cells, sep).alias(value))


def list_files(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """Object listing with a suffix filter: (path, length, modificationTime);
    file contents are never read (``content`` is pruned)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"*{suffix}").load(root)
            .select("path", "length", "modificationTime"))


def lists_to_json(df: DataFrame) -> DataFrame:
    """Array columns -> JSON text so they survive a CSV round trip."""
    out = df
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            out = out.withColumn(f.name, F.to_json(F.col(f.name)))
    return out


def _salted(df: DataFrame, partition_by: list[str], files_per_value: int) -> DataFrame:
    """Shuffle so each partition value is written by ``files_per_value``
    tasks: bounded file count per directory, and a hot value (one month with
    a third of the rows) is still spread over several writers."""
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(files_per_value))
    return df.repartition(*[F.col(c) for c in partition_by], salt)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  files_per_value: int = 4) -> None:
    w = (_salted(df, partition_by, files_per_value) if partition_by else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def refresh_partitions(df: DataFrame, path: str, partition_by: list[str], files_per_value: int = 4) -> None:
    """Replace the partitions that ``df`` has rows of; the others keep their files."""
    _salted(df, partition_by, files_per_value).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy(*partition_by).parquet(path)


def read_issues(spark: SparkSession, path: str, year: int, month: int | None = None) -> DataFrame:
    """The curated issues of a year or month: only their partitions are listed and read."""
    df = spark.read.parquet(path).filter(F.col("issue_year") == year)
    return df if month is None else df.filter(F.col("issue_month") == month)


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, files_per_value: int = 4) -> None:
    out = lists_to_json(df)
    w = (_salted(out, partition_by, files_per_value) if partition_by else out).write.mode("overwrite") \
        .option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def curated_path(processed_path: Column) -> Column:
    """``.../processed/...`` -> ``.../curated/...`` for the matching output."""
    return F.regexp_replace(processed_path, "/processed/", "/curated/")
