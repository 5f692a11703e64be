"""Till logs: newline-delimited JSON in store=/date=/hour= folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillwarden.functions import keys as K
from tillwarden.schemas import RECORD_KEYS, rtlog_schema

PARTITION = ["store", "date", "hour"]

LINES_DDL = "value STRING, store BIGINT, date DATE, hour STRING"


def _parse(lines: DataFrame, *carry: str) -> DataFrame:
    """Lines to nested records; a line with any unreadable part keeps its text in ``_corrupt``.

    The JSON file source parses only the columns a query asks for, and so would
    find a line good or bad depending on the query.  Parsing the text with the
    full schema gives every query the same answer.
    """
    schema = rtlog_schema().add("_corrupt", "string")
    record = F.from_json(
        "value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )
    rows = lines.filter(F.trim("value") != "")
    return rows.select(record.alias("_r"), *PARTITION, *carry).select("_r.*", *PARTITION, *carry)


def read_rtlog(spark: SparkSession, path: str, lineage: bool = False) -> DataFrame:
    """Nested records with a fixed schema.

    Unreadable lines stay, with their text in ``_corrupt``.  Filters on store,
    date and hour prune folders.
    """
    lines = spark.read.schema(LINES_DDL).text(path)
    if not lineage:
        return _parse(lines)
    return _parse(lines.withColumn("source_file", F.col("_metadata.file_path")), "source_file")


def read_rtlog_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines with file lineage and a key per line."""
    return (
        spark.read.schema(LINES_DDL)
        .text(path)
        .filter(F.trim("value") != "")
        .select(
            "value",
            F.sha2("value", 256).alias("record_key"),
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_modification_time").alias("source_modified"),
            *PARTITION,
        )
    )


def stream_rtlog(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """The same records as they land, a bounded number of files per trigger."""
    return _parse(
        spark.readStream.schema(LINES_DDL).option("maxFilesPerTrigger", max_files).text(path)
    )


def with_partition_key(rtlog: DataFrame) -> DataFrame:
    """Folder columns of every record: store, business date, hour of the till clock."""
    head = F.col("tran_head")
    return rtlog.withColumns(
        {
            "store": head["store"],
            "date": head["business_date"],
            "hour": K.wall_hour_text(head["tran_datetime"]),
        }
    )


def partition_counts(rtlog: DataFrame) -> DataFrame:
    """Records per folder."""
    return with_partition_key(rtlog).groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("n_records"))


def write_rtlog(rtlog: DataFrame, path: str, append: bool = False, compression: str | None = None) -> None:
    """Write one JSON object per line into store/date/hour folders.

    By default the folders that receive records are replaced and the others
    are left alone; ``append`` adds files.  Rows are rebalanced by folder:
    small folders share a task and get one file each, a folder that holds a
    large share of the rows is split over tasks and files.  NULLs are written,
    since "absent" and "null" mean different things.  ``compression`` (gzip, lz4) packs the files;
    readers tell by the file name.
    """
    df = with_partition_key(rtlog).select(*RECORD_KEYS, *PARTITION)
    writer = (
        df.hint("rebalance", *[F.col(c) for c in PARTITION])
        .write.partitionBy(*PARTITION)
        .option("ignoreNullFields", "false")
        .option("partitionOverwriteMode", "dynamic")
    )
    writer.mode("append" if append else "overwrite").json(path, compression=compression)


def count_lines(spark: SparkSession, path: str, glob: str = "*.{json,json.gz,json.lz4}") -> DataFrame:
    """Non-blank lines of all matching files below a folder."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .text(path)
        .filter(F.trim("value") != "")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
