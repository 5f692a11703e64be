"""Landing (bronze) tables: append-only, by ingestion date, safe to re-deliver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from tillwarden.operators.sequence import PIECE
from tillwarden.session import work_dir


def _existing_keys(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path).select("record_key")
    except AnalysisException as e:
        # nothing has landed yet
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _once(df: DataFrame) -> DataFrame:
    """Rows with equal ``record_key`` collapsed to one.

    Keys are counted first, so that of the rows only copies are shuffled.  The list of repeated keys is written
    down, which lets Catalyst see how small it is.
    """
    spark = df.sparkSession
    path = work_dir(spark, "repeated-keys")
    counted = df.groupBy("record_key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    counted.select(F.col("record_key").alias("_again")).write.parquet(path)
    again = spark.read.schema("_again string").parquet(path)
    if again.isEmpty():
        return df
    is_copy = F.col("record_key").eqNullSafe(F.col("_again"))
    copies = df.join(again, is_copy, "left_semi").dropDuplicates(["record_key"])
    return df.join(again, is_copy, "left_anti").unionByName(copies)


def _append(new: DataFrame, path: str, ingest_date: Column | str | None) -> None:
    """Append rows with distinct keys, but for those that have landed before."""
    if ingest_date is None:
        day = F.current_date()
    else:
        day = F.lit(ingest_date).cast("date") if isinstance(ingest_date, str) else ingest_date
    known = _existing_keys(new.sparkSession, path)
    if known is not None:
        new = new.join(known, "record_key", "left_anti")
    new.withColumn("ingest_date", day).write.mode("append").partitionBy("ingest_date").parquet(path, compression="zstd")


def land_bronze(df: DataFrame, path: str, ingest_date: Column | str | None = None) -> None:
    """Append rows whose ``record_key`` has not landed before.

    Copies inside the delivery collapse first, then an anti-join drops what is already there.
    """
    _append(_once(df), path, ingest_date)


def _keyed(df: DataFrame) -> DataFrame:
    """Rows keyed by file, content and which of the file's equal rows they are.

    Equal rows of a file are separate records; a file that comes again adds nothing.  Equal rows are counted
    with partial sums and written out again, long runs of them in shuffled pieces.
    """
    columns = df.columns
    row = F.to_json(F.struct(*[F.col(c) for c in columns]), {"ignoreNullFields": "false"})
    told = df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.sha2(row, 256)})
    # grouping makes -0.0 to 0.0, so columns with such numbers are carried instead; they are equal in a group
    carried = [f.name for f in df.schema if any(t in f.dataType.simpleString() for t in ("float", "double"))]
    groups = [c for c in columns if c not in carried]
    counted = told.groupBy("_file", "_row", *groups).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in carried]
    )
    piece = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"), F.lit(PIECE).cast("long"))).alias("_piece")
    few = counted.filter(F.col("_n") <= PIECE).withColumn("_piece", F.lit(1).cast("long"))
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = counted.filter(F.col("_n") > PIECE).select("*", piece).repartition(n_parts, "_file", "_row", "_piece")
    last = F.least(F.col("_piece") + PIECE - 1, F.col("_n"))
    numbered = few.unionByName(many).select(*columns, "_file", "_row", F.explode(F.sequence("_piece", last)).alias("_copy"))
    key = F.sha2(F.concat_ws("|", "_file", "_row", F.col("_copy").cast("string")), 256)
    return numbered.select(*columns, key.alias("record_key"))


def land_csv(
    spark: SparkSession, source: str, schema: str, path: str, ingest_date: str | None = None, **options
) -> None:
    """Land CSV files of another channel under a given schema."""
    df = spark.read.schema(schema).options(header="true", **options).csv(source)
    _append(_keyed(df), path, ingest_date)


def land_json(
    spark: SparkSession, source: str, schema: str, path: str, ingest_date: str | None = None, **options
) -> None:
    """Land JSON-lines files of another channel under a given schema."""
    df = spark.read.schema(schema).options(**options).json(source)
    _append(_keyed(df), path, ingest_date)
