"""Canonical tables on disk: Parquet by store and business date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from tillwarden.functions import keys as K
from tillwarden.jobs import run_together
from tillwarden.schemas import PARTITION_COLUMNS


def write_table(df: DataFrame, path: str, append: bool = False) -> None:
    """Write one table, replacing the store-days it touches (or all of it if it has none).

    Rows are rebalanced by store and date: small store-days share a task, a very
    large one is split over tasks and files.  Record keys are packed on the way.
    """
    mode = "append" if append else "overwrite"
    if not set(PARTITION_COLUMNS) <= set(df.columns):
        df.write.mode(mode).parquet(path, compression="zstd")
        return
    keyed = ["record_key"] if dict(df.dtypes).get("record_key") == "string" else []
    packed = df.withColumns({c: K.packed(c) for c in keyed}).hint("rebalance", *[F.col(c) for c in PARTITION_COLUMNS])
    (
        packed.withColumns({c: K.unpacked(c) for c in keyed})
        .write.partitionBy(*PARTITION_COLUMNS)
        .option("partitionOverwriteMode", "dynamic")
        .mode(mode)
        .parquet(path, compression="zstd")
    )


def write_canonical(
    tables: dict[str, DataFrame], base: str, append: bool = False, touched: DataFrame | None = None
) -> None:
    """Write tables below ``base``; they are independent, so several are written at a time.

    With ``touched`` (store, business_date), store-days of that list that a table had rows for and
    gets none any more are emptied.
    """

    def write(name: str, df: DataFrame) -> None:
        emptied = emptied_store_days(df, f"{base}/{name}", touched) if touched is not None else []
        write_table(df, f"{base}/{name}", append)
        remove_store_days(df.sparkSession, f"{base}/{name}", emptied)

    run_together([lambda n=n, df=df: write(n, df) for n, df in tables.items()])


def emptied_store_days(df: DataFrame, path: str, touched: DataFrame) -> list[tuple[int, date]]:
    """Touched store-days that have rows in the table at ``path`` and none in ``df``.

    Only partition columns are read of the old table.  Most runs touch no store-day that is there already, and
    end with that look.
    """
    if not set(PARTITION_COLUMNS) <= set(df.columns):
        return []
    spark = df.sparkSession
    try:
        old = spark.read.schema(df.schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    days = touched.select(*[F.col(c).alias(f"_{c}") for c in PARTITION_COLUMNS])

    def within(rows: DataFrame) -> DataFrame:
        own = rows.select(*PARTITION_COLUMNS)
        return own.join(days, [own[c] == F.col(f"_{c}") for c in PARTITION_COLUMNS], "left_semi").distinct()

    there = [tuple(r) for r in within(old).collect()]  # store-days of one run that were delivered before
    if not there:
        return []
    now = {tuple(r) for r in within(df).collect()}
    return [day for day in there if day not in now]


def remove_store_days(spark: SparkSession, path: str, store_days: list[tuple[int, date]]) -> None:
    """Delete the folders of store-days; one that is gone already is fine, so a repeated run does no harm."""
    for day in store_days:
        values = "/".join(f"{c}={v}" for c, v in zip(PARTITION_COLUMNS, day, strict=True))
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{values}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_quarantine(bad: DataFrame, path: str) -> None:
    """Rejected records by ingestion date: a run replaces those of its own date and keeps all others."""
    (
        bad.write.partitionBy("ingest_date").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    )


def read_canonical(spark: SparkSession, base: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A table below ``base``; with its schema, a table without any row is read as well."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{base}/{name}")
