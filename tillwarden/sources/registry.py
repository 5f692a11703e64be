"""The store registry, a CSV file with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

REGISTRY_DDL = (
    "store_no STRING, store_name STRING, tills STRING, country STRING, "
    "local_currency STRING, exchange_rate_to_usd STRING"
)


def read_stores_all(spark: SparkSession, path: str) -> DataFrame:
    """Every row, typed and trimmed."""
    raw = spark.read.schema(REGISTRY_DDL).option("header", "true").csv(path)
    return raw.select(
        F.trim("store_no").cast("long").alias("store_no"),
        F.trim("store_name").alias("store_name"),
        F.trim("tills").cast("int").alias("tills"),
        F.trim("country").alias("country"),
        F.trim("local_currency").alias("local_currency"),
        F.trim("exchange_rate_to_usd").cast("decimal(10,4)").alias("exchange_rate_to_usd"),
    )


def read_stores(spark: SparkSession, path: str) -> DataFrame:
    """One row per store number.

    Rows of a distributed read have no order, so of repeated numbers the
    greatest row survives (a repeatable choice); ``repeated_stores`` lists them.
    """
    rows = read_stores_all(spark, path)
    rest = [c for c in rows.columns if c != "store_no"]
    return (
        rows.groupBy("store_no")
        .agg(F.max(F.struct(*rest)).alias("_row"))
        .select("store_no", "_row.*")
    )


def repeated_stores(stores: DataFrame) -> DataFrame:
    return stores.groupBy("store_no").agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")
