"""Idempotent table sinks for ``foreachBatch``.

A micro-batch writes to its own ``batch_id=N`` folder and replaces it when it
is run again after a failure, so every sink sees each batch exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: str | None = None) -> None:
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/batch_id={batch_id}")


def within_span(history: DataFrame, batch: DataFrame, column: str) -> DataFrame:
    """History rows in the span of a column's values in the batch.

    When history is partitioned by that column, other folders are not read.
    """
    span = batch.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return history.filter(
        F.col(column).between(span.select("lo").scalar(), span.select("hi").scalar())
    )


def read_batches(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """All batches, or those before a given one; None when there is none yet."""
    try:
        df = spark.read.option("basePath", path).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return df if before is None else df.filter(F.col("batch_id") < before)


def run_available(stream_writer, checkpoint: str):
    """Start a query over everything that has arrived, and wait for it."""
    q = stream_writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q
