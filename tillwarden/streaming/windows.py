"""De-duplication and hourly sales on event time."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwarden.functions import keys as K
from tillwarden.streaming.sinks import read_batches, write_batch


def stream_dedup(
    stream: DataFrame, time_col: str, key: list[str] | None = None, delay: str = "48 hours"
) -> DataFrame:
    """Drop re-delivered records; a key is remembered for ``delay`` of event time."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(key or ["record_key"])


def hourly_sales(stream: DataFrame, time_col: str, delay: str = "48 hours") -> DataFrame:
    """Sales per hour, store and channel.

    Files arrive by store and hour, not by time, so the delay must cover
    the spread of a delivery; later rows are dropped by the watermark.  ``streaming.late`` keeps them.
    """
    sale = F.col("tran_type") == "SALE"
    return (
        stream.withWatermark(time_col, delay)
        .groupBy(F.window(time_col, "1 hour").alias("w"), "store", "rtlog_orig_sys")
        .agg(
            F.count(F.lit(1)).alias("n_trans"),
            F.sum(F.when(sale, F.col("value"))).cast("decimal(38,4)").alias("sales"),
        )
        .select(
            F.col("w.start").alias("hour_start"), "store", "rtlog_orig_sys", "n_trans", "sales"
        )
    )


def write_hourly(agg: DataFrame, path: str):
    """Changed windows of every batch into a table; read with ``latest_hourly``."""
    return agg.writeStream.outputMode("update").foreachBatch(
        lambda batch, batch_id: write_batch(batch, path, batch_id)
    )


def latest_hourly(spark, path: str) -> DataFrame:
    """The newest state of every window."""
    rows = read_batches(spark, path)
    return (
        rows.groupBy("hour_start", "store", "rtlog_orig_sys")
        .agg(F.max_by(F.struct("n_trans", "sales"), "batch_id").alias("_s"))
        .select("hour_start", "store", "rtlog_orig_sys", "_s.n_trans", "_s.sales")
    )


def event_time(heads: DataFrame) -> DataFrame:
    """Headers with ``event_ts``, the instant of the transaction."""
    return heads.withColumn("event_ts", K.tran_instant("tran_datetime"))
