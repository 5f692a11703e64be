"""Missing transaction numbers on a stream.

The numbers seen are appended to a table by business date; after every batch the
gaps of the touched register-days are recomputed from the dates it touched.
State is a plain table, so a register-day of any size is spread over tasks
like any other data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillwarden.operators import sequence
from tillwarden.operators.spread import same
from tillwarden.streaming.sinks import read_batches, within_span, write_batch

KEYS = sequence.REGISTER_DAY


def gap_batch(heads: DataFrame, base: str, batch_id: int) -> None:
    spark = heads.sparkSession
    seen_path, gap_path = f"{base}/seen", f"{base}/gaps"
    new = heads.select(*KEYS, "tran_no", "tran_type").distinct()
    write_batch(new, seen_path, batch_id, partition_by="business_date")
    this = spark.read.parquet(f"{seen_path}/batch_id={batch_id}")
    touched = this.select(*KEYS).distinct()
    earlier = read_batches(spark, seen_path, before=batch_id)
    known = this
    if earlier is not None:
        relevant = within_span(earlier.drop("batch_id"), touched, "business_date")
        mine = relevant.join(touched, same(relevant, touched, KEYS), "left_semi")
        known = this.unionByName(mine.select(*this.columns))
    gaps = sequence.missing_numbers(known)
    # a touched register-day without gaps leaves a marker, so that it replaces older gaps
    marker = touched.withColumn("tran_no", F.lit(None).cast("long"))
    write_batch(gaps.unionByName(marker), gap_path, batch_id)


def stream_missing_tran(heads: DataFrame, base: str):
    return heads.writeStream.foreachBatch(
        lambda batch, batch_id: gap_batch(batch, base, batch_id)
    )


def current_gaps(spark, base: str) -> DataFrame:
    """Gaps as of the last batch that touched each register-day."""
    rows = read_batches(spark, f"{base}/gaps")
    newest = (
        rows.filter("tran_no is null").groupBy(*KEYS).agg(F.max("batch_id").alias("_b"))
        .select(*[F.col(k).alias(f"_n_{k}") for k in KEYS], "_b")
    )
    on = F.col("batch_id") == F.col("_b")
    for k in KEYS:
        on = on & F.col(k).eqNullSafe(F.col(f"_n_{k}"))
    return rows.filter("tran_no is not null").join(newest, on, "left_semi").select(*KEYS, "tran_no")
