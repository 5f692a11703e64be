"""Hourly sales whose late rows are kept apart and audited again, store-day by store-day.

The stream keeps a clock of its own: the latest event time of all batches before, less a delay.  A row whose hour was over by
that clock is late; it goes to a side table instead of being dropped.  All other rows are summed per batch, and sums of
batches add up, so no state is held between batches.  A batch reads the clock of the one before it and replaces
its own folders when it runs again, so its result does not depend on failures.

``reaudit`` then works out the store-days that late rows touched from all landed records: their hours, and the
errors of their records.  ``current_hourly`` shows these store-days as worked out last, plus what later batches brought in
time, and the stream's sums for all others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillwarden.operators import audit
from tillwarden.operators.rules import Rule
from tillwarden.streaming.sinks import read_batches, write_batch
from tillwarden.streaming.windows import event_time

HOUR_KEYS = ["store", "business_date", "rtlog_orig_sys", "hour_start"]
STORE_DAY = ["store", "business_date"]


def hourly_by_day(heads: DataFrame, time_col: str = "event_ts") -> DataFrame:
    """Transactions and sales per hour, store-day and channel."""
    sale = F.when(F.col("tran_type") == "SALE", F.col("value"))
    hours = heads.withColumn("hour_start", F.date_trunc("hour", time_col))
    return hours.groupBy(*HOUR_KEYS).agg(
        F.count(F.lit(1)).alias("n_trans"), F.sum(sale).cast("decimal(38,4)").alias("sales")
    )


def _clock_before(spark: SparkSession, path: str, batch_id: int, delay: str) -> Column:
    """The clock a batch goes by; null for the first."""
    if batch_id == 0:
        return F.lit(None).cast("timestamp")
    latest = spark.read.schema("latest timestamp").parquet(f"{path}/clock/batch_id={batch_id - 1}").first()
    return F.lit(latest.latest).cast("timestamp") - F.expr(f"interval {delay}")


def late_batch(batch: DataFrame, path: str, batch_id: int, delay: str = "48 hours", time_col: str = "event_ts") -> None:
    """One micro-batch of headers: sums of the rows in time, the late rows, and the clock."""
    spark = batch.sparkSession
    clock = _clock_before(spark, path, batch_id, delay)
    over = F.date_trunc("hour", F.col(time_col)) + F.expr("interval 1 hour") <= clock
    # a row without a time belongs to no hour and is audited in batch
    late = F.coalesce(over, F.lit(False)) | F.col(time_col).isNull()
    write_batch(hourly_by_day(batch.filter(~late), time_col), f"{path}/hourly", batch_id)
    write_batch(batch.filter(late), f"{path}/late", batch_id)
    before = (
        spark.read.schema("latest timestamp").parquet(f"{path}/clock/batch_id={batch_id - 1}")
        if batch_id
        else spark.createDataFrame([], "latest timestamp")
    )
    seen = batch.agg(F.max(time_col).alias("latest")).unionByName(before)
    write_batch(seen.agg(F.max("latest").alias("latest")), f"{path}/clock", batch_id)


def stream_hourly_late(heads: DataFrame, path: str, delay: str = "48 hours", time_col: str = "event_ts"):
    """Writer of the tables ``hourly``, ``late`` and ``clock`` below a folder."""
    return heads.writeStream.foreachBatch(lambda batch, batch_id: late_batch(batch, path, batch_id, delay, time_col))


def late_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """All rows that came late, with the batch that brought them."""
    return read_batches(spark, f"{path}/late")


def _audited(spark: SparkSession, path: str) -> DataFrame | None:
    return read_batches(spark, f"{path}/reaudited")


def touched_store_days(spark: SparkSession, path: str) -> DataFrame:
    """Store-days of late rows that came after they were last audited again."""
    late = late_rows(spark, path)
    if late is None:
        return spark.createDataFrame([], "store long, business_date date, last_batch long")
    last = late.groupBy(*STORE_DAY).agg(F.max("batch_id").cast("long").alias("last_batch"))
    done = _audited(spark, path)
    if done is None:
        return last
    return last.join(_upto(done), _same_day() & (F.col("last_batch") <= F.col("_b")), "left_anti")


def _same_day() -> Column:
    return F.col("store").eqNullSafe(F.col("_s")) & F.col("business_date").eqNullSafe(F.col("_d"))


def _upto(done: DataFrame) -> DataFrame:
    """The last batch that the newest audit of each store-day has seen."""
    return done.groupBy(F.col("store").alias("_s"), F.col("business_date").alias("_d")).agg(F.max("last_batch").alias("_b"))


def reaudit(spark: SparkSession, path: str, landed: DataFrame, rules: list[Rule] | None = None) -> int:
    """Hours and errors of the touched store-days from all their landed (nested) records, those of the batches so far.

    A run writes the tables ``reaudited``, ``reaudit_hours`` and ``reaudit_errors`` under its own number, the first of them last,
    so a run that failed half-way counts for nothing.  Returns the number of the run.
    """
    done = _audited(spark, path)
    run = 0 if done is None else _last_run(done) + 1
    marks = f"{path}/work-{uuid.uuid4().hex}"
    # the list is fixed first: rows that come meanwhile are for the next run
    clocks = read_batches(spark, f"{path}/clock")
    upto = 0 if clocks is None else clocks.agg(F.max("batch_id").alias("b")).first().b
    touched_store_days(spark, path).withColumn("last_batch", F.lit(upto).cast("long")).write.parquet(marks)
    touched = spark.read.schema("store long, business_date date, last_batch long").parquet(marks)
    days = touched.select(F.col("store").alias("_s"), F.col("business_date").alias("_d"))
    head = F.col("tran_head")
    own = landed.join(
        days, head["store"].eqNullSafe(F.col("_s")) & head["business_date"].eqNullSafe(F.col("_d")), "left_semi"
    )
    timed = event_time(own.select("tran_head.*")).filter("event_ts is not null")
    write_batch(hourly_by_day(timed), f"{path}/reaudit_hours", run)
    write_batch(audit.audit_nested(own, rules), f"{path}/reaudit_errors", run)
    write_batch(touched, f"{path}/reaudited", run)
    return run


def _last_run(done: DataFrame) -> int:
    last = done.agg(F.max("batch_id").alias("run")).first().run
    return -1 if last is None else last


def _newest(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """Rows of the last complete run of each store-day."""
    done = _audited(spark, path)
    rows = read_batches(spark, f"{path}/{table}")
    if done is None or rows is None:
        return None
    last = done.groupBy(F.col("store").alias("_s"), F.col("business_date").alias("_d")).agg(F.max("batch_id").alias("_run"))
    return rows.join(last, _same_day() & (F.col("batch_id") == F.col("_run")), "left_semi")


def current_hourly(spark: SparkSession, path: str) -> DataFrame:
    """Hours of all store-days: audited again where late rows touched them and that was done, else as the stream has them."""
    sums = read_batches(spark, f"{path}/hourly")
    newest = _newest(spark, path, "reaudit_hours")
    if newest is not None:
        seen = _upto(_audited(spark, path))
        later = sums.join(seen, _same_day() & (F.col("batch_id") <= F.col("_b")), "left_anti")
        sums = later.select(*HOUR_KEYS, "n_trans", "sales").unionByName(newest.select(*HOUR_KEYS, "n_trans", "sales"))
    return sums.groupBy(*HOUR_KEYS).agg(
        F.sum("n_trans").alias("n_trans"), F.sum("sales").cast("decimal(38,4)").alias("sales")
    )


def current_errors(spark: SparkSession, path: str) -> DataFrame | None:
    """Errors of the store-days that were audited again."""
    return _newest(spark, path, "reaudit_errors")
