"""Till-log stream to canonical tables, rejects and errors."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from tillwarden.functions import keys as K
from tillwarden.jobs import run_together
from tillwarden.operators import conform
from tillwarden.operators.rules import Rule, nested_facts, run_rules
from tillwarden.streaming.sinks import write_batch


def conform_batch(batch: DataFrame, base: str, batch_id: int, rules: list[Rule] | None = None) -> None:
    """One micro-batch into all its tables; the input is read once."""
    keyed = batch.withColumn("record_key", K.record_key())
    tagged = conform.tag_rejections(keyed).persist(StorageLevel.DISK_ONLY)
    try:
        good = tagged.filter("rejection_reason is null").drop("rejection_reason", "_corrupt")
        tables = conform.fan_out(good) | {
            "_quarantine": tagged.filter("rejection_reason is not null"),
            "error_hits": run_rules(nested_facts(good), rules),
        }
        run_together(
            [lambda n=n, df=df: write_batch(df, f"{base}/{n}", batch_id) for n, df in tables.items()]
        )
    finally:
        tagged.unpersist()


def stream_conform(stream: DataFrame, base: str, rules: list[Rule] | None = None):
    """A stream writer for ``run_available``.

    Row-local rules run here.  Checks across records (repeated and missing
    numbers) need the whole store-day and run on the tables.
    """
    return stream.writeStream.foreachBatch(
        lambda batch, batch_id: conform_batch(batch, base, batch_id, rules)
    )
