"""Header revisions on a stream of header versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwarden.operators import sequence, spread
from tillwarden.operators.spread import same
from tillwarden.streaming.sinks import read_batches, within_span, write_batch


def revision_batch(
    changes: DataFrame,
    path: str,
    batch_id: int,
    key: list[str],
    order: list[str],
    bucket: Column,
    compare: list[str],
    date_col: str | None = None,
) -> None:
    """Append the real changes of one batch with continued revision numbers.

    ``date_col`` names a key column (the business date) to partition the history
    by; a batch then reads only the dates it touches.
    """
    spark = changes.sparkSession
    earlier = read_batches(spark, path, before=batch_id)
    if earlier is None:
        first = sequence.head_revisions(changes, key, order, bucket, compare)
        write_batch(first, path, batch_id, date_col)
        return
    if date_col:
        earlier = within_span(earlier, changes, date_col)
    touched = changes.select(*key).distinct()
    mine = earlier.join(touched, same(earlier, touched, key), "left_semi")
    others = [c for c in changes.columns if c not in key]
    latest = mine.groupBy(*key).agg(
        F.max_by(F.struct(*others), "rev_no").alias("_row"), F.max("rev_no").alias("_rev")
    )
    known = latest.select(*key, "_row.*", F.col("_rev"))
    # the newest known state takes part as the version before the batch; a
    # version older than that is appended like any other change
    rows = changes.withColumn("_rev", F.lit(None).cast("long")).unionByName(known)
    real = sequence.real_changes(rows, key, order, bucket, compare).filter(F.col("_rev").isNull())
    numbered = spread.with_row_number(
        real.drop("_rev"), key, [F.col(c) for c in order], bucket, "_version"
    )
    base = known.select(*[F.col(k).alias(f"_b_{k}") for k in key], F.col("_rev").alias("_base"))
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in key])
    out = (
        numbered.join(base, on, "left")
        .withColumn("rev_no", F.col("_version") + F.coalesce("_base", F.lit(-1)))
        .select(*changes.columns, "rev_no")
    )
    write_batch(out, path, batch_id, date_col)


def stream_head_rev(
    changes: DataFrame,
    path: str,
    key: list[str],
    order: list[str],
    bucket: Column,
    compare: list[str],
    date_col: str | None = None,
):
    return changes.writeStream.foreachBatch(
        lambda batch, batch_id: revision_batch(
            batch, path, batch_id, key, order, bucket, compare, date_col
        )
    )


def read_revisions(spark, path: str) -> DataFrame:
    return read_batches(spark, path).drop("batch_id")
