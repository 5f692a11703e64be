"""Exact group operations that stay spread out when one group is huge.

A window over a group, or a join on a key, puts all rows of one key into one
task.  The helpers here give the same results while splitting such groups:

* ``with_repeated_key``  rows whose key occurs more than once
* ``with_row_number``    row numbers in a group, from per-bucket counts
* ``with_previous``      the previous value in a group, across buckets
* ``split_by_size``      rows of groups that fit a task, and those of groups that may not

The bucket is a coarse, order-preserving function of the first sort column
(an hour of a timestamp, ``id div 65536``, the top bits of a hash), so
a group is split into ordered pieces that are sorted independently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwarden.session import work_dir

# A key is hot when it holds more than 1/HOT_FRACTION of all rows.  At most
# HOT_FRACTION - 1 keys can do so, whatever the data, so the list of hot keys
# is always small enough to broadcast.
HOT_FRACTION = 10_000

# Groups are told apart by the rows of their hash slot: a slot with at most GROUP_ROWS rows, or four times the
# mean, holds no group that a task could not take.
SLOTS, GROUP_ROWS = 1 << 13, 100_000


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of the key columns."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _as_one(columns: list[str]) -> Column:
    """Columns as one value that is never null, and equal where all parts are equal or both null.

    A join on it leaves the rows as a window over it needs them, so they are shuffled once.
    """
    return F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])


def _restored(df: DataFrame, group: list[str]) -> list[Column]:
    """The columns of a frame, those of the group taken from ``_group``, so that rows carry them once."""
    return [F.col(f"_group._{group.index(c)}").alias(c) if c in group else F.col(c) for c in df.columns]


def with_repeated_key(df: DataFrame, keys: list[str], count_col: str = "n_rows") -> DataFrame:
    """Rows whose key occurs more than once, with the number of occurrences.

    Counting combines on the map side.  Counts of hot keys (few by
    construction) reach the rows by broadcast; all other repeated keys by a
    join in which no key is larger than 1/HOT_FRACTION of the table.  If that
    join shuffles, hot rows take part under the number of their input
    partition, so they stay spread; the rows are scanned once.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    is_hot = F.col("_n") * HOT_FRACTION > total

    def renamed(prefix: str) -> list[Column]:
        return [F.col(k).alias(f"{prefix}{k}") for k in keys]

    def match(prefix: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])

    hot = counts.filter(is_hot).select(*renamed("_h_"), F.col("_n").alias("_hot_n"))
    # pmod(n, 1) is 0; a plain literal would be folded out of the join key
    rest = counts.filter((F.col("_n") > 1) & ~is_hot).select(
        *renamed("_r_"), F.col("_n").alias("_rest_n"), F.pmod("_n", F.lit(1)).alias("_r_salt")
    )
    marked = df.join(F.broadcast(hot), match("_h_"), "left").withColumn(
        "_salt",
        F.when(F.col("_hot_n").isNotNull(), F.spark_partition_id() + 1).otherwise(0).cast("long"),
    )
    joined = marked.join(rest, match("_r_") & (F.col("_salt") == F.col("_r_salt")), "left")
    n = F.coalesce("_hot_n", "_rest_n")
    return joined.filter(n > 1).select(*df.columns, n.alias(count_col))


def split_by_size(df: DataFrame, group: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups that a task can take whole, and the others, None if there are none.

    Rows are counted per hash slot of the group with partial sums: SLOTS numbers at most, whatever the groups are.
    """
    slot = F.pmod(F.xxhash64(*group), F.lit(SLOTS))
    counts = [tuple(r) for r in df.groupBy(slot.alias("_slot")).agg(F.count(F.lit(1))).collect()]
    most = max(GROUP_ROWS, 4 * sum(n for _, n in counts) // SLOTS)
    full = [s for s, n in counts if n > most]
    if not full:
        return df, None
    return df.filter(~slot.isin(full)), df.filter(slot.isin(full))


def _in_ranges(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """The rows cut into even ranges of (group, order), written with ``_bucket``.

    Range bounds come from sampling and would differ between two evaluations,
    so the cut is written down once.  Ties are cut by input position.
    """
    spark = df.sparkSession
    path = work_dir(spark, "ranges")
    by = [F.col(g) for g in group]
    (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*by, *order, F.col("_tie"))
        .withColumn("_bucket", F.spark_partition_id())
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def with_row_number(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    bucket: Column | None = None,
    out: str = "row_no",
) -> DataFrame:
    """``row_number()`` of every group in ``order``, computed bucket by bucket.

    ``bucket`` must not decrease along ``order``; give one where the order
    has a natural coarse form that keeps buckets small.  Without it the rows
    are first cut into even ranges, which costs one written table and holds
    for any distribution.
    """
    if bucket is None:
        rows, order = _in_ranges(df, group, order), [*order, F.col("_tie")]
    else:
        rows = df.withColumn("_bucket", bucket)
    rows = rows.withColumn("_group", _as_one([*group, "_bucket"]))
    sizes = rows.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(
        _as_one([*group, "_bucket"]).alias("_o_group"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy("_group").orderBy(*order)
    numbered = rows.join(offsets, F.col("_group") == F.col("_o_group")).withColumn(
        out, (F.row_number().over(inside) + F.col("_before")).cast("long")
    )
    return numbered.select(*_restored(df, group), out)


def with_previous(
    df: DataFrame,
    group: list[str],
    order: list[str],
    bucket: Column,
    value: Column,
    out: str,
) -> DataFrame:
    """``lag(value)`` of every group along ``order`` (ascending column names)."""
    rows = df.withColumn("_bucket", bucket).withColumn("_value", value)
    rows = rows.withColumn("_group", _as_one([*group, "_bucket"]))
    last = rows.groupBy(*group, "_bucket").agg(
        F.max_by(F.struct("_value"), F.struct(*order)).alias("_last")
    )
    by_bucket = Window.partitionBy(*group).orderBy("_bucket")
    carried = last.select(
        _as_one([*group, "_bucket"]).alias("_c_group"), F.lag("_last").over(by_bucket).alias("_carried")
    )
    inside = Window.partitionBy("_group").orderBy(*order)
    lagged = rows.join(carried, F.col("_group") == F.col("_c_group")).withColumn(
        "_prev", F.coalesce(F.lag(F.struct("_value")).over(inside), F.col("_carried"))
    )
    return lagged.select(*_restored(df, group), F.col("_prev._value").alias(out))
