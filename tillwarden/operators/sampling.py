"""First n rows, exact reproducible samples, even assignment of labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwarden.operators import spread

# Hash values are handled by their top 16 bits: 65,536 slots at most, whatever
# the number of rows.
SLOT_BITS = 16


def first_n(df: DataFrame, order: list[Column], n: int = 1000) -> DataFrame:
    """The first n rows of a total order."""
    return df.orderBy(*order).limit(n)


def _slot(h: Column) -> Column:
    # arithmetic shift keeps the order of the signed hash
    return F.shiftright(h, 64 - SLOT_BITS)


def sample_exact(df: DataFrame, key: list[str], rate: float, seed: int = 0) -> DataFrame:
    """Exactly ``round(n * rate)`` rows (half to even), without replacement.

    Rows are taken in the order of the MD5 of seed and unique key.  Counts
    per hash slot tell which slots are taken whole and which single slot is
    taken in part; only that slot is sorted.  Nothing passes the driver.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    hashed = df.withColumn("_hash", F.md5(text.cast("binary"))).withColumn(
        "_slot", F.conv(F.substring("_hash", 1, SLOT_BITS // 4), 16, 10).cast("long")
    )
    sizes = hashed.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"))
    total = F.coalesce(sizes.agg(F.sum("_n")).scalar(), F.lit(0))
    wanted = F.bround(total * F.lit(rate).cast("decimal(18,9)"), 0).cast("long")
    # one row per slot, at most 65,536 of them
    running = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    cut = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(running), F.lit(0))).withColumn(
        "_take", F.least(F.col("_n"), F.greatest(wanted - F.col("_before"), F.lit(0)))
    )
    whole = cut.filter((F.col("_take") == F.col("_n")) & (F.col("_n") > 0)).select("_slot")
    part = cut.filter((F.col("_take") > 0) & (F.col("_take") < F.col("_n"))).select("_slot", "_take")
    taken = hashed.join(F.broadcast(whole), "_slot", "left_semi")
    in_slot = Window.partitionBy("_slot").orderBy("_hash", *key)
    cut_rows = (
        hashed.join(F.broadcast(part), "_slot")
        .withColumn("_r", F.row_number().over(in_slot))
        .filter(F.col("_r") <= F.col("_take"))
    )
    return taken.select(*df.columns).unionByName(cut_rows.select(*df.columns))


def assign_round_robin(
    df: DataFrame, key: list[str], labels: list[str], seed: int = 0, out: str = "label"
) -> DataFrame:
    """Spread labels evenly: their counts differ by one at most.

    Rows are numbered in the order of a seeded hash, slot by slot.
    """
    hashed = df.withColumn("_hash", F.xxhash64(F.lit(seed), *key))
    numbered = spread.with_row_number(
        hashed, [], [F.col("_hash"), *[F.col(k) for k in key]], _slot(F.col("_hash")), "_no"
    )
    names = F.array(*[F.lit(x) for x in labels])
    pick = F.element_at(names, (F.pmod(F.col("_no") - 1, F.lit(len(labels))) + 1).cast("int"))
    return numbered.withColumn(out, pick).drop("_hash", "_no")
