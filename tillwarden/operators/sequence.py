"""Numbers that should be unique, complete and in order; history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwarden import reference as ref
from tillwarden.functions import keys as K
from tillwarden.operators import spread
from tillwarden.session import work_dir

# A transaction number is unique per register and business date: registers
# start again at 1 every day.
TRAN_NO_KEY = ["store", "register", "business_date", "tran_no"]
REGISTER_DAY = ["store", "register", "business_date"]

# Numbers are collected in ranges of this size, so that one collected set stays
# small however long a register's day is.
RANGE = 4096

# Long gaps are cut twice before they are written out: into spans, then into
# pieces that are spread over the tasks.  A span is a whole number of pieces.
SPAN, PIECE = 1 << 28, 1 << 16


def dup_tran_no(head: DataFrame, key_cols: list[str] | None = None) -> DataFrame:
    """All rows whose number occurs more than once."""
    return spread.with_repeated_key(head, key_cols or TRAN_NO_KEY)


def gap_intervals(
    df: DataFrame,
    keys: list[str] | None = None,
    number: str = "tran_no",
    first: int = 1,
    exclude_numbers: tuple[int, ...] = (ref.OPEN_TRAN_NO, ref.CLOSE_TRAN_NO),
    exclude_types: tuple[str, ...] = ("OPEN", "CLOSE"),
) -> DataFrame:
    """Gaps between ``first`` and the highest number per key, as ``gap_from`` and ``gap_to``.

    Numbers are collected per key and range of 4096, after map-side de-duplication, and give the gaps
    inside the range.  Only ends and inner gaps of the ranges that hold numbers meet per key, for the gaps between
    ranges; an empty stretch costs one row, however long it is.  A gap over the border of a range is one interval.
    """
    keys = keys or REGISTER_DAY
    n = F.col(number)
    rows = df.filter(n.isNotNull() & (n >= first))
    if exclude_numbers:
        rows = rows.filter(~n.isin(*exclude_numbers))
    if exclude_types and "tran_type" in df.columns:
        rows = rows.filter(~F.col("tran_type").isin(*exclude_types))
    slot = F.floor((n.cast("long") - first) / RANGE).cast("long")
    present = rows.groupBy(*keys, slot.alias("_slot")).agg(F.sort_array(F.collect_set(n.cast("long"))).alias("_have"))
    have = F.col("_have")

    def gap(low: Column, high: Column) -> Column:
        return F.struct((low + 1).alias("gap_from"), (high - 1).alias("gap_to"))

    def real(gaps: Column) -> Column:
        return F.filter(gaps, lambda g: g["gap_from"] <= g["gap_to"])

    steps = F.zip_with(F.slice(have, F.lit(1), F.size(have) - 1), F.slice(have, F.lit(2), F.size(have)), gap)
    ranges = present.select(
        *keys, "_slot", have[0].alias("_low"), F.element_at(have, -1).alias("_high"), real(steps).alias("_inner")
    )
    before = F.lag("_high", 1).over(Window.partitionBy(*keys).orderBy("_slot"))
    outer = F.array(gap(F.coalesce("_before", F.lit(first - 1).cast("long")), F.col("_low")))
    joined = ranges.withColumn("_before", before)
    return joined.select(*keys, F.inline(F.concat(real(outer), F.col("_inner"))))


def missing_numbers(
    df: DataFrame,
    keys: list[str] | None = None,
    number: str = "tran_no",
    first: int = 1,
    exclude_numbers: tuple[int, ...] = (ref.OPEN_TRAN_NO, ref.CLOSE_TRAN_NO),
    exclude_types: tuple[str, ...] = ("OPEN", "CLOSE"),
) -> DataFrame:
    """Numbers absent between ``first`` and the highest one per key: the rows of ``gap_intervals``.

    Long gaps are cut into pieces of 65,536 numbers that are shuffled, so that one register with a
    huge gap is written out by many tasks.
    """
    keys = keys or REGISTER_DAY
    gaps = gap_intervals(df, keys, number, first, exclude_numbers, exclude_types)
    span = F.explode(F.sequence("gap_from", "gap_to", F.lit(SPAN).cast("long"))).alias("_span")
    spans = gaps.select(*keys, "gap_to", span)
    upto = F.least(F.col("_span") + SPAN - 1, F.col("gap_to"))
    piece = F.explode(F.sequence("_span", upto, F.lit(PIECE).cast("long"))).alias("_piece")
    # a fixed number of partitions: adaptive execution would put these few small rows into one
    n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = spans.select(*keys, "gap_to", piece).repartition(n_parts, *keys, "_piece")
    last = F.least(F.col("_piece") + PIECE - 1, F.col("gap_to"))
    return pieces.select(*keys, F.explode(F.sequence("_piece", last)).alias(number))


def sa_missing_tran(head: DataFrame) -> DataFrame:
    """Gap table in canonical form (per register-day)."""
    from tillwarden.operators.conform import conform_types

    gaps = missing_numbers(head)
    out = gaps.withColumns(
        {
            "store_day_seq_no": K.surrogate("store", "business_date"),
            "miss_tran_seq_no": K.surrogate("store", "business_date", "register", "tran_no"),
            "status": F.lit("MISSING"),
            "rtlog_orig_sys": F.lit("POS"),
        }
    )
    return conform_types(out, "sa_missing_tran", ["store", "business_date"])


def check_item_sequence(items: DataFrame, keys: list[str], seq: str = "item_seq_no") -> DataFrame:
    """Transactions whose item numbers are not exactly 1..n.

    Counted per number first, so copies of one number collapse before the
    second, per-transaction aggregation.
    """
    per_number = items.groupBy(*keys, seq).agg(F.count(F.lit(1)).alias("_n"))
    per_tran = per_number.groupBy(*keys).agg(
        F.sum("_n").alias("n_items"),
        F.count(seq).alias("n_numbers"),
        F.min(seq).cast("long").alias("first_no"),
        F.max(seq).cast("long").alias("last_no"),
    )
    ok = (
        (F.col("first_no") == 1)
        & (F.col("last_no") == F.col("n_numbers"))
        & (F.col("n_items") == F.col("n_numbers"))
    )
    return per_tran.filter(~F.coalesce(ok, F.lit(False)))


def register_session_check(head: DataFrame) -> DataFrame:
    """Register-days without exactly one OPEN and one CLOSE.

    Sales after the closing record are normal and not reported.
    """
    g = head.groupBy(*REGISTER_DAY).agg(
        F.count_if(F.col("tran_type") == "OPEN").alias("n_open"),
        F.count_if(F.col("tran_type") == "CLOSE").alias("n_close"),
        F.count(F.lit(1)).alias("n_trans"),
    )
    return g.filter((F.col("n_open") != 1) | (F.col("n_close") != 1))


def assign_counters(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    bucket: Column | None = None,
    out: str = "tran_no",
) -> DataFrame:
    """Running numbers 1..n per group in a total order (see ``with_row_number``)."""
    return spread.with_row_number(df, group, order, bucket, out)


def surrogate_report(df: DataFrame, natural_key: list[str]) -> DataFrame:
    """Distinct natural keys against distinct surrogate keys."""
    keys = df.select(*natural_key).distinct().select(K.surrogate(*natural_key).alias("_id"))
    return keys.agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_distinct("_id").alias("n_ids")
    ).withColumn("n_collisions", F.col("n_keys") - F.col("n_ids"))


def real_changes(
    changes: DataFrame, key: list[str], order: list[str], bucket: Column, compare: list[str]
) -> DataFrame:
    """Versions that differ from the version before them in the compared columns."""
    state = F.to_json(F.struct(*compare), {"ignoreNullFields": "false"})
    stated = changes.withColumn("_state", state)
    lagged = spread.with_previous(stated, key, order, bucket, F.col("_state"), "_before")
    return lagged.filter(~F.col("_before").eqNullSafe(F.col("_state"))).drop("_state", "_before")


def head_revisions(
    changes: DataFrame, key: list[str], order: list[str], bucket: Column, compare: list[str]
) -> DataFrame:
    """History of a header: one row per real change, ``rev_no`` counting from 0.

    ``changes`` holds every version delivered, ``order`` is a total order per
    key (update time first), ``bucket`` a coarse form of it.

    Versions of a key that a task can take are shuffled once, and compared and numbered there.  Those of
    longer histories are written down and go bucket by bucket.
    """
    few, many = spread.split_by_size(changes, key)
    revs = _short_histories(few, key, order, compare)
    if many is None:
        return revs
    path = work_dir(changes.sparkSession, "long-histories")
    many.write.parquet(path)
    real = real_changes(changes.sparkSession.read.schema(many.schema).parquet(path), key, order, bucket, compare)
    numbered = spread.with_row_number(real, key, [F.col(c) for c in order], bucket, "_version")
    return revs.unionByName(numbered.withColumn("rev_no", F.col("_version") - 1).drop("_version"))


def _short_histories(changes: DataFrame, key: list[str], order: list[str], compare: list[str]) -> DataFrame:
    """``head_revisions`` in one window; states are put together after the shuffle."""

    def state(names: list[str]) -> Column:
        return F.to_json(F.struct(*[F.col(n).alias(c) for n, c in zip(names, compare)]), {"ignoreNullFields": "false"})

    history = Window.partitionBy(*key).orderBy(*order)
    before = {f"_before_{i}": F.lag(c).over(history) for i, c in enumerate(compare)}
    lagged = changes.withColumns({"_place": F.row_number().over(history), **before})
    real = lagged.filter((F.col("_place") == 1) | (state(list(before)) != state(compare)))
    return real.drop("_place", *before).withColumn("rev_no", F.row_number().over(history).cast("long") - 1)


def sa_tran_head_rev(versions: DataFrame, compare: list[str]) -> DataFrame:
    """Revision table in canonical form, from versions of conformed headers.

    ``versions`` has the canonical header columns and ``record_key``.
    """
    from tillwarden.operators.conform import conform_types

    revs = head_revisions(
        versions.drop("rev_no").withColumn("record_key", K.packed("record_key")),
        ["record_key"],
        ["update_datetime"],
        F.date_trunc("day", "update_datetime"),
        compare,
    ).withColumn("record_key", K.unpacked("record_key"))
    return conform_types(revs, "sa_tran_head_rev", ["record_key"])


def as_of_revision(
    revisions: DataFrame, key: list[str], at: Column, order: list[str], updated: str = "update_datetime"
) -> DataFrame:
    """State of every header at a point in time: the last revision up to then.

    The latest row is picked by an aggregation that combines on the map side.
    """
    others = [c for c in revisions.columns if c not in key]
    past = revisions.filter(F.col(updated) <= at)
    best = past.groupBy(*key).agg(
        F.max_by(F.struct(*others), F.struct(*order)).alias("_row")
    )
    return best.select(*key, "_row.*")
