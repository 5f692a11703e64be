"""From nested records to canonical tables, and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwarden import reference as ref
from tillwarden.functions import checks, keys as K
from tillwarden.operators import spread
from tillwarden.schemas import (
    CHILD_TABLES,
    CHILDREN,
    HEAD_DDL,
    mandatory_columns,
    struct_of,
    table_columns,
)
from tillwarden.session import work_dir

# Technical columns carried next to the canonical ones.  Joins use the record
# key: a re-used transaction number makes the canonical key ambiguous.
KEYS = ["record_key", "store", "day", "tran_seq_no"]

# Lines of one kind that a nested record holds; a record is one row, so it must
# have a bound.  Further lines are rows of ``nest_overflow``.
LINES_PER_RECORD = 100_000


def conform_types(df: DataFrame, table: str, extra: list[str] | None = None) -> DataFrame:
    """Canonical columns in canonical order, cast; missing ones as typed NULL."""
    have = set(df.columns)
    cols = [
        (F.col(f"`{c.name}`") if c.name in have else F.lit(None)).cast(c.spark_type).alias(c.name)
        for c in table_columns(table)
    ]
    return df.select(*cols, *[F.col(c) for c in extra or []])


def with_keys(rtlog: DataFrame) -> DataFrame:
    """Add record key, day number and surrogate keys to nested records.

    Landed records carry their key already; it is computed only where missing.
    """
    head = F.col("tran_head")
    if "record_key" not in rtlog.columns:
        rtlog = rtlog.withColumn("record_key", K.record_key())
    return (
        rtlog.withColumn("day", K.day_number(head["business_date"]))
        .withColumn("store_day_seq_no", K.surrogate(head["store"], head["business_date"]))
        .withColumn("tran_seq_id", K.surrogate("record_key"))
    )


def heads(rtlog: DataFrame) -> DataFrame:
    """Flat headers in source names, with the keys in front."""
    return with_keys(rtlog).select(
        "record_key", "day", "store_day_seq_no", "tran_seq_id", "tran_head.*"
    )


def children(rtlog: DataFrame, child: str) -> DataFrame:
    """Rows of one child array with the transaction keys; empty arrays give none."""
    keyed = with_keys(rtlog)
    return keyed.select(
        "record_key",
        F.col("tran_head.store").alias("store"),
        "day",
        F.col("tran_head.business_date").alias("business_date"),
        F.col("tran_seq_id").alias("tran_seq_no"),
        F.inline(child),
    )


def fan_out(rtlog: DataFrame) -> dict[str, DataFrame]:
    """The six canonical transaction tables of nested records.

    One array is exploded per table, never two together.
    """
    h = heads(rtlog)
    head = h.select(
        *[c for c in h.columns if c not in ("tran_seq_no", "tran_seq_id", "tran_datetime", "update_datetime")],
        F.col("tran_seq_id").alias("tran_seq_no"),
        F.col("tran_seq_no").alias("tran_seq_text"),
        K.tran_instant("tran_datetime").alias("tran_datetime"),
        F.col("tran_datetime").alias("tran_datetime_text"),
        K.tran_instant("update_datetime").alias("update_datetime"),
    )
    tables = {
        "sa_tran_head": conform_types(
            head,
            "sa_tran_head",
            ["record_key", "business_date", "tran_seq_text", "tran_datetime_text"],
        )
    }
    for child, table in CHILD_TABLES.items():
        tables[table] = conform_types(children(rtlog, child), table, ["record_key", "business_date"])
    return tables


def _long_children(child_rows: dict[str, DataFrame], key: str, most: int) -> DataFrame:
    """Transactions with more than ``most`` lines of a child: _child, _long_key, _n; written once."""
    keys = [
        rows.filter(F.col(key).isNotNull()).select(F.lit(child).alias("_child"), F.col(key).alias("_long_key"))
        for child, rows in child_rows.items()
    ]
    counted = reduce(DataFrame.unionByName, keys).groupBy("_child", "_long_key").agg(F.count(F.lit(1)).alias("_n"))
    spark = counted.sparkSession
    path = work_dir(spark, "long-transactions")
    counted.filter(F.col("_n") > most).write.parquet(path)
    return spark.read.schema(counted.schema).parquet(path)


def _placed(rows: DataFrame, child: str, key: str, long: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Child rows of transactions that are not long, and those of long ones with their ``place`` from 1 on.

    Places follow the line numbers (null first), then all columns, so equal rows only are interchangeable.
    """
    mine = long.filter(F.col("_child") == child).select("_long_key")
    hit = F.col(key) == F.col("_long_key")
    order = [F.col(n) for n in CHILDREN[child][1]] + [F.to_json(F.struct(*rows.columns))]
    placed = spread.with_row_number(rows.join(mine, hit, "left_semi"), [key], order, None, "place")
    return rows.join(mine, hit, "left_anti"), placed


def nest_rtlog(
    head: DataFrame, child_rows: dict[str, DataFrame], key: str = "record_key", most: int = LINES_PER_RECORD
) -> DataFrame:
    """Flat headers and child rows back to nested records, one per transaction.

    Lines stand in the order of their numbers, null first.  ``n_aside`` counts the lines beyond the
    first ``most`` of a child: they are not in the record but in ``nest_overflow``.  Transactions are counted
    first, so no longer list is ever collected, whatever the numbers are.  Child rows without a key
    or a header belong to no record.
    """
    names = list(CHILDREN)
    given = [c for c in names if c in child_rows]
    out = head.withColumn("n_aside", F.lit(0).cast("long"))
    if given:
        nested = {c: child_rows[c].filter(F.col(key).isNotNull()) for c in given}
        long = _long_children(nested, key, most)
        if not long.isEmpty():
            for child in given:
                rest, placed = _placed(nested[child], child, key, long)
                nested[child] = rest.unionByName(placed.filter(F.col("place") <= most).drop("place"))
            aside = long.groupBy(F.col("_long_key").alias(key)).agg(F.sum(F.col("_n") - most).alias("_aside"))
            out = head.join(aside, key, "left").withColumn("n_aside", F.coalesce("_aside", F.lit(0)).cast("long"))
        stacked = None
        for child, rows in nested.items():
            ddl, numbering = CHILDREN[child]
            line = F.struct(F.struct(*[F.col(n) for n in numbering]).alias("_o"), _typed(rows, ddl).alias("_e"))
            one = rows.select(F.col(key), line.alias(child))
            stacked = one if stacked is None else stacked.unionByName(one, allowMissingColumns=True)
        # all children of a transaction meet in one aggregation
        grouped = stacked.groupBy(key).agg(*[F.sort_array(F.collect_list(c)).alias(c) for c in given])
        out = out.join(grouped, key, "left")
    arrays = []
    for child in names:
        empty = F.array().cast(f"array<{struct_of(CHILDREN[child][0]).simpleString()}>")
        if child in given:
            empty = F.coalesce(F.transform(child, lambda x: x["_e"]), empty)
        arrays.append(empty.alias(child))
    return out.select(key, "n_aside", "rtlog_orig_sys", _typed(head, HEAD_DDL).alias("tran_head"), *arrays)


def nest_overflow(
    child_rows: dict[str, DataFrame], key: str = "record_key", most: int = LINES_PER_RECORD
) -> dict[str, DataFrame]:
    """Child rows that ``nest_rtlog`` sets aside, with their ``place`` (above ``most``) in the transaction."""
    long = _long_children(child_rows, key, most)
    return {
        child: _placed(rows, child, key, long)[1].filter(F.col("place") > most) for child, rows in child_rows.items()
    }


def _typed(df: DataFrame, ddl: str) -> Column:
    """A struct of the DDL's fields; fields the frame lacks are typed NULLs."""
    have = set(df.columns)
    return F.struct(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in struct_of(ddl)
        ]
    )


# --------------------------------------------------------------------------
# gates
# --------------------------------------------------------------------------
def mandatory_report(df: DataFrame, table: str) -> DataFrame:
    """Rows of NULLs per mandatory column, in one pass over the table."""
    cols = mandatory_columns(table)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in cols])
    return counted.select(F.inline(pairs))


def width_report(df: DataFrame, table: str) -> DataFrame:
    """Values longer than the declared column width (a warning, not a gate)."""
    specs = [c for c in table_columns(table) if c.width]
    counted = df.agg(
        *[F.count_if(F.length(c.name) > c.width).alias(c.name) for c in specs],
        *[F.max(F.length(c.name)).alias(f"max_{c.name}") for c in specs],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("column_name"),
                F.lit(c.width).cast("long").alias("declared_width"),
                F.col(f"max_{c.name}").cast("long").alias("longest"),
                F.col(c.name).alias("n_over"),
            )
            for c in specs
        ]
    )
    return counted.select(F.inline(rows))


def rejection_reasons(rtlog: DataFrame) -> Column:
    """Reasons that keep a nested record out of the canonical tables."""
    h = F.col("tran_head")
    required = [
        "store", "business_date", "tran_seq_no", "tran_datetime", "tran_type",
        "status", "pos_tran_ind", "update_datetime", "update_id", "error_ind",
        "rtlog_orig_sys", "rev_no",
    ]
    tests = []
    if "_corrupt" in rtlog.columns:
        tests.append((F.col("_corrupt").isNotNull(), "MALFORMED_RECORD"))
    tests += [(h[c].isNull(), f"MISSING_{c.upper()}") for c in required]
    tests += [
        (
            h["tran_datetime"].isNotNull() & K.tran_instant(h["tran_datetime"]).isNull(),
            "BAD_TRAN_DATETIME",
        ),
        (h["tran_type"].isNotNull() & ~checks.in_code_list(h["tran_type"], "TRAT"), "BAD_TRAN_TYPE"),
        (
            h["rtlog_orig_sys"].isNotNull() & ~checks.in_channels(h["rtlog_orig_sys"]),
            "BAD_CHANNEL",
        ),
        (h["pos_tran_ind"].isNotNull() & ~checks.is_yn(h["pos_tran_ind"]), "BAD_POS_TRAN_IND"),
        (h["error_ind"].isNotNull() & ~checks.is_yn(h["error_ind"]), "BAD_ERROR_IND"),
    ]
    return F.array_compact(F.array(*[F.when(bad, F.lit(reason)) for bad, reason in tests]))


def tag_rejections(rtlog: DataFrame) -> DataFrame:
    """Add ``rejection_reason``: NULL for good records, else reasons joined by commas."""
    reasons = rejection_reasons(rtlog)
    return rtlog.withColumn(
        "rejection_reason", F.when(F.size(reasons) > 0, F.array_join(reasons, ","))
    )


def quarantine(rtlog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records, and rejected ones with their reasons."""
    tagged = tag_rejections(rtlog)
    good = tagged.filter("rejection_reason is null").drop("rejection_reason", "_corrupt")
    return good, tagged.filter("rejection_reason is not null")


def normalise_lines(items: DataFrame, tran_type: str = "tran_type") -> DataFrame:
    """Sign, reason and status an item must have given its transaction type."""
    t = F.col(tran_type)
    qty = F.when(t == "RETURN", -F.abs("qty")).otherwise(F.col("qty")).cast("decimal(12,4)")
    return items.withColumns(
        {
            "qty": qty,
            "uom_quantity": qty,
            "return_reason_code": F.when(t == "RETURN", F.lit("CUST")).otherwise(
                F.col("return_reason_code")
            ),
            "item_status": F.when(t == "PVOID", F.lit("VOIDED")).otherwise(F.lit("ACTIVE")),
        }
    )


def filter_by_type(df: DataFrame, *types: str) -> DataFrame:
    unknown = set(types) - set(ref.CODE_LISTS["TRAT"])
    if unknown:
        raise ValueError(f"unknown transaction types: {sorted(unknown)}")
    return df.filter(F.col("tran_type").isin(*types))


def union_channels(*frames: DataFrame) -> DataFrame:
    """Headers of several channels in one table; unknown channels are rejected on read."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_days(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
