"""Totals, mixes, profiles and store-day roll-ups.

Sums combine on the map side; children are aggregated before they are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwarden import reference as ref
from tillwarden.functions import calendar as C, keys as K, money as M
from tillwarden.operators import sequence, spread

SUM = "decimal(38,4)"


def tender_total(tender: DataFrame, keys: list[str]) -> DataFrame:
    return tender.groupBy(*keys).agg(
        M.round4(F.sum("tender_amt")).alias("tender_total"), F.count(F.lit(1)).alias("n_tenders")
    )


def item_disc_tax_totals(
    items: DataFrame, disc: DataFrame, tax: DataFrame, igtax: DataFrame, keys: list[str]
) -> DataFrame:
    """Line, discount, tax and contained-tax totals per transaction.

    The four child tables are brought to one shape and summed by a single
    aggregation, so there is one shuffle and no fan-out.
    """
    names = ["line_amt", "disc_amt", "tax_amt", "igtax_amt"]

    def shaped(df: DataFrame, **amounts: Column) -> DataFrame:
        nothing = F.lit(None)
        return df.select(*keys, *[amounts.get(n, nothing).cast("decimal(38,8)").alias(n) for n in names])

    rows = (
        shaped(items, line_amt=M.line_amount())
        .unionByName(shaped(disc, disc_amt=M.disc_amount()))
        .unionByName(shaped(tax, tax_amt=F.col("tax_amt")))
        .unionByName(shaped(igtax, igtax_amt=F.col("total_igtax_amt")))
    )
    zero = M.money(0)
    return rows.groupBy(*keys).agg(
        F.coalesce(M.round4(F.sum("line_amt")), zero).alias("line_total"),
        F.coalesce(M.round4(F.sum("disc_amt")), zero).alias("disc_total"),
        F.coalesce(M.round4(F.sum("tax_amt")), zero).alias("tax_total"),
        F.coalesce(M.round4(F.sum("igtax_amt")), zero).alias("igtax_total"),
    )


def tran_values(items: DataFrame, disc: DataFrame, keys: list[str]) -> DataFrame:
    """Header value recomputed from flat items and discounts."""
    shaped = (
        items.select(*keys, M.line_amount().cast("decimal(38,8)").alias("line_amt"),
                     F.lit(None).cast("decimal(38,8)").alias("disc_amt"))
        .unionByName(
            disc.select(*keys, F.lit(None).cast("decimal(38,8)").alias("line_amt"),
                        M.disc_amount().cast("decimal(38,8)").alias("disc_amt"))
        )
    )
    return shaped.groupBy(*keys).agg(
        M.net_value(F.sum("line_amt"), F.sum("disc_amt")).alias("tran_value")
    )




def type_mix(head: DataFrame) -> DataFrame:
    """Count per type with the overall count and the expected share."""
    spark = head.sparkSession
    counts = head.groupBy("tran_type").agg(F.count(F.lit(1)).alias("n_trans"))
    return (
        counts.withColumn("n_all", counts.agg(F.sum("n_trans")).scalar())
        .join(ref.type_mix(spark), "tran_type", "left")
        .withColumn("share_bp", F.expr("n_trans * 10000 div n_all"))
    )


def tender_mix(tender: DataFrame) -> DataFrame:
    """Count and amount per tender type, with shares in basis points."""
    spark = tender.sparkSession
    g = tender.groupBy("tender_type_group", "tender_type_id").agg(
        F.count(F.lit(1)).alias("n_tenders"),
        F.sum("tender_amt").cast("decimal(38,4)").alias("amount"),
    )
    expected = ref.tender_types(spark).select("tender_type_id", "expected_pct")
    return (
        g.withColumn("n_all", g.agg(F.sum("n_tenders")).scalar())
        .join(expected, "tender_type_id", "left")
        .withColumn("share_bp", F.expr("n_tenders * 10000 div n_all"))
    )


def hourly_profile(head: DataFrame) -> DataFrame:
    """Transactions per hour of the till clock against the expected weight; all 24 hours."""
    spark = head.sparkSession
    counts = head.groupBy(K.wall_hour("tran_datetime").alias("hour")).agg(
        F.count(F.lit(1)).alias("n_trans")
    )
    weights = ref.hour_weights(spark)
    return weights.join(counts, "hour", "left").select(
        "hour", "weight", F.coalesce("n_trans", F.lit(0)).alias("n_trans")
    )


def daily_volume_index(head: DataFrame) -> DataFrame:
    """Transactions per store-day, the day's factor, and volume per factor unit."""
    daily = head.groupBy("store", "business_date").agg(F.count(F.lit(1)).alias("n_trans"))
    factor = C.day_factor("business_date")
    return daily.withColumns(
        {
            "day_factor": factor,
            "volume_index": (F.col("n_trans") / factor.cast("double")).cast("double"),
        }
    )


def distinct_check(df: DataFrame, column: str = "tran_seq_no", exact: bool = True) -> DataFrame:
    """Rows against distinct ids; ``exact=False`` uses a sketch."""
    distinct = F.count_distinct(column) if exact else F.approx_count_distinct(column)
    return df.agg(F.count(column).alias("n_rows"), distinct.alias("n_distinct")).withColumn(
        "n_repeated", F.col("n_rows") - F.col("n_distinct")
    )


def seen_tran_nos(head: DataFrame) -> DataFrame:
    """Numbers used per store and register, one per row (a set would be unbounded)."""
    return head.select("store", "register", "tran_no").distinct()


def build_store_day(head: DataFrame, stores: DataFrame) -> DataFrame:
    """One row per store and business date, in canonical form.

    ``head`` may carry ``source_file`` (for the file counts).  A day is full
    and its store closed once every register that opened has closed.
    """
    from tillwarden.operators.conform import conform_types
    from tillwarden.operators.joins import enrich_store

    files = F.col("source_file") if "source_file" in head.columns else F.lit(None).cast("string")
    is_oms = F.col("rtlog_orig_sys") == "OMS"
    closing = F.when(F.col("tran_type") == "CLOSE", K.tran_instant("tran_datetime"))
    # distinct (store, day, file, channel) first: count_distinct then stays small
    per_file = head.groupBy("store", "business_date", files.alias("_file"), is_oms.alias("_oms")).agg(
        F.count_if(F.col("tran_type") == "OPEN").alias("_open"),
        F.count_if(F.col("tran_type") == "CLOSE").alias("_close"),
        F.max(closing).alias("_closed_at"),
    )
    days = per_file.groupBy("store", "business_date").agg(
        F.sum("_open").alias("_open"),
        F.sum("_close").alias("_close"),
        F.max("_closed_at").alias("store_closed_datetime"),
        F.count_distinct(F.when(~F.col("_oms"), F.col("_file"))).alias("files_loaded"),
        F.count_distinct(F.when(F.col("_oms"), F.col("_file"))).alias("oms_files_loaded"),
    )
    closed = (F.col("_close") > 0) & (F.col("_close") >= F.col("_open"))
    out = enrich_store(days, stores).withColumns(
        {
            "store_day_seq_no": K.surrogate("store", "business_date"),
            "day": K.day_number("business_date"),
            "inv_bus_date_ind": F.when(F.col("business_date").isNull(), "Y").otherwise("N"),
            "store_status": F.when(closed, "CLOSED").otherwise("OPEN"),
            "data_status": F.when(closed, "F").otherwise("P"),
            "audit_status": F.lit("UNAUDITED"),
        }
    )
    return conform_types(out, "sa_store_day")


def calc_totals(
    head: DataFrame, tender: DataFrame, tax: DataFrame, igtax: DataFrame, disc: DataFrame
) -> DataFrame:
    """Named totals per store and date as (store, business_date, day, total_id, total_value).

    Every source is summed per store-day by one aggregation over a union; the
    few totals of a store-day are then unpivoted.
    """
    names = ["TNDCASH", "TNDCARD", "TAXTOTAL", "DISCTOTAL", "TRANCOUNT"]

    def shaped(df: DataFrame, **amounts: Column) -> DataFrame:
        return df.select(
            "store", "business_date",
            *[amounts.get(n, F.lit(None)).cast("decimal(38,8)").alias(n) for n in names],
        )

    group = F.col("tender_type_group")
    rows = (
        shaped(
            tender,
            TNDCASH=F.when(group == "CASH", F.col("tender_amt")),
            TNDCARD=F.when(group == "CARD", F.col("tender_amt")),
        )
        .unionByName(shaped(tax, TAXTOTAL=F.col("tax_amt")))
        .unionByName(shaped(igtax, TAXTOTAL=F.col("total_igtax_amt")))
        .unionByName(shaped(disc, DISCTOTAL=M.disc_amount()))
        .unionByName(shaped(head, TRANCOUNT=F.lit(1)))
    )
    summed = rows.groupBy("store", "business_date").agg(
        *[F.coalesce(M.round4(F.sum(n)), M.money(0)).alias(n) for n in names]
    )
    dated = summed.withColumn("day", K.day_number("business_date"))
    return dated.unpivot(["store", "business_date", "day"], names, "total_id", "total_value")


def errors_by_code(errors: DataFrame, *by: str) -> DataFrame:
    return errors.groupBy(*by, "error_code").agg(F.count(F.lit(1)).alias("n_errors"))


def errors_rollup(errors: DataFrame) -> DataFrame:
    """Errors per channel and store with sub-totals."""
    return errors.rollup("rtlog_orig_sys", "store").agg(F.count(F.lit(1)).alias("n_errors"))


def fault_rate(facts: DataFrame, is_bad: Column) -> DataFrame:
    """Share of records that are bad or repeat a number, and whether it is within 0..10 per cent."""
    marked = facts.withColumn("_bad", is_bad)
    alone = marked.agg(F.count(F.lit(1)).alias("n_all"), F.count_if("_bad").alias("n_bad"))
    repeated = spread.with_repeated_key(marked.select("_bad", *sequence.TRAN_NO_KEY), sequence.TRAN_NO_KEY)
    more = repeated.agg(F.lit(0).cast("long").alias("n_all"), F.count_if(~F.col("_bad")).alias("n_bad"))
    return alone.unionByName(more).agg(F.sum("n_all").alias("n_all"), F.sum("n_bad").alias("n_bad")).withColumns(
        {
            "rate_bp": F.expr("n_bad * 10000 div n_all"),
            "in_range": F.when(F.col("n_bad") * 10 <= F.col("n_all"), "Y").otherwise("N"),
        }
    )


def channel_variance(head: DataFrame, tender: DataFrame, keys: list[str]) -> DataFrame:
    """Header value against tenders per channel."""
    t = tender_total(tender, keys)
    joined = head.join(t, keys, "left").withColumn(
        "_diff", F.coalesce("tender_total", M.money(0)) - F.col("value")
    )
    return joined.groupBy("rtlog_orig_sys").agg(
        F.count(F.lit(1)).alias("n_trans"),
        F.sum("value").cast(SUM).alias("value_total"),
        F.sum(F.coalesce("tender_total", M.money(0))).cast(SUM).alias("tender_total"),
        F.sum("_diff").cast(SUM).alias("variance"),
        F.count_if(F.abs("_diff") > M.money(ref.TENDER_TOLERANCE)).alias("n_out_of_balance"),
    )


def weekly_summary(head: DataFrame, errors: DataFrame) -> DataFrame:
    """Net sales, transactions and errors per week, store and channel.

    ``errors`` carries business_date, store and rtlog_orig_sys.
    """
    sign = F.when(F.col("tran_type") == "RETURN", F.lit(-1)).when(
        F.col("tran_type") == "SALE", F.lit(1)
    ).otherwise(F.lit(0))
    week = F.date_trunc("week", F.col("business_date")).cast("date").alias("week")
    by = [week, F.col("store"), F.col("rtlog_orig_sys")]
    sales = head.select(
        *by, (F.col("value") * sign).cast(SUM).alias("_net"), F.lit(1).alias("_t"), F.lit(0).alias("_e")
    )
    errs = errors.select(*by, F.lit(0).cast(SUM).alias("_net"), F.lit(0).alias("_t"), F.lit(1).alias("_e"))
    return sales.unionByName(errs).groupBy("week", "store", "rtlog_orig_sys").agg(
        F.sum("_net").cast(SUM).alias("net_sales"),
        F.sum("_t").alias("n_trans"),
        F.sum("_e").alias("n_errors"),
    )
