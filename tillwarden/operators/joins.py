"""Look-ups, referential checks and enrichment.

No side is forced to broadcast here.  Catalyst broadcasts a side whose known
size is under ``spark.sql.autoBroadcastJoinThreshold`` (the seed tables are
local relations of a few rows) and uses a shuffled join beyond, in which
adaptive execution splits skewed keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillwarden import reference as ref
from tillwarden.functions.money import MONEY, money, round4
from tillwarden.operators.spread import same


def enrich_store(
    df: DataFrame,
    stores: DataFrame,
    default_tills: int = ref.DEFAULT_TILLS,
    default_currency: str = ref.DEFAULT_CURRENCY,
) -> DataFrame:
    """Tills and currency of the store; defaults when the registry lacks it."""
    s = stores.select(
        F.col("store_no").alias("_store"), "tills", "local_currency", F.lit("N").alias("_known")
    )
    return (
        df.join(s, F.col("store") == F.col("_store"), "left")
        .withColumn("tills", F.coalesce("tills", F.lit(default_tills)))
        .withColumn("local_currency", F.coalesce("local_currency", F.lit(default_currency)))
        .withColumn("inv_store_ind", F.coalesce("_known", F.lit("Y")))
        .drop("_store", "_known")
    )


def unknown_store(df: DataFrame, stores: DataFrame) -> DataFrame:
    """Rows whose store is not in the registry."""
    return df.join(
        stores.select(F.col("store_no").alias("_s")), F.col("store") == F.col("_s"), "left_anti"
    )


def orphan_children(child: DataFrame, head: DataFrame, keys: list[str]) -> DataFrame:
    """Child rows without a header."""
    h = head.select(*keys)
    return child.join(h, same(child, h, keys), "left_anti")


def head_without_tender(
    head: DataFrame, tender: DataFrame, keys: list[str], strict: bool = False
) -> DataFrame:
    """Headers without a tender row.

    Only those with a value count, since openings, no-sales and returns have
    no tender by design; ``strict`` lists all.
    """
    wanted = head if strict else head.filter(F.col("value") > 0)
    t = tender.select(*keys)
    return wanted.join(t, same(wanted, t, keys), "left_anti")


def items_by_authority(items: DataFrame, authorities: list[tuple] | None = None) -> DataFrame:
    """Every item once per tax authority.

    The authorities are a short fixed list, so they are an array literal that
    is exploded in place: no join and no shuffle.
    """
    rows = authorities if authorities is not None else ref.IGTAX_AUTHORITIES
    lit = F.array(
        *[
            F.struct(
                F.lit(n).alias("authority_no"),
                F.lit(name).alias("tax_authority"),
                F.lit(code).alias("igtax_code"),
                F.lit(rate).cast("decimal(4,4)").alias("igtax_rate"),
            )
            for n, (name, code, rate) in enumerate(rows, start=1)
        ]
    )
    return items.select("*", F.inline(lit))


def lookup_product(items: DataFrame, products: DataFrame) -> DataFrame:
    """Hierarchy and base price of the SKU; NULL for unknown SKUs."""
    p = products.select(
        F.col("sku").alias("_sku"),
        F.col("dept").alias("product_dept"),
        F.col("class").alias("product_class"),
        F.col("subclass").alias("product_subclass"),
        "base_price",
    )
    return items.join(p, F.col("item") == F.col("_sku"), "left").withColumn(
        "known_product", F.col("_sku").isNotNull()
    ).drop("_sku")


def lookup_promo(disc: DataFrame, promotions: DataFrame) -> DataFrame:
    p = promotions.select(F.col("promotion").alias("_promo"), "disc_pct")
    return disc.join(p, F.col("promotion") == F.col("_promo"), "left").drop("_promo")


def lookup_tender_type(tender: DataFrame, tender_types: DataFrame) -> DataFrame:
    t = tender_types.select(
        F.col("tender_type_id").alias("_tt"),
        F.col("tender_type_group").alias("expected_group"),
    )
    return tender.join(t, F.col("tender_type_id") == F.col("_tt"), "left").drop("_tt")


def price_band_check(
    items: DataFrame, products: DataFrame, band: int = ref.PRICE_BAND
) -> DataFrame:
    """Items of known SKUs priced further than ``band`` from the base price."""
    joined = lookup_product(items, products)
    return joined.filter(F.abs(F.col("unit_retail") - F.col("base_price")) > band)


def lookup_error_codes(errors: DataFrame, error_codes: DataFrame) -> DataFrame:
    e = error_codes.select(
        F.col("error_code").alias("_ec"), "error_desc", "required_ind",
        F.col("store_override_ind").alias("store_may_override"),
        F.col("hq_override_ind").alias("hq_may_override"),
    )
    return errors.join(e, F.col("error_code") == F.col("_ec"), "left").drop("_ec")


def attach_store_day(head: DataFrame, store_day: DataFrame) -> DataFrame:
    """STORE_DAY_SEQ_NO of the header's store and business date."""
    sd = store_day.select(
        F.col("store").alias("_s"), F.col("business_date").alias("_d"), "store_day_seq_no"
    )
    base = head.drop("store_day_seq_no")
    return base.join(
        sd, (F.col("store") == F.col("_s")) & (F.col("business_date") == F.col("_d")), "left"
    ).drop("_s", "_d")


def link_post_void(head: DataFrame) -> DataFrame:
    """Post-voids with the transaction they cancel: the latest of its number up to the void's business date.

    Registers start their numbers again every day, so a number is a different transaction each day.
    ``original_date`` is the day of the match, ``n_originals`` how many transactions have that number there (0: there is
    none at all; more than 1: the number was used again by mistake, and the lowest id is shown).

    Originals are counted per number and day with partial sums, and voids ask once per number and day, so the
    window over a number has two rows a day at most, however often a number was used.  The join back to the
    voids is on an equal key, which adaptive execution splits where it is skewed.
    """
    key = ["_s", "_r", "_n", "_t"]
    voids = head.filter(F.col("tran_type") == "PVOID")
    own = {"store": "_s", "register": "_r", "tran_no": "_n", "tran_type": "_t", "business_date": "_d"}
    originals = head.groupBy(*[F.col(c).alias(a) for c, a in own.items()]).agg(
        F.count(F.lit(1)).alias("n_originals"), F.min("tran_seq_no").alias("original_id")
    )
    named = {"store": "_s", "orig_reg_no": "_r", "orig_tran_no": "_n", "orig_tran_type": "_t", "business_date": "_d"}
    asked = voids.select(*[F.col(c).alias(a) for c, a in named.items()]).dropna().distinct()
    found = F.struct(F.col("_d").alias("original_date"), "n_originals", "original_id").alias("_o")
    rows = originals.select(*key, "_d", F.lit(0).alias("_asks"), found).unionByName(
        asked.select(*key, "_d", F.lit(1).alias("_asks")), allowMissingColumns=True
    )
    up_to_here = Window.partitionBy(*key).orderBy("_d", "_asks").rowsBetween(Window.unboundedPreceding, 0)
    linked = rows.withColumn("_o", F.last("_o", ignorenulls=True).over(up_to_here)).filter("_asks = 1").drop("_asks")
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(a) for c, a in named.items()])
    return (
        voids.join(linked, on, "left")
        .withColumns(
            {
                "original_date": F.col("_o.original_date"),
                "n_originals": F.coalesce("_o.n_originals", F.lit(0)),
                "original_id": F.col("_o.original_id"),
            }
        )
        .drop(*named.values(), "_o")
    )


def filled_rates(rates: DataFrame, until: DataFrame) -> DataFrame:
    """Daily rates with gaps filled from the last known day.

    ``rates``: currency, rate_date, rate.  ``until``: one row with ``last_date``.
    The result has one row per currency and calendar day, so it grows with the
    calendar and not with the transactions.
    """
    w = Window.partitionBy("currency").orderBy("rate_date")
    nxt = F.lead("rate_date").over(w)
    spans = rates.withColumn("_next", nxt)
    last = F.date_add(F.greatest(F.col("rate_date"), until.select("last_date").scalar()), 1)
    return spans.select(
        "currency",
        F.explode(
            F.sequence("rate_date", F.date_sub(F.coalesce("_next", last), 1))
        ).alias("rate_date"),
        "rate",
    )


def fx_by_day(tender: DataFrame, rates: DataFrame, date_col: str = "business_date") -> DataFrame:
    """Convert ``orig_curr_amt`` with the rate of the day, or the last one before it."""
    until = tender.agg(F.max(date_col).alias("last_date"))
    r = filled_rates(rates, until).select(
        F.col("currency").alias("_c"), F.col("rate_date").alias("_d"), "rate"
    )
    joined = tender.join(
        r, (F.col("orig_currency") == F.col("_c")) & (F.col(date_col) == F.col("_d")), "left"
    )
    return joined.withColumn(
        "converted_amt", round4(F.col("orig_curr_amt").cast(MONEY) * F.col("rate"))
    ).drop("_c", "_d")


def error_back_propagation(head: DataFrame, errors: DataFrame, key: str = "record_key") -> DataFrame:
    """ERROR_IND = Y exactly for headers with an error row."""
    e = errors.select(F.col(key).alias("_ek")).distinct()
    return (
        head.drop("error_ind")
        .join(e, F.col(key) == F.col("_ek"), "left")
        .withColumn("error_ind", F.when(F.col("_ek").isNotNull(), F.lit("Y")).otherwise(F.lit("N")))
        .drop("_ek")
    )
