"""Joins: enrichment, look-ups, referential checks, currency."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwarden import reference as ref
from tillwarden.functions import money as M
from tillwarden.operators import audit, joins, rules, tax, totals
from tillwarden.plans import tables as T
from tillwarden.plans.catalog import query


@query(
    "enrich_store",
    ["o_head", "stores"],
    """SELECT tran_no, store, coalesce(tills, 4) AS tills, coalesce(local_currency, 'INR') AS local_currency,
         CASE WHEN store_no IS NULL THEN 'Y' ELSE 'N' END AS inv_store_ind
       FROM o_head LEFT JOIN stores ON store = store_no""",
)
def enrich_store(spark, sf):
    return joins.enrich_store(T.order_head(spark, sf), T.registry(spark, sf)).select(
        "tran_no", "store", "tills", "local_currency", "inv_store_ind"
    )


@query(
    "unknown_store",
    ["o_head", "stores"],
    "SELECT tran_no, store FROM o_head WHERE store NOT IN (SELECT store_no FROM stores)",
)
def unknown_store(spark, sf):
    return joins.unknown_store(T.order_head(spark, sf), T.registry(spark, sf)).select("tran_no", "store")


@query(
    "orphan_children",
    ["o_head", "o_item", "o_disc", "o_tender", "o_tax", "o_igtax"],
    "SELECT * FROM (WITH gone AS (SELECT tran_no FROM o_head WHERE tran_type = 'PVOID') "
    + " UNION ALL ".join(
        f"SELECT tran_no, '{section}' AS section, {key_1} AS key_value_1, CAST({key_2} AS BIGINT) AS key_value_2 FROM {view} SEMI JOIN gone USING (tran_no)"
        for section, view, key_1, key_2 in (
            ("tran_item", "o_item", "item_seq_no", "NULL"),
            ("tran_disc", "o_disc", "item_seq_no", "item_seq_no"),
            ("tran_tender", "o_tender", "tender_seq_no", "NULL"),
            ("tran_tax", "o_tax", "tax_seq_no", "NULL"),
            ("tran_igtax", "o_igtax", "item_seq_no", "igtax_seq_no"),
        )
    )
    + ")",
)
def orphan_children(spark, sf):
    """Rows of all five children whose order is not among the headers: those of post-voids were taken away."""
    heads = T.order_head(spark, sf).filter("tran_type <> 'PVOID'")
    items = T.order_item(spark, sf)
    children = {
        "tran_item": items,
        "tran_disc": T.order_disc(spark, sf).withColumn("discount_seq_no", F.col("item_seq_no")),
        "tran_tender": T.order_tender(spark, sf),
        "tran_tax": T.order_tax(spark, sf),
        "tran_igtax": tax.igtax_lines(items, T.ORDER_KEYS),
    }
    keyed = {c: df.withColumn("record_key", F.col("tran_no").cast("string")) for c, df in children.items()}
    hits = audit.orphan_hits(heads, keyed, key="tran_no")
    return hits.select(
        F.col("record_key").cast("long").alias("tran_no"), "section", "key_value_1", "key_value_2"
    )


@query(
    "head_without_tender",
    ["o_head", "o_tender"],
    """SELECT tran_no, store, value FROM o_head
       WHERE value > 0 AND tran_no NOT IN (SELECT tran_no FROM o_tender)""",
)
def head_without_tender(spark, sf):
    return joins.head_without_tender(
        T.order_head(spark, sf), T.order_tender(spark, sf), T.ORDER_KEYS
    ).select("tran_no", "store", "value")


@query(
    "lookup_product",
    ["o_item", "products"],
    """SELECT tran_no, item_seq_no, item, dept AS product_dept, class AS product_class, base_price
       FROM o_item LEFT JOIN products ON item = sku""",
)
def lookup_product(spark, sf):
    return joins.lookup_product(T.order_item(spark, sf), T.part_products(spark, sf)).select(
        "tran_no", "item_seq_no", "item", "product_dept", "product_class", "base_price"
    )


@query(
    "lookup_promo",
    ["o_disc", "promos"],
    """SELECT promotion, disc_pct, count(*) AS n_rows, CAST(sum(unit_discount_amt) AS DECIMAL(38,4)) AS amount
       FROM o_disc LEFT JOIN promos ON promotion = promo_id GROUP BY promotion, disc_pct""",
)
def lookup_promo(spark, sf):
    d = joins.lookup_promo(T.order_disc(spark, sf), ref.promotions(spark))
    return d.groupBy("promotion", "disc_pct").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("unit_discount_amt").cast("decimal(38,4)").alias("amount"),
    )


@query(
    "lookup_tender_type",
    ["o_tender"],
    """SELECT tran_no, tender_seq_no, tender_type_id,
         CASE tender_type_id WHEN 1 THEN 'CASH' WHEN 3 THEN 'VOUCHER' ELSE 'CARD' END AS expected_group FROM o_tender""",
)
def lookup_tender_type(spark, sf):
    return joins.lookup_tender_type(T.order_tender(spark, sf), ref.tender_types(spark)).select(
        "tran_no", "tender_seq_no", "tender_type_id", "expected_group"
    )


@query(
    "price_band",
    ["o_item", "products"],
    """SELECT tran_no, item_seq_no, item, unit_retail, base_price FROM o_item JOIN products ON item = sku
       WHERE abs(unit_retail - base_price) > 50""",
)
def price_band(spark, sf):
    return joins.price_band_check(T.order_item(spark, sf), T.part_products(spark, sf)).select(
        "tran_no", "item_seq_no", "item", "unit_retail", "base_price"
    )


@query(
    "lookup_error_codes",
    ["ev_row_hits"],
    """SELECT error_code, CASE WHEN error_code IN ('VOID_OOH', 'ITEM_SEQ_GAP', 'TAX_MODE_MIX', 'PAIDIO_SHAPE', 'SEQ_FORMAT',
           'BANNER_INVALID', 'CURR_AMT_MISMATCH') THEN 'N' WHEN error_code = 'POS_DROP_SHIP' THEN 'N' ELSE 'Y' END AS required_ind,
         CASE WHEN error_code IN ('NEG_QTY_NO_REF', 'SALE_NO_ITEM', 'RETAIL_NOT_POSITIVE', 'POS_DROP_SHIP') THEN 'Y' ELSE 'N' END AS store_may_override,
         count(*) AS n_errors
       FROM ev_row_hits GROUP BY 1, 2, 3""",
)
def lookup_error_codes(spark, sf):
    hits = rules.run_rules(rules.nested_facts(T.till_log(spark, sf)))
    looked = joins.lookup_error_codes(hits, ref.error_codes(spark))
    return looked.groupBy("error_code", "required_ind", "store_may_override").agg(
        F.count(F.lit(1)).alias("n_errors")
    )


@query(
    "attach_store_day",
    ["o_head"],
    """SELECT store, count(*) AS n_trans, count(*) AS n_attached, count(DISTINCT business_date) AS n_store_days
       FROM o_head GROUP BY store""",
)
def attach_store_day(spark, sf):
    """Every header gets the number of its store-day."""
    head = T.order_head(spark, sf)
    store_day = totals.build_store_day(head.withColumn("tran_datetime", F.lit(None).cast("string")), T.registry(spark, sf))
    return joins.attach_store_day(head, store_day).groupBy("store").agg(
        F.count(F.lit(1)).alias("n_trans"),
        F.count("store_day_seq_no").alias("n_attached"),
        F.count_distinct("store_day_seq_no").alias("n_store_days"),
    )


@query(
    "link_post_void",
    ["ev_head"],
    """SELECT v.store, v.business_date, v.register, v.tran_no, v.tran_seq_no, coalesce(o.n, 0) AS n_originals,
         o.id AS original_id, o.business_date AS original_date
       FROM (SELECT * FROM ev_head WHERE tran_type = 'PVOID') v ASOF LEFT JOIN
         (SELECT store, register, tran_no, tran_type, business_date, count(*) AS n, min(tran_seq_no) AS id FROM ev_head GROUP BY 1, 2, 3, 4, 5) o
         ON o.store = v.store AND o.register = v.orig_reg_no AND o.tran_no = v.orig_tran_no
         AND o.tran_type = v.orig_tran_type AND v.business_date >= o.business_date""",
)
def link_post_void(spark, sf):
    return joins.link_post_void(T.till_log(spark, sf).select("tran_head.*")).select(
        "store", "business_date", "register", "tran_no", "tran_seq_no", "n_originals", "original_id", "original_date"
    )


@query(
    "to_usd",
    ["o_head", "stores"],
    """SELECT tran_no, CAST(round(value / exchange_rate_to_usd, 4) AS DECIMAL(20,4)) AS usd
       FROM o_head LEFT JOIN stores ON store = store_no""",
)
def to_usd(spark, sf):
    s = T.registry(spark, sf).select("store_no", "exchange_rate_to_usd")
    head = T.order_head(spark, sf)
    return head.join(s, head.store == s.store_no, "left").select(
        "tran_no", M.to_usd("value", "exchange_rate_to_usd").alias("usd")
    )


@query(
    "fx_by_day",
    ["o_tender", "rates"],
    """SELECT t.tran_no, t.tender_seq_no, t.orig_currency, t.business_date, r.rate,
         CAST(t.orig_curr_amt * r.rate AS DECIMAL(20,4)) AS converted_amt
       FROM o_tender t ASOF LEFT JOIN rates r ON t.orig_currency = r.currency AND t.business_date >= r.rate_date""",
)
def fx_by_day(spark, sf):
    return joins.fx_by_day(T.order_tender(spark, sf), T.fx_rates(spark, sf)).select(
        "tran_no", "tender_seq_no", "orig_currency", "business_date", "rate", "converted_amt"
    )


@query(
    "error_ind",
    ["ev_head", "ev_all_hits"],
    """SELECT tran_seq_no, tran_type, CASE WHEN event_id IN (SELECT event_id FROM ev_all_hits) THEN 'Y' ELSE 'N' END AS error_ind
       FROM ev_head""",
)
def error_ind(spark, sf):
    facts = rules.nested_facts(T.till_log(spark, sf))
    return joins.error_back_propagation(facts, T.audited(spark, sf)).select("tran_seq_no", "tran_type", "error_ind")
