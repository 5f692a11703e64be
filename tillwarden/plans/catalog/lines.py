"""Keys, money, taxes, flags and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwarden.functions import calendar as C, checks, keys as K, money as M, rawjson
from tillwarden.operators import conform, joins, rules, tax, totals
from tillwarden.plans import tables as T
from tillwarden.plans.catalog import query
from tillwarden import reference as ref
from tillwarden.schemas import table_columns
from tillwarden.sources import rtlog as R


@query(
    "partition_key",
    ["ev_head"],
    "SELECT tran_seq_no, store, business_date AS date, strftime(ts, '%H') AS hour FROM ev_head",
)
def partition_key(spark, sf):
    return R.with_partition_key(T.till_log(spark, sf)).select(
        "tran_head.tran_seq_no", "store", "date", "hour"
    )


@query(
    "tran_seq_no",
    ["o_head"],
    """SELECT tran_no, 'STR' || lpad(CAST(store AS VARCHAR), 3, '0') || '-' || register || '-' ||
         CAST(business_date AS VARCHAR) || '-' ||
         CASE WHEN tran_no >= 1000000 THEN CAST(tran_no AS VARCHAR) ELSE lpad(CAST(tran_no AS VARCHAR), 6, '0') END AS tran_seq_no
       FROM o_head""",
)
def tran_seq_no(spark, sf):
    return T.order_head(spark, sf).select(
        "tran_no",
        K.build_tran_seq_no("store", "register", "business_date", "tran_no").alias("tran_seq_no"),
    )


@query(
    "tran_seq_parse",
    ["ev_head"],
    """SELECT tran_seq_no, store, register, business_date,
         CASE WHEN event_type = 'click' THEN event_id ELSE n END AS number,
         CASE WHEN event_type = 'click' AND event_id <> n THEN 'N' ELSE 'Y' END AS consistent,
         regexp_replace(tran_seq_no, '-[^-]*$', '') || '-000007' AS renumbered
       FROM ev_head""",
)
def tran_seq_parse(spark, sf):
    heads = T.till_log(spark, sf).select("tran_head.*")
    parts = K.parse_tran_seq_no("tran_seq_no")
    return heads.select(
        "tran_seq_no",
        parts["store"].alias("store"),
        parts["register"].alias("register"),
        parts["business_date"].alias("business_date"),
        parts["tran_no"].alias("number"),
        F.when(rules.seq_format_bad(), "N").otherwise("Y").alias("consistent"),
        K.replace_seq_number("tran_seq_no", F.lit(7)).alias("renumbered"),
    )


@query(
    "round4",
    ["o_item"],
    """SELECT tran_no, item_seq_no,
         CAST(qty * unit_retail * CAST(0.0337 AS DECIMAL(4,4)) AS DECIMAL(20,4)) AS rounded FROM o_item""",
)
def round4(spark, sf):
    return T.order_item(spark, sf).select(
        "tran_no",
        "item_seq_no",
        M.round4(F.expr("qty * unit_retail * cast(0.0337 as decimal(4,4))")).alias("rounded"),
    )


@query(
    "line_amount",
    ["o_item"],
    "SELECT tran_no, item_seq_no, CAST(qty * unit_retail AS DECIMAL(20,4)) AS line_amt FROM o_item",
)
def line_amount(spark, sf):
    return T.order_item(spark, sf).select(
        "tran_no", "item_seq_no", M.round4(M.line_amount()).alias("line_amt")
    )


@query(
    "disc_amount",
    ["o_disc"],
    "SELECT tran_no, item_seq_no, CAST(qty * unit_discount_amt AS DECIMAL(20,4)) AS disc_amt FROM o_disc",
)
def disc_amount(spark, sf):
    return T.order_disc(spark, sf).select(
        "tran_no", "item_seq_no", M.round4(M.disc_amount()).alias("disc_amt")
    )


@query(
    "tran_value",
    ["o_item", "o_disc"],
    """SELECT tran_no, CAST(greatest(CAST(sum(a) AS DECIMAL(20,4)) - CAST(sum(d) AS DECIMAL(20,4)), 0) AS DECIMAL(20,4)) AS tran_value
       FROM (SELECT tran_no, qty * unit_retail AS a, 0 AS d FROM o_item
             UNION ALL SELECT tran_no, 0, qty * unit_discount_amt FROM o_disc) GROUP BY tran_no""",
)
def tran_value(spark, sf):
    return totals.tran_values(T.order_item(spark, sf), T.order_disc(spark, sf), T.ORDER_KEYS)


@query(
    "tran_value_nested",
    ["ev_facts"],
    """SELECT tran_seq_no, value,
         CAST(greatest(line_total - disc_total, 0) AS DECIMAL(20,4)) AS recomputed FROM ev_facts""",
)
def tran_value_nested(spark, sf):
    f = rules.nested_facts(T.till_log(spark, sf))
    return f.select("tran_seq_no", "value", M.net_value("line_total", "disc_total").alias("recomputed"))


@query(
    "igtax_lines",
    ["o_igtax"],
    "SELECT tran_no, item_seq_no, igtax_seq_no, tax_authority, total_igtax_amt FROM o_igtax",
)
def igtax_lines(spark, sf):
    return tax.igtax_lines(T.order_item(spark, sf), T.ORDER_KEYS).select(
        "tran_no", "item_seq_no", "igtax_seq_no", "tax_authority", "total_igtax_amt"
    )


@query(
    "additive_tax",
    ["o_item"],
    """SELECT tran_no, 'GSTTOT' AS tax_code,
         row_number() OVER (PARTITION BY tran_no ORDER BY item_seq_no, unit_retail, qty) AS tax_seq_no,
         CAST(qty * CAST(0.18 AS DECIMAL(4,4)) * unit_retail AS DECIMAL(20,4)) AS tax_amt FROM o_item""",
)
def additive_tax(spark, sf):
    return tax.additive_tax_lines(T.order_item(spark, sf), T.ORDER_KEYS).drop("error_ind")


@query(
    "item_igtax_total",
    ["o_igtax"],
    """SELECT tran_no, item_seq_no, nullif(CAST(sum(total_igtax_amt) AS DECIMAL(20,4)), 0) AS total_igtax_amt
       FROM o_igtax GROUP BY tran_no, item_seq_no""",
)
def item_igtax_total(spark, sf):
    lines = tax.igtax_lines(T.order_item(spark, sf), T.ORDER_KEYS)
    return tax.item_igtax_total(lines, T.ORDER_KEYS)


@query(
    "tax_mode",
    ["o_item", "o_igtax"],
    """SELECT m.mode, m.flag AS vat_incl,
         CAST(CASE WHEN mode <> 'IGTAX' THEN (SELECT count(*) FROM o_item) ELSE 0 END AS BIGINT) AS n_tax,
         CAST(CASE WHEN mode <> 'TAX' THEN (SELECT count(*) FROM o_igtax) ELSE 0 END AS BIGINT) AS n_igtax,
         CAST(CASE WHEN mode <> 'TAX' THEN (SELECT sum(total_igtax_amt) FROM o_igtax) ELSE 0 END AS DECIMAL(38,4)) AS igtax_amt
       FROM (VALUES ('IGTAX', 'Y'), ('TAX', 'N'), ('BOTH', 'Y')) m(mode, flag)""",
)
def tax_mode(spark, sf):
    out = None
    for mode in tax.TAX_MODES:
        items, add, inc = tax.apply_tax_mode(T.order_item(spark, sf), T.ORDER_KEYS, mode)
        kinds = [items.select(F.col("unit_retail_vat_incl").alias("f"), F.lit(0).alias("t"), F.lit(0).alias("g"), M.money(0).alias("a"))]
        if add is not None:
            kinds.append(add.select(F.lit(None).cast("string").alias("f"), F.lit(1).alias("t"), F.lit(0).alias("g"), M.money(0).alias("a")))
        if inc is not None:
            kinds.append(inc.select(F.lit(None).cast("string").alias("f"), F.lit(0).alias("t"), F.lit(1).alias("g"), F.col("total_igtax_amt").alias("a")))
        rows = kinds[0]
        for k in kinds[1:]:
            rows = rows.unionByName(k)
        one = rows.agg(
            F.max("f").alias("vat_incl"),
            F.sum("t").alias("n_tax"),
            F.sum("g").alias("n_igtax"),
            F.sum("a").cast("decimal(38,4)").alias("igtax_amt"),
        ).withColumn("mode", F.lit(mode))
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "promo_discount",
    ["o_head", "o_disc", "o_item", "promos"],
    """SELECT d.tran_no, d.item_seq_no, d.promotion, CAST(i.l_extendedprice_m * p.disc_pct AS DECIMAL(20,4)) AS unit_discount_amt
       FROM (SELECT l_orderkey AS tran_no, CAST(l_linenumber AS BIGINT) AS item_seq_no, 500001 + l_suppkey % 5 AS promotion,
               CAST(l_extendedprice AS DECIMAL(20,4)) AS l_extendedprice_m FROM lineitem WHERE l_discount > 0) i
       JOIN o_head h ON i.tran_no = h.tran_no AND h.tran_type = 'SALE'
       JOIN promos p ON p.promo_id = i.promotion
       CROSS JOIN LATERAL (SELECT i.tran_no, i.item_seq_no, i.promotion) d""",
)
def promo_discount(spark, sf):
    lines = T.table(spark, sf, "lineitem").filter("l_discount > 0").selectExpr(
        "l_orderkey as tran_no", "cast(l_linenumber as bigint) as item_seq_no",
        "500001 + l_suppkey % 5 as promotion", "cast(l_extendedprice as decimal(20,4)) as unit_retail",
    )
    typed = lines.join(T.order_head(spark, sf).select("tran_no", "tran_type"), "tran_no")
    return tax.promo_discounts(typed, ref.promotions(spark)).select(
        "tran_no", "item_seq_no", "promotion", "unit_discount_amt"
    )


@query(
    "normalise_lines",
    ["o_head", "o_item"],
    """SELECT tran_no, item_seq_no,
         CAST(CASE WHEN tran_type = 'RETURN' THEN -abs(qty) ELSE qty END AS DECIMAL(12,4)) AS qty,
         CASE WHEN tran_type = 'RETURN' THEN 'CUST' ELSE return_reason_code END AS return_reason_code,
         CASE WHEN tran_type = 'PVOID' THEN 'VOIDED' ELSE 'ACTIVE' END AS item_status
       FROM o_item JOIN o_head USING (tran_no)""",
)
def normalise_lines(spark, sf):
    typed = T.order_item(spark, sf).join(
        T.order_head(spark, sf).select("tran_no", "tran_type"), "tran_no"
    )
    return conform.normalise_lines(typed).select(
        "tran_no", "item_seq_no", "qty", "return_reason_code", "item_status"
    )


@query(
    "mask_pan",
    ["o_tender"],
    "SELECT tran_no, tender_seq_no, '************' || right(cc_no, 4) AS cc_no FROM o_tender",
)
def mask_pan(spark, sf):
    return T.order_tender(spark, sf).select(
        "tran_no", "tender_seq_no", checks.mask_pan("cc_no").alias("cc_no")
    )


@query(
    "calendar_features",
    ["o_head"],
    """SELECT DISTINCT business_date,
         CAST((CASE isodow(business_date) WHEN 5 THEN 1.2 WHEN 6 THEN 1.8 WHEN 7 THEN 1.6 ELSE 1.0 END)
           * (CASE WHEN month(business_date) = 11 AND isodow(business_date) = 5 AND day(business_date) > 23 THEN 4.0 ELSE 1.0 END)
           AS DECIMAL(6,2)) AS day_factor,
         CASE WHEN month(business_date) = 11 AND isodow(business_date) = 5 AND day(business_date) > 23 THEN 'Y' ELSE 'N' END AS black_friday
       FROM o_head""",
)
def calendar_features(spark, sf):
    return T.order_head(spark, sf).select("business_date").distinct().select(
        "business_date",
        C.day_factor("business_date").alias("day_factor"),
        F.when(C.is_black_friday("business_date"), "Y").otherwise("N").alias("black_friday"),
    )


@query(
    "tran_instant",
    ["ev_head"],
    """SELECT tran_seq_no, tran_datetime, CAST(hour(ts) AS INTEGER) AS till_hour,
         CAST(epoch(date_trunc('second', ts)) AS BIGINT) - 19800 AS epoch_seconds FROM ev_head""",
)
def tran_instant(spark, sf):
    return T.till_log(spark, sf).select("tran_head.*").select(
        "tran_seq_no",
        "tran_datetime",
        K.wall_hour("tran_datetime").alias("till_hour"),
        F.unix_seconds(K.tran_instant("tran_datetime")).alias("epoch_seconds"),
    )


@query(
    "conform_head",
    ["ev_head"],
    """SELECT store, CAST(dayofyear(business_date) AS BIGINT) AS day, CAST(0 AS BIGINT) AS rev_no,
         to_timestamp(epoch(date_trunc('second', ts)) - 19800)::TIMESTAMP AS tran_datetime, register, tran_no,
         tran_type, CAST(NULL AS VARCHAR) AS ref_no3, CAST(NULL AS BIGINT) AS credit_promotion_id, status, value,
         orig_tran_no, vendor_no, ref_no1, rtlog_orig_sys
       FROM ev_head""",
)
def conform_head(spark, sf):
    head = conform.fan_out(T.till_log(spark, sf))["sa_tran_head"]
    return head.select(
        "store", "day", "rev_no", F.col("tran_datetime").cast("timestamp_ntz").alias("tran_datetime"),
        "register", "tran_no", "tran_type", "ref_no3", "credit_promotion_id", "status", "value",
        "orig_tran_no", "vendor_no", "ref_no1", "rtlog_orig_sys",
    )


@query(
    "missing_vs_absent",
    ["ev_head"],
    """SELECT tran_seq_no,
         'sub_tran_type,reason_code'
           || CASE WHEN tran_type = 'PVOID' THEN '' ELSE ',orig_tran_no,orig_tran_type,orig_reg_no' END
           || CASE WHEN vendor_no IS NULL THEN ',vendor_no' ELSE '' END
           || ',vendor_invc_no,rounded_amt,rounded_off_amt'
           || CASE WHEN ref_no1 IS NULL THEN ',ref_no1' ELSE '' END || ',ref_no2' AS absent,
         CASE WHEN tran_type = 'PVOID' THEN 0 ELSE 3 END + CASE WHEN vendor_no IS NULL THEN 1 ELSE 0 END
           + CASE WHEN ref_no1 IS NULL THEN 1 ELSE 0 END + 6 AS n_null
       FROM ev_head""",
)
def missing_vs_absent(spark, sf):
    record = F.struct("rtlog_orig_sys", "tran_head", "tran_item")
    lines = T.till_log(spark, sf).select(
        "tran_head.tran_seq_no",
        F.to_json(record).alias("without_nulls"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("with_nulls"),
    )
    return lines.select(
        "tran_seq_no",
        F.array_join(rawjson.absent_keys("without_nulls", "tran_head"), ",").alias("absent"),
        F.size(rawjson.null_keys("with_nulls", "tran_head")).alias("n_null"),
    )


@query(
    "predicate_report",
    ["ev_head", "ev_tender"],
    """SELECT rtlog_orig_sys, count(*) FILTER (WHERE error_ind IN ('Y', 'N')) AS n_yn,
         count(*) FILTER (WHERE status <> 'REVIEW') AS n_status,
         count(*) FILTER (WHERE record_channel <> 'WEB') AS n_channel,
         (SELECT count(*) FROM ev_tender t WHERE t.rtlog_orig_sys = h.rtlog_orig_sys AND (cc_no IS NULL OR cc_no LIKE '*%')) AS n_masked,
         count(*) AS n_4dp
       FROM ev_head h GROUP BY rtlog_orig_sys""",
)
def predicate_report(spark, sf):
    f = T.till_log(spark, sf).select(
        "tran_head.*", F.col("rtlog_orig_sys").alias("record_channel"), "tran_tender"
    )
    masked = F.size(F.filter("tran_tender", lambda t: checks.is_masked(t["cc_no"])))
    return f.groupBy("rtlog_orig_sys").agg(
        F.count_if(checks.is_yn("error_ind")).alias("n_yn"),
        F.count_if(F.col("status").isin(ref.HEAD_STATUSES)).alias("n_status"),
        F.count_if(checks.in_channels("record_channel")).alias("n_channel"),
        F.sum(masked).alias("n_masked"),
        F.count_if(checks.has_4dp(F.col("value").cast("string"))).alias("n_4dp"),
    )


@query(
    "filter_by_type",
    ["o_head"],
    "SELECT tran_no, store, tran_type, value FROM o_head WHERE tran_type IN ('SALE', 'RETURN')",
)
def filter_by_type(spark, sf):
    return conform.filter_by_type(T.order_head(spark, sf), "SALE", "RETURN").select(
        "tran_no", "store", "tran_type", "value"
    )


_ITEM_GIVEN = {"item_seq_no", "item", "qty", "unit_retail", "return_reason_code"}


def _mandatory_sql() -> str:
    rows = []
    for c in table_columns("sa_tran_item"):
        if c.mandatory:
            n = f"count(*) FILTER (WHERE {c.name} IS NULL)" if c.name in _ITEM_GIVEN else "count(*)"
            rows.append(f"SELECT '{c.name}' AS column_name, {n} AS n_null FROM o_item")
    return "\nUNION ALL ".join(rows)


@query("mandatory_report", ["o_item"], _mandatory_sql())
def mandatory_report(spark, sf):
    items = conform.conform_types(T.order_item(spark, sf), "sa_tran_item")
    return conform.mandatory_report(items, "sa_tran_item")


_TENDER_TEXT = {"tender_type_group", "cc_no", "orig_currency"}


def _width_sql() -> str:
    rows = []
    for c in table_columns("sa_tran_tender"):
        if c.width:
            text = c.name if c.name in _TENDER_TEXT else "CAST(NULL AS VARCHAR)"
            rows.append(
                f"SELECT '{c.name}' AS column_name, CAST({c.width} AS BIGINT) AS declared_width, "
                f"CAST(max(length({text})) AS BIGINT) AS longest, count(*) FILTER (WHERE length({text}) > {c.width}) AS n_over FROM o_tender"
            )
    return "\nUNION ALL ".join(rows)


@query("width_report", ["o_tender"], _width_sql())
def width_report(spark, sf):
    return conform.width_report(
        conform.conform_types(T.order_tender(spark, sf), "sa_tran_tender"), "sa_tran_tender"
    )


@query(
    "quarantine",
    ["ev_head"],
    """SELECT tran_seq_no, 'BAD_ERROR_IND' AS rejection_reason FROM ev_head WHERE error_ind NOT IN ('Y', 'N')""",
)
def quarantine(spark, sf):
    _, bad = conform.quarantine(T.till_log(spark, sf))
    return bad.select("tran_head.tran_seq_no", "rejection_reason")


@query(
    "quarantine_good",
    ["ev_head"],
    "SELECT rtlog_orig_sys, count(*) AS n, sum(value)::DECIMAL(38,4) AS value FROM ev_head WHERE error_ind IN ('Y', 'N') GROUP BY 1",
)
def quarantine_good(spark, sf):
    good, _ = conform.quarantine(T.till_log(spark, sf))
    return good.select("tran_head.*").groupBy("rtlog_orig_sys").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(38,4)").alias("value")
    )


@query(
    "fan_out_items",
    ["ev_item"],
    """SELECT store, CAST(dayofyear(business_date) AS BIGINT) AS day, item_seq_no, item_status, item, qty, unit_retail,
         tax_ind, drop_ship_ind, total_igtax_amt, return_reason_code FROM ev_item""",
)
def fan_out_items(spark, sf):
    return conform.fan_out(T.till_log(spark, sf))["sa_tran_item"].select(
        "store", "day", "item_seq_no", "item_status", "item", "qty", "unit_retail", "tax_ind",
        "drop_ship_ind", "total_igtax_amt", "return_reason_code",
    )


@query(
    "fan_out_counts",
    ["ev_head", "ev_item", "ev_disc", "ev_tender", "ev_tax", "ev_igtax"],
    """SELECT 'sa_tran_head' AS table_name, count(*) AS n_rows FROM ev_head
       UNION ALL SELECT 'sa_tran_item', count(*) FROM ev_item UNION ALL SELECT 'sa_tran_disc', count(*) FROM ev_disc
       UNION ALL SELECT 'sa_tran_tender', count(*) FROM ev_tender UNION ALL SELECT 'sa_tran_tax', count(*) FROM ev_tax
       UNION ALL SELECT 'sa_tran_igtax', count(*) FROM ev_igtax""",
)
def fan_out_counts(spark, sf):
    out = None
    for name, df in conform.fan_out(T.till_log(spark, sf)).items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "fan_out_tenders",
    ["ev_tender"],
    """SELECT store, CAST(dayofyear(business_date) AS BIGINT) AS day, tender_seq_no, tender_type_group,
         tender_type_id, tender_amt, cc_no, orig_curr_amt FROM ev_tender""",
)
def fan_out_tenders(spark, sf):
    return conform.fan_out(T.till_log(spark, sf))["sa_tran_tender"].select(
        "store", "day", "tender_seq_no", "tender_type_group", "tender_type_id", "tender_amt",
        "cc_no", "orig_curr_amt",
    )


@query(
    "fan_out_igtax",
    ["ev_igtax"],
    """SELECT store, CAST(dayofyear(business_date) AS BIGINT) AS day, item_seq_no, igtax_seq_no,
         tax_authority, total_igtax_amt FROM ev_igtax""",
)
def fan_out_igtax(spark, sf):
    return conform.fan_out(T.till_log(spark, sf))["sa_tran_igtax"].select(
        "store", "day", "item_seq_no", "igtax_seq_no", "tax_authority", "total_igtax_amt"
    )


@query(
    "nested_predicates",
    ["ev_head", "ev_item"],
    """SELECT h.tran_seq_no, CASE WHEN coalesce(a, 0) > 0 THEN 'Y' ELSE 'N' END AS any_negative,
         CASE WHEN coalesce(b, 0) = coalesce(c, 0) THEN 'Y' ELSE 'N' END AS all_active,
         CAST(coalesce(q, 0) AS DECIMAL(20,4)) AS units
       FROM ev_head h LEFT JOIN (SELECT event_id, count(*) FILTER (WHERE qty < 0) a,
         count(*) FILTER (WHERE item_status = 'ACTIVE') b, count(*) c, sum(qty) q FROM ev_item GROUP BY 1) i USING (event_id)""",
)
def nested_predicates(spark, sf):
    return T.till_log(spark, sf).select(
        "tran_head.tran_seq_no",
        F.when(rules.nested_any("tran_item", lambda x: x["qty"] < 0), "Y").otherwise("N").alias("any_negative"),
        F.when(rules.nested_all("tran_item", lambda x: x["item_status"] == "ACTIVE"), "Y").otherwise("N").alias("all_active"),
        M.round4(M.array_total("tran_item", lambda x: x["qty"])).alias("units"),
    )


@query(
    "items_by_authority",
    ["o_item"],
    """SELECT tax_authority, count(*) AS n_rows, count(DISTINCT tran_no) AS n_trans, CAST(sum(qty) AS DECIMAL(38,4)) AS units
       FROM o_item, (VALUES ('CGST'), ('SGST')) a(tax_authority) GROUP BY tax_authority""",
)
def items_by_authority(spark, sf):
    return joins.items_by_authority(T.order_item(spark, sf)).groupBy("tax_authority").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("tran_no").alias("n_trans"),
        F.sum("qty").cast("decimal(38,4)").alias("units"),
    )
