"""Totals, mixes, profiles, store-days and the nested form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwarden.operators import conform, rules, tax, totals
from tillwarden.plans import tables as T
from tillwarden.plans.catalog import query


@query(
    "tender_total",
    ["o_tender"],
    "SELECT tran_no, CAST(sum(tender_amt) AS DECIMAL(20,4)) AS tender_total, count(*) AS n_tenders FROM o_tender GROUP BY tran_no",
)
def tender_total(spark, sf):
    return totals.tender_total(T.order_tender(spark, sf), T.ORDER_KEYS)


@query(
    "item_disc_tax_totals",
    ["o_item", "o_disc", "o_tax", "o_igtax"],
    """SELECT i.tran_no, line_total, coalesce(disc_total, 0) AS disc_total, coalesce(tax_total, 0) AS tax_total, igtax_total
       FROM (SELECT tran_no, CAST(sum(qty * unit_retail) AS DECIMAL(20,4)) AS line_total FROM o_item GROUP BY 1) i
       LEFT JOIN (SELECT tran_no, CAST(sum(qty * unit_discount_amt) AS DECIMAL(20,4)) AS disc_total FROM o_disc GROUP BY 1) d USING (tran_no)
       LEFT JOIN (SELECT tran_no, CAST(sum(tax_amt) AS DECIMAL(20,4)) AS tax_total FROM o_tax GROUP BY 1) t USING (tran_no)
       LEFT JOIN (SELECT tran_no, CAST(sum(total_igtax_amt) AS DECIMAL(20,4)) AS igtax_total FROM o_igtax GROUP BY 1) g USING (tran_no)""",
)
def item_disc_tax_totals(spark, sf):
    items = T.order_item(spark, sf)
    return totals.item_disc_tax_totals(
        items, T.order_disc(spark, sf), T.order_tax(spark, sf), tax.igtax_lines(items, T.ORDER_KEYS), T.ORDER_KEYS
    )


@query(
    "type_mix",
    ["ev_head"],
    """SELECT tran_type, count(*) AS n_trans, CAST((SELECT count(*) FROM ev_head) AS BIGINT) AS n_all,
         CAST(CASE tran_type WHEN 'SALE' THEN 85 WHEN 'RETURN' THEN 7 WHEN 'PVOID' THEN 3 WHEN 'PAIDIN' THEN 1 WHEN 'PAIDOUT' THEN 1 WHEN 'NOSALE' THEN 2 END AS INTEGER) AS expected_pct,
         count(*) * 10000 // (SELECT count(*) FROM ev_head) AS share_bp
       FROM ev_head GROUP BY tran_type""",
)
def type_mix(spark, sf):
    return totals.type_mix(T.till_log(spark, sf).select("tran_head.tran_type"))


@query(
    "tender_mix",
    ["o_tender"],
    """SELECT tender_type_group, tender_type_id, count(*) AS n_tenders, CAST(sum(tender_amt) AS DECIMAL(38,4)) AS amount,
         CAST((SELECT count(*) FROM o_tender) AS BIGINT) AS n_all,
         CAST(CASE tender_type_id WHEN 1 THEN 30 WHEN 2 THEN 50 ELSE 10 END AS INTEGER) AS expected_pct,
         count(*) * 10000 // (SELECT count(*) FROM o_tender) AS share_bp
       FROM o_tender GROUP BY 1, 2""",
)
def tender_mix(spark, sf):
    return totals.tender_mix(T.order_tender(spark, sf))


@query(
    "hourly_profile",
    ["ev_head"],
    """SELECT CAST(h AS INTEGER) AS hour, CAST(CASE WHEN h < 6 THEN 0.0 WHEN h = 6 THEN 0.2 WHEN h IN (7, 23) THEN 0.5 WHEN h IN (8, 22) THEN 1.0
           WHEN h IN (9, 21) THEN 1.5 WHEN h IN (10, 14, 15, 20) THEN 2.0 WHEN h IN (11, 13, 16) THEN 2.5 WHEN h IN (12, 17, 19) THEN 3.0 ELSE 3.5 END AS DECIMAL(4,1)) AS weight,
         count(event_id) AS n_trans
       FROM generate_series(0, 23) g(h) LEFT JOIN ev_head ON hour(ts) = h GROUP BY h""",
)
def hourly_profile(spark, sf):
    return totals.hourly_profile(T.till_log(spark, sf).select("tran_head.tran_datetime"))


@query(
    "daily_volume_index",
    ["o_head"],
    """SELECT store, business_date, count(*) AS n_trans, f AS day_factor, round(count(*) / CAST(f AS DOUBLE), 6) AS volume_index
       FROM (SELECT *, CAST((CASE isodow(business_date) WHEN 5 THEN 1.2 WHEN 6 THEN 1.8 WHEN 7 THEN 1.6 ELSE 1.0 END)
           * (CASE WHEN month(business_date) = 11 AND isodow(business_date) = 5 AND day(business_date) > 23 THEN 4.0 ELSE 1.0 END)
           AS DECIMAL(6,2)) AS f FROM o_head) GROUP BY store, business_date, f""",
)
def daily_volume_index(spark, sf):
    return totals.daily_volume_index(T.order_head(spark, sf)).withColumn(
        "volume_index", F.round("volume_index", 6)
    )


@query(
    "distinct_check",
    ["ev_head"],
    """SELECT count(*) AS n_rows, count(DISTINCT tran_seq_no) AS n_distinct, count(*) - count(DISTINCT tran_seq_no) AS n_repeated FROM ev_head""",
)
def distinct_check(spark, sf):
    return totals.distinct_check(T.till_log(spark, sf).select("tran_head.tran_seq_no"))


@query(
    "seen_tran_nos",
    ["ev_head"],
    "SELECT DISTINCT store, register, tran_no FROM ev_head",
)
def seen_tran_nos(spark, sf):
    return totals.seen_tran_nos(T.till_log(spark, sf).select("tran_head.*"))


@query(
    "store_day",
    ["ev_head", "stores"],
    """SELECT h.store, h.business_date, CAST(dayofyear(h.business_date) AS BIGINT) AS day, 'N' AS inv_bus_date_ind,
         CASE WHEN any_value(store_no) IS NULL THEN 'Y' ELSE 'N' END AS inv_store_ind,
         CASE WHEN c > 0 AND c >= o THEN 'CLOSED' ELSE 'OPEN' END AS store_status,
         CASE WHEN c > 0 AND c >= o THEN 'F' ELSE 'P' END AS data_status, 'UNAUDITED' AS audit_status,
         CAST(files AS BIGINT) AS files_loaded, CAST(oms AS BIGINT) AS oms_files_loaded
       FROM (SELECT store, business_date, count(*) FILTER (WHERE tran_type = 'OPEN') o, count(*) FILTER (WHERE tran_type = 'CLOSE') c,
               count(DISTINCT hour(ts)) FILTER (WHERE rtlog_orig_sys <> 'OMS') files,
               count(DISTINCT hour(ts)) FILTER (WHERE rtlog_orig_sys = 'OMS') oms
             FROM ev_head GROUP BY 1, 2) h LEFT JOIN stores ON h.store = store_no
       GROUP BY h.store, h.business_date, c, o, files, oms""",
)
def store_day(spark, sf):
    # one landing file per store, date and hour
    heads = T.till_log(spark, sf).select("tran_head.*")
    filed = heads.withColumn("source_file", F.substring("tran_datetime", 12, 2))
    return totals.build_store_day(filed, T.registry(spark, sf)).select(
        "store", "business_date", "day", "inv_bus_date_ind", "inv_store_ind", "store_status",
        "data_status", "audit_status", "files_loaded", "oms_files_loaded",
    )


@query(
    "calc_totals",
    ["ev_head", "ev_tender", "ev_tax", "ev_igtax", "ev_disc"],
    """SELECT g.store, g.business_date, CAST(dayofyear(g.business_date) AS BIGINT) AS day, g.total_id,
         CAST(coalesce(sum(a), 0) AS DECIMAL(20,4)) AS total_value
       FROM (SELECT DISTINCT store, business_date, t AS total_id FROM ev_head,
             (VALUES ('TNDCASH'), ('TNDCARD'), ('TAXTOTAL'), ('DISCTOTAL'), ('TRANCOUNT')) x(t)) g
       LEFT JOIN (
         SELECT store, business_date, 'TNDCASH' AS total_id, tender_amt AS a FROM ev_tender WHERE tender_type_group = 'CASH'
         UNION ALL SELECT store, business_date, 'TNDCARD', tender_amt FROM ev_tender WHERE tender_type_group = 'CARD'
         UNION ALL SELECT store, business_date, 'TAXTOTAL', tax_amt FROM ev_tax
         UNION ALL SELECT store, business_date, 'TAXTOTAL', total_igtax_amt FROM ev_igtax
         UNION ALL SELECT store, business_date, 'DISCTOTAL', qty * unit_discount_amt FROM ev_disc
         UNION ALL SELECT store, business_date, 'TRANCOUNT', 1 FROM ev_head) u
       ON g.store = u.store AND g.business_date = u.business_date AND g.total_id = u.total_id
       GROUP BY 1, 2, 3, 4""",
)
def calc_totals(spark, sf):
    t = conform.fan_out(T.till_log(spark, sf))
    return totals.calc_totals(
        t["sa_tran_head"], t["sa_tran_tender"], t["sa_tran_tax"], t["sa_tran_igtax"], t["sa_tran_disc"]
    )


@query(
    "errors_by_code",
    ["ev_all_hits"],
    """SELECT rtlog_orig_sys, store, business_date, error_code, count(*) AS n_errors FROM ev_all_hits GROUP BY 1, 2, 3, 4""",
)
def errors_by_code(spark, sf):
    return totals.errors_by_code(T.audited(spark, sf), "rtlog_orig_sys", "store", "business_date")


@query(
    "errors_rollup",
    ["ev_all_hits"],
    "SELECT rtlog_orig_sys, store, count(*) AS n_errors FROM ev_all_hits GROUP BY ROLLUP (rtlog_orig_sys, store)",
)
def errors_rollup(spark, sf):
    return totals.errors_rollup(T.audited(spark, sf))


# row rules of the six published faults; the sixth, TRAN_NO_DUP, looks at several records
_ROW_FAULTS = ["MISSING_TENDER", "TENDER_VAR_GT_01", "VOID_OOH", "NEG_QTY_NO_REF", "CC_NOT_MASKED"]


@query(
    "fault_rate",
    ["ev_head", "ev_row_hits"],
    """SELECT a AS n_all, b AS n_bad, b * 10000 // a AS rate_bp, CASE WHEN b * 10 <= a THEN 'Y' ELSE 'N' END AS in_range
       FROM (SELECT (SELECT count(*) FROM ev_head) a, (SELECT count(*) FROM (SELECT event_id FROM ev_row_hits
         WHERE error_code IN ('MISSING_TENDER', 'TENDER_VAR_GT_01', 'VOID_OOH', 'NEG_QTY_NO_REF', 'CC_NOT_MASKED')
         UNION SELECT event_id FROM ev_head QUALIFY count(*) OVER (PARTITION BY store, register, business_date, tran_no) > 1)) b)""",
)
def fault_rate(spark, sf):
    facts = rules.nested_facts(T.till_log(spark, sf))
    return totals.fault_rate(facts, rules.any_fault([rules.RULES[c] for c in _ROW_FAULTS]))


@query(
    "channel_variance",
    ["o_head", "o_tender"],
    """SELECT rtlog_orig_sys, count(*) AS n_trans, CAST(sum(value) AS DECIMAL(38,4)) AS value_total,
         CAST(sum(t) AS DECIMAL(38,4)) AS tender_total, CAST(sum(t - value) AS DECIMAL(38,4)) AS variance,
         count(*) FILTER (WHERE abs(t - value) > 0.01) AS n_out_of_balance
       FROM (SELECT h.*, coalesce(x.t, 0) AS t FROM o_head h LEFT JOIN
         (SELECT tran_no, CAST(sum(tender_amt) AS DECIMAL(20,4)) AS t FROM o_tender GROUP BY 1) x USING (tran_no)) GROUP BY 1""",
)
def channel_variance(spark, sf):
    return totals.channel_variance(T.order_head(spark, sf), T.order_tender(spark, sf), T.ORDER_KEYS)


@query(
    "weekly_summary",
    ["ev_head", "ev_all_hits"],
    """SELECT week, store, rtlog_orig_sys, CAST(sum(net) AS DECIMAL(38,4)) AS net_sales, CAST(sum(t) AS BIGINT) AS n_trans, CAST(sum(e) AS BIGINT) AS n_errors
       FROM (SELECT CAST(date_trunc('week', business_date) AS DATE) AS week, store, rtlog_orig_sys,
               CASE tran_type WHEN 'SALE' THEN value WHEN 'RETURN' THEN -value ELSE 0 END AS net, 1 AS t, 0 AS e FROM ev_head
             UNION ALL SELECT CAST(date_trunc('week', business_date) AS DATE), store, rtlog_orig_sys, 0, 0, 1 FROM ev_all_hits)
       GROUP BY 1, 2, 3""",
)
def weekly_summary(spark, sf):
    return totals.weekly_summary(T.till_log(spark, sf).select("tran_head.*"), T.audited(spark, sf))


@query(
    "nest_items",
    ["o_head", "o_item", "o_tax"],
    """SELECT h.tran_no, h.tran_type, coalesce(n, 0) AS n_items, coalesce(x, 0) AS n_taxes,
         CAST(coalesce(total, 0) AS DECIMAL(20,4)) AS line_total
       FROM o_head h LEFT JOIN (SELECT tran_no, CAST(count(*) AS INTEGER) AS n, sum(qty * unit_retail) AS total FROM o_item GROUP BY 1) i USING (tran_no)
       LEFT JOIN (SELECT tran_no, CAST(count(*) AS INTEGER) AS x FROM o_tax GROUP BY 1) t USING (tran_no)""",
)
def nest_items(spark, sf):
    from tillwarden.functions import money as M

    key = F.col("tran_no").cast("string").alias("record_key")
    nested = conform.nest_rtlog(
        T.order_head(spark, sf).select(key, "*"),
        {
            "tran_item": T.order_item(spark, sf).select(key, "*"),
            "tran_tax": T.order_tax(spark, sf).select(key, "*"),
        },
    )
    return nested.select(
        "tran_head.tran_no",
        "tran_head.tran_type",
        F.size("tran_item").alias("n_items"),
        F.size("tran_tax").alias("n_taxes"),
        M.round4(M.array_total("tran_item", lambda x: M.line_amount(x["qty"], x["unit_retail"]))).alias("line_total"),
    )


@query(
    "nest_roundtrip",
    ["ev_head"],
    "SELECT count(*) AS n_records, CAST(0 AS BIGINT) AS n_changed FROM ev_head",
)
def nest_roundtrip(spark, sf):
    """Fan records out and nest them again; every record must come back unchanged."""
    log = T.till_log(spark, sf)
    keyed = conform.with_keys(log).select("record_key", F.to_json(F.struct(*_RECORD)).alias("before"))
    heads = conform.heads(log)
    children = {c: conform.children(log, c) for c in _RECORD[2:]}
    # the record's own channel is not part of the header
    channel = conform.with_keys(log).select("record_key", F.col("rtlog_orig_sys").alias("_channel"))
    nested = conform.nest_rtlog(heads, children).join(channel, "record_key")
    after = nested.withColumn("rtlog_orig_sys", F.col("_channel")).select(
        "record_key", F.to_json(F.struct(*_RECORD)).alias("after")
    )
    same = F.col("before").eqNullSafe(F.col("after"))
    return keyed.join(after, "record_key", "full").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_if(~same).alias("n_changed")
    )


_RECORD = ["rtlog_orig_sys", "tran_head", "tran_item", "tran_disc", "tran_tender", "tran_tax", "tran_igtax"]
