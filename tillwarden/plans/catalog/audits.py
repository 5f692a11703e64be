"""Audit rules one by one, and the error table with its workflow."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillwarden import reference as ref
from tillwarden.functions import keys as K, rawjson
from tillwarden.operators import audit, conform, rules, tax
from tillwarden.plans import tables as T
from tillwarden.plans.catalog import query, register
from tillwarden.plans.sql import ROW_CODES, rule_body
from tillwarden.schemas import CHILDREN

_HIT = ["store", "business_date", "tran_seq_no", "rtlog_orig_sys", "error_code", "key_value_1", "key_value_2", "orig_value", "orig_cc_no", "section"]
_HIT_SQL = ", ".join(_HIT)


def _one_rule(code: str):
    def run(spark, sf):
        facts = rules.nested_facts(T.till_log(spark, sf))
        return rules.run_rules(facts, [rules.RULES[code]]).select(*_HIT)

    return run


for _code in ROW_CODES:
    register(
        f"rule_{_code.lower()}",
        _one_rule(_code),
        ["ev_facts"],
        f"SELECT {_HIT_SQL} FROM ({rule_body(_code)})",
    )


@query(
    "rule_partition_mismatch",
    ["ev_head"],
    """SELECT tran_seq_no, store, 'PARTITION_MISMATCH' AS error_code FROM ev_head WHERE store > 5""",
)
def rule_partition_mismatch(spark, sf):
    # filed under the group of stores instead of the store
    log = T.till_log(spark, sf)
    filed = log.withColumns(
        {
            "store": F.when(F.col("tran_head.store") > 5, F.lit(0).cast("long")).otherwise(F.col("tran_head.store")),
            "date": F.col("tran_head.business_date"),
            "hour": K.wall_hour_text("tran_head.tran_datetime"),
        }
    )
    return rules.run_rules(
        rules.nested_facts(filed), [rules.RULES["PARTITION_MISMATCH"]]
    ).select("tran_seq_no", "store", "error_code")


@query(
    "rule_tran_no_dup",
    ["ev_dup_hits"],
    f"SELECT {_HIT_SQL} FROM ev_dup_hits WHERE error_code = 'TRAN_NO_DUP'",
)
def rule_tran_no_dup(spark, sf):
    facts = conform.heads(T.till_log(spark, sf))
    return audit.duplicate_hits(facts).filter("error_code = 'TRAN_NO_DUP'").select(*_HIT)


@query(
    "rule_tran_seq_dup",
    ["ev_dup_hits"],
    f"SELECT {_HIT_SQL} FROM ev_dup_hits WHERE error_code = 'TRAN_SEQ_DUP'",
)
def rule_tran_seq_dup(spark, sf):
    facts = conform.heads(T.till_log(spark, sf))
    return audit.duplicate_hits(facts).filter("error_code = 'TRAN_SEQ_DUP'").select(*_HIT)


def _raw_lines(spark, sf, with_nulls: bool):
    """Records as text; amounts as plain numbers with all their decimals."""
    log = T.till_log(spark, sf)
    record = F.struct("rtlog_orig_sys", "tran_head", "tran_item", "tran_disc", "tran_tender", "tran_tax")
    text = F.to_json(record, {"ignoreNullFields": "false" if with_nulls else "true"})
    return log.select(text.alias("value"), "record_key", "event_id")


@query(
    "rule_scale_gt_4",
    ["ev_tender"],
    "SELECT store, business_date, tran_seq_no, 'SCALE_GT_4' AS error_code FROM ev_tender WHERE tender_amt % 0.01 <> 0",
)
def rule_scale_gt_4(spark, sf):
    """Tender amounts divided by a hundred, so that sub-cent amounts get six decimals."""
    log = T.till_log(spark, sf)
    hundredth = F.transform(
        "tran_tender",
        lambda t: F.struct((t["tender_amt"].cast("decimal(24,6)") / 100).cast("decimal(24,6)").alias("tender_amt")),
    )
    lines = log.select(
        F.to_json(F.struct("rtlog_orig_sys", "tran_head", hundredth.alias("tran_tender"))).alias("value"),
        "record_key",
    )
    return audit.raw_hits(lines).filter("error_code = 'SCALE_GT_4'").select(
        "store", "business_date", "tran_seq_no", "error_code"
    )


@query(
    "rule_keys_missing",
    ["ev_head"],
    "SELECT store, business_date, tran_seq_no, 'KEYS_MISSING' AS error_code, 'tran_igtax' AS orig_value FROM ev_head",
)
def rule_keys_missing(spark, sf):
    return audit.raw_hits(_raw_lines(spark, sf, True)).filter("error_code = 'KEYS_MISSING'").select(
        "store", "business_date", "tran_seq_no", "error_code", "orig_value"
    )


@query(
    "rule_item_class_key",
    ["ev_head"],
    """SELECT tran_seq_no, CASE WHEN n_lines > 0 THEN 'N' ELSE 'Y' END AS ok FROM ev_head""",
)
def rule_item_class_key(spark, sf):
    """Items written with a renamed key must be noticed."""
    renamed = F.transform("tran_item", lambda x: F.struct(x["item_seq_no"].alias("item_seq_no"), x["class"].alias("class_")))
    lines = T.till_log(spark, sf).select(
        "tran_head.tran_seq_no", F.to_json(F.struct(renamed.alias("tran_item"))).alias("value")
    )
    return lines.select(
        "tran_seq_no", F.when(rawjson.item_keys_ok("value"), "Y").otherwise("N").alias("ok")
    )


@query(
    "rule_igtax_rollup",
    ["ev_item", "ev_igtax"],
    """SELECT tran_seq_no, error_code, item_seq_no AS key_value_1 FROM (
         SELECT i.tran_seq_no, 'IGTAX_ROLLUP' AS error_code, i.item_seq_no
         FROM ev_item i LEFT JOIN (SELECT event_id, item_seq_no, sum(total_igtax_amt) AS s FROM ev_igtax GROUP BY 1, 2) g
           ON g.event_id = i.event_id AND g.item_seq_no = i.item_seq_no
         WHERE coalesce(i.total_igtax_amt, 0) <> coalesce(s, 0)
         UNION ALL
         SELECT i.tran_seq_no, 'IGTAX_ROLLUP', i.item_seq_no
         FROM ev_igtax g JOIN ev_item i ON g.event_id = i.event_id AND g.item_seq_no = i.item_seq_no
         WHERE CAST(i.qty * CAST(0.09 AS DECIMAL(4,4)) * i.unit_retail AS DECIMAL(20,4)) <> g.total_igtax_amt)""",
)
def rule_igtax_rollup(spark, sf):
    hits = audit.tax_hits(
        audit.typed_children(T.till_log(spark, sf), "tran_item"),
        audit.typed_children(T.till_log(spark, sf), "tran_igtax"),
        ["record_key"],
    )
    return hits.select("tran_seq_no", "error_code", "key_value_1")


@query(
    "rule_disc_recalc",
    ["ev_disc", "ev_item", "promos"],
    """SELECT d.tran_seq_no, d.promotion, d.unit_discount_amt, CAST(i.unit_retail * p.disc_pct AS DECIMAL(20,4)) AS expected_amt
       FROM ev_disc d JOIN ev_item i ON d.event_id = i.event_id AND d.item_seq_no = i.item_seq_no
       LEFT JOIN promos p ON p.promo_id = d.promotion
       WHERE d.tran_type <> 'SALE' OR p.disc_pct IS NULL
         OR CAST(i.unit_retail * p.disc_pct AS DECIMAL(20,4)) <> d.unit_discount_amt""",
)
def rule_disc_recalc(spark, sf):
    disc = audit.typed_children(T.till_log(spark, sf), "tran_disc").select(
        "record_key", "tran_seq_no", "item_seq_no", "promotion", "unit_discount_amt"
    )
    items = audit.typed_children(T.till_log(spark, sf), "tran_item")
    return tax.discount_errors(disc, items, ref.promotions(spark), ["record_key"]).select(
        "tran_seq_no", "promotion", "unit_discount_amt", "expected_amt"
    )


@query(
    "rule_ref_integrity",
    ["ev_set_hits"],
    f"SELECT {_HIT_SQL} FROM ev_set_hits WHERE error_code = 'REF_INTEGRITY'",
)
def rule_ref_integrity(spark, sf):
    """Rows of the five children whose header went to quarantine have no header."""
    log = T.till_log(spark, sf)
    good, _ = conform.quarantine(log)
    children = {c: audit.typed_children(log, c) for c in CHILDREN}
    return audit.orphan_hits(conform.heads(good), children).select(*_HIT)


@query(
    "rule_ref_data_invalid",
    ["ev_item", "ev_disc"],
    """SELECT tran_seq_no, 'REF_DATA_INVALID' AS error_code, item_seq_no AS key_value_1, item AS orig_value
       FROM ev_item LEFT JOIN (VALUES ('APP-M-0001', 799), ('APP-M-0002', 999), ('APP-M-0003', 1199), ('APP-M-0004', 1399), ('APP-M-0005', 1599)) p(sku, base)
         ON item = sku WHERE sku IS NULL OR abs(unit_retail - base) > 50
       UNION ALL
       SELECT tran_seq_no, 'REF_DATA_INVALID', item_seq_no, CAST(promotion AS VARCHAR) FROM ev_disc WHERE promotion > 500004""",
)
def rule_ref_data_invalid(spark, sf):
    return audit.reference_hits(
        audit.typed_children(T.till_log(spark, sf), "tran_item"),
        audit.typed_children(T.till_log(spark, sf), "tran_disc"),
        audit.typed_children(T.till_log(spark, sf), "tran_tender"),
        ref.products(spark),
    ).select("tran_seq_no", "error_code", "key_value_1", "orig_value")


@query(
    "run_rules",
    ["ev_row_hits"],
    f"SELECT {_HIT_SQL} FROM ev_row_hits",
)
def run_rules(spark, sf):
    return rules.run_rules(rules.nested_facts(T.till_log(spark, sf))).select(*_HIT)


@query(
    "rule_report",
    ["ev_all_hits"],
    "SELECT rtlog_orig_sys, error_code, count(*) AS n_errors FROM ev_all_hits GROUP BY 1, 2",
)
def rule_report(spark, sf):
    """All 27 rules."""
    return audit.rule_report(T.audited(spark, sf))


@query("audit_all", ["ev_all_hits"], f"SELECT {_HIT_SQL} FROM ev_all_hits")
def audit_all(spark, sf):
    """Every error of every rule, one row for each offending line."""
    return T.audited(spark, sf).select(*_HIT)


@query(
    "order_audit",
    ["o_head", "o_item", "o_tender", "o_disc"],
    """SELECT * FROM (WITH f AS (
         SELECT h.*, coalesce(n_items, 0) AS n_items, coalesce(line_total, 0) AS line_total, ok, coalesce(n_t, 0) AS n_t, coalesce(tt, 0) AS tt, coalesce(dd, 0) AS dd
         FROM o_head h
         LEFT JOIN (SELECT tran_no, count(*) AS n_items, CAST(sum(qty * unit_retail) AS DECIMAL(20,4)) AS line_total,
             min(item_seq_no) = 1 AND max(item_seq_no) = count(*) AND count(DISTINCT item_seq_no) = count(*) AS ok FROM o_item GROUP BY 1) i USING (tran_no)
         LEFT JOIN (SELECT tran_no, count(*) AS n_t, CAST(sum(tender_amt) AS DECIMAL(20,4)) AS tt FROM o_tender GROUP BY 1) t USING (tran_no)
         LEFT JOIN (SELECT tran_no, CAST(sum(qty * unit_discount_amt) AS DECIMAL(20,4)) AS dd FROM o_disc GROUP BY 1) d USING (tran_no))
       SELECT tran_no, error_code, CAST(key_value_1 AS BIGINT) AS key_value_1, orig_value, orig_cc_no FROM (
         SELECT tran_no, 'MISSING_TENDER' AS error_code, NULL AS key_value_1, CAST(value AS VARCHAR) AS orig_value, NULL AS orig_cc_no FROM f WHERE n_t = 0 AND value > 0
         UNION ALL SELECT tran_no, 'TENDER_VAR_GT_01', NULL, CAST(tt AS VARCHAR), NULL FROM f WHERE n_t > 0 AND abs(tt - value) > 0.01
         UNION ALL SELECT tran_no, 'NEG_QTY_NO_REF', item_seq_no, CAST(qty AS VARCHAR), NULL FROM o_item JOIN o_head USING (tran_no)
           WHERE tran_type = 'SALE' AND qty < 0 AND return_reason_code IS NULL
         UNION ALL SELECT tran_no, 'CC_NOT_MASKED', tender_seq_no, NULL, '************' || right(cc_no, 4) FROM o_tender
           WHERE tender_type_group = 'CARD' AND cc_no NOT LIKE '*%'
         UNION ALL SELECT tran_no, 'SALE_NO_ITEM', NULL, NULL, NULL FROM f WHERE tran_type = 'SALE' AND n_items = 0
         UNION ALL SELECT tran_no, 'ITEM_SEQ_GAP', NULL, NULL, NULL FROM f WHERE n_items > 0 AND NOT ok
         UNION ALL SELECT tran_no, 'VALUE_MISMATCH', NULL, CAST(value AS VARCHAR), NULL FROM f WHERE abs(greatest(line_total - dd, 0) - value) > 0.01))""",
)
def order_audit(spark, sf):
    """The rules on flat tables: children are aggregated, then joined."""
    items = T.order_item(spark, sf).withColumns(
        {
            "drop_ship_ind": F.lit("N"), "item_status": F.lit("ACTIVE"), "tax_ind": F.lit("Y"),
            "item_swiped_ind": F.lit("N"), "error_ind": F.lit("N"), "unit_retail_vat_incl": F.lit("Y"),
        }
    )
    tender = T.order_tender(spark, sf).withColumn("error_ind", F.lit("N"))
    disc = T.order_disc(spark, sf).withColumns(
        {"error_ind": F.lit("N"), "discount_seq_no": F.col("item_seq_no")}
    )
    facts = rules.flat_facts(
        T.order_head(spark, sf),
        {"tran_item": items, "tran_tender": tender, "tran_disc": disc},
        T.ORDER_KEYS,
    )
    codes = ["MISSING_TENDER", "TENDER_VAR_GT_01", "NEG_QTY_NO_REF", "CC_NOT_MASKED", "SALE_NO_ITEM", "ITEM_SEQ_GAP", "VALUE_MISMATCH"]
    return rules.run_rules(facts, [rules.RULES[c] for c in codes], ["tran_no"]).select(
        "tran_no", "error_code", "key_value_1", "orig_value", "orig_cc_no"
    )


def _errors(spark, sf):
    return audit.build_sa_error(T.audited(spark, sf), F.lit("2024-02-01 00:00:00").cast("timestamp"))


@query(
    "sa_error",
    ["ev_all_hits"],
    """SELECT store, CAST(dayofyear(business_date) AS BIGINT) AS day, CAST(NULL AS BIGINT) AS bal_group_seq_no,
         CAST(NULL AS BIGINT) AS total_seq_no, error_code, key_value_1, key_value_2, 'SART' AS rec_type,
         'N' AS store_override_ind, 'N' AS hq_override_ind, 'AUDIT' AS update_id, orig_value, orig_cc_no
       FROM ev_all_hits""",
)
def sa_error(spark, sf):
    return _errors(spark, sf).select(
        "store", "day", "bal_group_seq_no", "total_seq_no", "error_code", "key_value_1", "key_value_2",
        "rec_type", "store_override_ind", "hq_override_ind", "update_id", "orig_value", "orig_cc_no",
    )


@query(
    "sa_error_references",
    ["ev_all_hits"],
    """SELECT count(*) AS n_errors, CAST(0 AS BIGINT) AS n_violations, count(*) AS n_ids FROM ev_all_hits""",
)
def sa_error_references(spark, sf):
    """Every error points at exactly one object and has its own id."""
    # all counts in one pass: an id is counted with its rows first
    per_id = _errors(spark, sf).groupBy("error_seq_no").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~audit.points_at_one()).alias("bad")
    )
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_errors"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_violations"),
        F.count("error_seq_no").alias("n_ids"),
    )


_BLOCKING = """('MISSING_TENDER', 'TENDER_VAR_GT_01', 'TRAN_NO_DUP', 'NEG_QTY_NO_REF', 'CC_NOT_MASKED', 'CHANNEL_INVALID',
  'TRAN_SEQ_DUP', 'CODE_INVALID', 'IND_INVALID', 'SALE_NO_ITEM', 'RETAIL_NOT_POSITIVE', 'VALUE_MISMATCH',
  'KEYS_MISSING', 'REF_INTEGRITY', 'REF_DATA_INVALID')"""
_STATUS_SQL = f"""SELECT h.tran_seq_no, h.store, h.business_date, coalesce(e, 0) AS n_errors, coalesce(b, 0) AS n_blocking,
    CASE WHEN coalesce(e, 0) > 0 THEN 'Y' ELSE 'N' END AS error_ind,
    CASE WHEN coalesce(b, 0) > 0 THEN 'ERRORED' WHEN coalesce(e, 0) > 0 THEN 'VALIDATED' ELSE 'APPROVED' END AS status
  FROM ev_head h LEFT JOIN (SELECT event_id, count(*) AS e, count(*) FILTER (WHERE error_code IN {_BLOCKING}) AS b
    FROM ev_all_hits GROUP BY 1) x USING (event_id)"""


def _status(spark, sf):
    return audit.advance_status(
        conform.heads(T.till_log(spark, sf)).drop("store_day_seq_no"), _errors(spark, sf).drop("store", "business_date"), ref.error_codes(spark)
    )


@query(
    "status_flow",
    ["ev_head", "ev_all_hits"],
    f"SELECT tran_seq_no, n_errors, n_blocking, error_ind, status FROM ({_STATUS_SQL})",
)
def status_flow(spark, sf):
    return _status(spark, sf).select("tran_seq_no", "n_errors", "n_blocking", "error_ind", "status")


@query(
    "audit_status",
    ["ev_head", "ev_all_hits"],
    f"""SELECT store, business_date, count(*) AS n_trans, count(*) FILTER (WHERE status = 'ERRORED') AS n_errored,
          CASE WHEN count(*) FILTER (WHERE status = 'ERRORED') > 0 THEN 'INPROGRESS' ELSE 'AUDITED' END AS audit_status
        FROM ({_STATUS_SQL}) GROUP BY 1, 2""",
)
def audit_status(spark, sf):
    return audit.advance_audit_status(_status(spark, sf))
