"""SQL twins of the table adapters, for checking results with another engine."""

from __future__ import annotations

# name -> (views it reads, body)
VIEWS: dict[str, tuple[list[str], str]] = {}


def _view(name: str, needs: list[str], body: str) -> None:
    VIEWS[name] = (needs, body)


_view("e0", [], """
    SELECT event_id, ts, CAST(ts AS DATE) AS business_date, event_type,
           CAST(value AS DECIMAL(20,4)) AS amount,
           CAST(regexp_extract(props, '[0-9]+') AS BIGINT) + 1 AS n,
           user_id % 30 + 1 AS store,
           'TILL' || lpad(CAST(user_id // 30 % 4 + 1 AS VARCHAR), 2, '0') AS register,
           user_id
    FROM events""")
_view("e1", ["e0"], """
    SELECT *,
      CASE WHEN event_type IN ('purchase', 'click') THEN 'SALE' WHEN event_type = 'view' THEN 'RETURN'
           WHEN event_type = 'error' THEN 'PVOID' WHEN n <= 25 THEN 'OPEN' WHEN n <= 50 THEN 'CLOSE'
           WHEN n <= 75 THEN 'PAIDIN' ELSE 'NOSALE' END AS tran_type,
      CASE WHEN store % 10 < 6 THEN 'POS' WHEN store % 10 < 8 THEN 'OMS' ELSE 'MKT' END AS channel
    FROM e0""")
_view("e2", ["e1"], """
    SELECT *,
      CASE WHEN tran_type IN ('SALE', 'RETURN', 'PVOID') THEN n % 4 ELSE 0 END AS n_lines,
      CAST(CASE WHEN tran_type = 'RETURN' OR n % 17 = 0 THEN -(n % 3 + 1) ELSE n % 3 + 1 END
           AS DECIMAL(12,4)) AS qty
    FROM e1""")
_view("e3", ["e2"], """
    SELECT *, tran_type = 'SALE' AND n_lines >= 1 AND n % 4 = 1 AS has_disc,
      CAST(amount * CAST(0.1 AS DECIMAL(4,4)) AS DECIMAL(20,4)) AS unit_disc,
      CAST(qty * CAST(0.09 AS DECIMAL(4,4)) * amount AS DECIMAL(20,4)) AS igtax_amt,
      CAST(qty * CAST(0.18 AS DECIMAL(4,4)) * amount AS DECIMAL(20,4)) AS tax_amt
    FROM e2""")
_view("e4", ["e3"], """
    SELECT *,
      CAST(CASE WHEN tran_type IN ('OPEN', 'CLOSE', 'NOSALE', 'RETURN') THEN 0
           WHEN tran_type = 'PAIDIN' OR n_lines = 0 OR n % 9 = 0 THEN amount
           ELSE greatest(CAST(amount * qty * CAST(n_lines AS DECIMAL(2,0)) AS DECIMAL(20,4))
                - CASE WHEN has_disc THEN CAST(unit_disc * qty AS DECIMAL(20,4)) ELSE 0 END, 0)
           END AS DECIMAL(20,4)) AS value
    FROM e3""")
_view("ev_head", ["e4"], """
    SELECT *,
      CASE WHEN tran_type = 'PAIDIN' THEN 1 ELSE event_id % 4 + 1 END AS tender_type_id,
      value > 0 AND n % 10 <> 0 AS has_tender,
      'STR' || lpad(CAST(store AS VARCHAR), 3, '0') || '-' || register || '-' || CAST(business_date AS VARCHAR)
        || '-' || CASE WHEN event_type = 'click' AND event_id >= 1000000 THEN CAST(event_id AS VARCHAR)
                       ELSE lpad(CAST(CASE WHEN event_type = 'click' THEN event_id ELSE n END AS VARCHAR), 6, '0') END
        AS tran_seq_no,
      strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+05:30' AS tran_datetime,
      n AS tran_no,
      CASE WHEN amount > 300 THEN 'REVIEW' ELSE 'IMPORTED' END AS status,
      CASE WHEN tran_type = 'PAIDIN' AND n % 2 = 0 THEN 'N' ELSE 'Y' END AS pos_tran_ind,
      CASE WHEN amount > 250 THEN 'X' ELSE 'N' END AS error_ind,
      CASE WHEN store = 30 THEN 2 ELSE 1 END AS banner_no,
      channel AS rtlog_orig_sys,
      CASE WHEN amount < 1 THEN 'WEB' ELSE channel END AS record_channel,
      CASE WHEN tran_type = 'PVOID' THEN n - 1 END AS orig_tran_no,
      CASE WHEN tran_type = 'PVOID' THEN 'SALE' END AS orig_tran_type,
      CASE WHEN tran_type = 'PVOID' THEN register END AS orig_reg_no,
      CASE WHEN tran_type = 'PAIDIN' AND n % 3 <> 0 THEN 'VND' || CAST(100 + store AS VARCHAR) END AS vendor_no,
      CASE WHEN tran_type = 'SALE' AND n % 3 = 0 THEN 'LOYALTY-' || lpad(CAST(user_id AS VARCHAR), 7, '0') END AS ref_no1
    FROM e4""")
_view("ev_item", ["ev_head"], """
    SELECT h.event_id, h.store, h.business_date, h.tran_seq_no, h.rtlog_orig_sys, h.tran_type,
      CASE WHEN event_type = 'error' AND n % 5 = 0 THEN i + 1 ELSE i END AS item_seq_no,
      CASE WHEN tran_type = 'PVOID' THEN 'VOIDED' WHEN n % 23 = 0 THEN 'LOST' ELSE 'ACTIVE' END AS item_status,
      'APP-M-' || lpad(CAST((event_id + i) % 6 + 1 AS VARCHAR), 4, '0') AS item,
      qty, CAST(CASE WHEN n % 29 = 0 THEN 0 ELSE amount END AS DECIMAL(20,4)) AS unit_retail,
      CASE WHEN n % 31 = 0 THEN '1' ELSE 'Y' END AS tax_ind,
      CASE WHEN channel <> 'POS' OR n % 19 = 0 THEN 'Y' ELSE 'N' END AS drop_ship_ind,
      CAST(igtax_amt * 2 + CASE WHEN n % 13 = 0 THEN 0.01 ELSE 0 END AS DECIMAL(20,4)) AS total_igtax_amt,
      CASE WHEN tran_type = 'RETURN' THEN 'CUST' END AS return_reason_code
    FROM ev_head h, generate_series(1, n_lines) g(i)""")
_view("ev_disc", ["ev_head"], """
    SELECT event_id, store, business_date, tran_seq_no, rtlog_orig_sys, tran_type,
      CAST(1 AS BIGINT) AS item_seq_no, CAST(1 AS BIGINT) AS discount_seq_no,
      500001 + event_id % 5 AS promotion, qty, unit_disc AS unit_discount_amt
    FROM ev_head WHERE has_disc""")
_view("ev_tender", ["ev_head"], """
    SELECT event_id, store, business_date, tran_seq_no, rtlog_orig_sys, tran_no, CAST(1 AS BIGINT) AS tender_seq_no,
      CASE tender_type_id WHEN 1 THEN 'CASH' WHEN 3 THEN 'VOUCHER' ELSE 'CARD' END AS tender_type_group,
      tender_type_id,
      CAST(value + CASE WHEN n % 7 = 0 THEN 0.05 ELSE 0 END AS DECIMAL(20,4)) AS tender_amt,
      CASE WHEN tender_type_id IN (2, 4) THEN
        CASE WHEN n % 11 = 0 THEN '4' || lpad(CAST(event_id AS VARCHAR), 15, '0')
             ELSE '************' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') END END AS cc_no,
      value AS orig_curr_amt
    FROM ev_head WHERE has_tender""")
_view("ev_tax", ["ev_head"], """
    SELECT event_id, store, business_date, tran_seq_no, rtlog_orig_sys, CAST(1 AS BIGINT) AS tax_seq_no, tax_amt
    FROM ev_head WHERE n_lines > 0 AND n % 6 = 0""")
_view("ev_igtax", ["ev_head"], """
    SELECT event_id, store, business_date, tran_seq_no, rtlog_orig_sys, (i - 1) // 2 + 1 AS item_seq_no,
      i AS igtax_seq_no, CASE WHEN i % 2 = 1 THEN 'CGST' ELSE 'SGST' END AS tax_authority,
      igtax_amt AS total_igtax_amt
    FROM ev_head, generate_series(1, n_lines * 2) g(i)""")
_view("ev_facts", ["ev_head", "ev_item", "ev_disc", "ev_tender", "ev_tax", "ev_igtax"], """
    SELECT h.*,
      coalesce(i.n_items, 0) AS n_items, coalesce(i.line_total, 0) AS line_total, i.items_ok,
      coalesce(d.disc_total, 0) AS disc_total,
      coalesce(t.n_tenders, 0) AS n_tenders, coalesce(t.tender_total, 0) AS tender_total,
      t.n_noncash,
      coalesce(x.n_taxes, 0) AS n_taxes, coalesce(g.n_igtaxes, 0) AS n_igtaxes
    FROM ev_head h
    LEFT JOIN (
      SELECT event_id, count(*) AS n_items, CAST(sum(qty * unit_retail) AS DECIMAL(20,4)) AS line_total,
        min(item_seq_no) = 1 AND max(item_seq_no) = count(*) AS items_ok
      FROM ev_item GROUP BY event_id) i ON i.event_id = h.event_id
    LEFT JOIN (
      SELECT event_id, CAST(sum(qty * unit_discount_amt) AS DECIMAL(20,4)) AS disc_total
      FROM ev_disc GROUP BY event_id) d ON d.event_id = h.event_id
    LEFT JOIN (
      SELECT event_id, count(*) AS n_tenders, CAST(sum(tender_amt) AS DECIMAL(20,4)) AS tender_total,
        count(*) FILTER (WHERE tender_type_group <> 'CASH') AS n_noncash
      FROM ev_tender GROUP BY event_id) t ON t.event_id = h.event_id
    LEFT JOIN (SELECT event_id, count(*) AS n_taxes FROM ev_tax GROUP BY event_id) x ON x.event_id = h.event_id
    LEFT JOIN (SELECT event_id, count(*) AS n_igtaxes FROM ev_igtax GROUP BY event_id) g ON g.event_id = h.event_id""")

# rule -> (test, orig_value) over ev_facts, for errors of the transaction
RULE_SQL = {
    "MISSING_TENDER": ("n_tenders = 0 AND value > 0", "CAST(value AS VARCHAR)"),
    "TENDER_VAR_GT_01": ("n_tenders > 0 AND abs(tender_total - value) > 0.01", "CAST(tender_total AS VARCHAR)"),
    "VOID_OOH": ("tran_type = 'PVOID' AND (hour(ts) < 6 OR hour(ts) >= 23)", "strftime(ts, '%H:%M:%S')"),
    "CHANNEL_INVALID": ("record_channel <> rtlog_orig_sys OR record_channel NOT IN ('POS', 'OMS', 'MKT')", "record_channel"),
    "CODE_INVALID": ("status = 'REVIEW'", "tran_type || '/' || status"),
    "IND_INVALID": ("error_ind NOT IN ('Y', 'N') OR pos_tran_ind NOT IN ('Y', 'N')", "'error_ind=' || error_ind"),
    "SALE_NO_ITEM": ("tran_type = 'SALE' AND n_items = 0", "NULL"),
    "ITEM_SEQ_GAP": ("n_items > 0 AND NOT items_ok", "NULL"),
    "TAX_MODE_MIX": ("n_taxes > 0 AND n_igtaxes > 0", "NULL"),
    "VALUE_MISMATCH": ("tran_type IN ('SALE', 'RETURN', 'PVOID') AND abs(greatest(line_total - disc_total, 0) - value) > 0.01", "CAST(value AS VARCHAR)"),
    "PAIDIO_SHAPE": ("tran_type IN ('PAIDIN', 'PAIDOUT') AND NOT (n_tenders = 1 AND n_noncash = 0 AND tender_total = value AND pos_tran_ind = 'N' AND vendor_no IS NOT NULL AND n_items = 0)", "NULL"),
    "SEQ_FORMAT": ("event_type = 'click' AND event_id <> n", "tran_seq_no"),
    "BANNER_INVALID": ("banner_no <> 1", "CAST(banner_no AS VARCHAR)"),
}

# rule -> (child view, test, orig_value, orig_cc_no), for errors of single rows
LINE_SQL = {
    "NEG_QTY_NO_REF": ("ev_item", "tran_type = 'SALE' AND qty < 0 AND return_reason_code IS NULL", "CAST(qty AS VARCHAR)", "NULL"),
    "CC_NOT_MASKED": ("ev_tender", "tender_type_group = 'CARD' AND cc_no NOT LIKE '*%'", "NULL", "'************' || right(cc_no, 4)"),
    "CODE_INVALID": ("ev_item", "item_status NOT IN ('ACTIVE', 'VOIDED', 'REFUNDED')", "item_status", "NULL"),
    "IND_INVALID": ("ev_item", "tax_ind NOT IN ('Y', 'N')", "'tax_ind=' || tax_ind", "NULL"),
    "RETAIL_NOT_POSITIVE": ("ev_item", "unit_retail <= 0", "CAST(unit_retail AS VARCHAR)", "NULL"),
    "POS_DROP_SHIP": ("ev_item", "rtlog_orig_sys = 'POS' AND drop_ship_ind <> 'N'", "drop_ship_ind", "NULL"),
    "CURR_AMT_MISMATCH": ("ev_tender", "orig_curr_amt <> tender_amt", "'INR'", "NULL"),
}

# child view -> KEY_VALUE_1, KEY_VALUE_2
LINE_KEYS = {
    "ev_item": ("item_seq_no", "NULL"),
    "ev_disc": ("item_seq_no", "discount_seq_no"),
    "ev_tender": ("tender_seq_no", "NULL"),
    "ev_tax": ("tax_seq_no", "NULL"),
    "ev_igtax": ("item_seq_no", "igtax_seq_no"),
}

HIT_COLUMNS = "store, business_date, tran_seq_no, rtlog_orig_sys"


def line_select(view: str, code: str, test: str, value: str = "NULL", card: str = "NULL") -> str:
    """Error rows of the rows of a child view (or a query with its columns, named ``<view>``)."""
    key_1, key_2 = LINE_KEYS[view.split()[-1]]
    section = view.split()[-1].replace("ev_", "tran_")
    return (
        f"SELECT event_id, {HIT_COLUMNS}, '{code}' AS error_code, CAST({key_1} AS BIGINT) AS key_value_1, "
        f"CAST({key_2} AS BIGINT) AS key_value_2, CAST({value} AS VARCHAR) AS orig_value, "
        f"CAST({card} AS VARCHAR) AS orig_cc_no, '{section}' AS section FROM {view} WHERE {test}"
    )


def rule_body(code: str) -> str:
    parts = []
    if code in RULE_SQL:
        test, value = RULE_SQL[code]
        parts.append(
            f"SELECT event_id, {HIT_COLUMNS}, '{code}' AS error_code, CAST(NULL AS BIGINT) AS key_value_1, "
            f"CAST(NULL AS BIGINT) AS key_value_2, CAST({value} AS VARCHAR) AS orig_value, "
            f"CAST(NULL AS VARCHAR) AS orig_cc_no, CAST(NULL AS VARCHAR) AS section FROM ev_facts WHERE {test}"
        )
    if code in LINE_SQL:
        view, test, value, card = LINE_SQL[code]
        parts.append(line_select(view, code, test, value, card))
    return " UNION ALL ".join(parts)


ROW_CODES = [*RULE_SQL, *(c for c in LINE_SQL if c not in RULE_SQL)]
_view("ev_row_hits", ["ev_facts"], "\n    UNION ALL ".join(rule_body(c) for c in ROW_CODES))
_view("ev_dup_hits", ["ev_head"], f"""
    SELECT event_id, {HIT_COLUMNS}, 'TRAN_NO_DUP' AS error_code, CAST(NULL AS BIGINT) AS key_value_1,
      CAST(NULL AS BIGINT) AS key_value_2, CAST(tran_no AS VARCHAR) AS orig_value, CAST(NULL AS VARCHAR) AS orig_cc_no,
      CAST(NULL AS VARCHAR) AS section
    FROM (SELECT *, count(*) OVER (PARTITION BY store, register, business_date, tran_no) AS c FROM ev_head) WHERE c > 1
    UNION ALL
    SELECT event_id, {HIT_COLUMNS}, 'TRAN_SEQ_DUP', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), tran_seq_no, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
    FROM (SELECT *, count(*) OVER (PARTITION BY tran_seq_no) AS c FROM ev_head) WHERE c > 1""")
_view("ev_hits", ["ev_row_hits", "ev_dup_hits"], "SELECT * FROM ev_row_hits UNION ALL SELECT * FROM ev_dup_hits")

_view("ev_set_hits", ["ev_item", "ev_disc", "ev_tender", "ev_tax", "ev_igtax", "ev_head", "promos"], "\n    UNION ALL ".join([
    line_select("""(SELECT i.* FROM ev_item i LEFT JOIN (SELECT event_id, item_seq_no, sum(total_igtax_amt) AS s FROM ev_igtax GROUP BY 1, 2) g
        ON g.event_id = i.event_id AND g.item_seq_no = i.item_seq_no WHERE coalesce(i.total_igtax_amt, 0) <> coalesce(s, 0)) ev_item""",
        "IGTAX_ROLLUP", "true", "total_igtax_amt"),
    line_select("""(SELECT g.* FROM ev_igtax g JOIN ev_item i ON g.event_id = i.event_id AND g.item_seq_no = i.item_seq_no
        WHERE CAST(i.qty * CAST(0.09 AS DECIMAL(4,4)) * i.unit_retail AS DECIMAL(20,4)) <> g.total_igtax_amt) ev_igtax""",
        "IGTAX_ROLLUP", "true", "total_igtax_amt"),
    line_select("""(SELECT d.* FROM ev_disc d JOIN ev_item i ON d.event_id = i.event_id AND d.item_seq_no = i.item_seq_no
        LEFT JOIN promos p ON p.promo_id = d.promotion WHERE d.tran_type <> 'SALE' OR p.disc_pct IS NULL
          OR CAST(i.unit_retail * p.disc_pct AS DECIMAL(20,4)) <> d.unit_discount_amt) ev_disc""",
        "DISC_RECALC", "true", "unit_discount_amt"),
    line_select("""(SELECT i.* FROM ev_item i LEFT JOIN (VALUES ('APP-M-0001', 799), ('APP-M-0002', 999), ('APP-M-0003', 1199),
          ('APP-M-0004', 1399), ('APP-M-0005', 1599)) p(sku, base) ON item = sku
        WHERE sku IS NULL OR abs(unit_retail - base) > 50) ev_item""", "REF_DATA_INVALID", "true", "item"),
    line_select("ev_disc", "REF_DATA_INVALID", "promotion > 500004", "promotion"),
    *(line_select(v, "REF_INTEGRITY", "event_id IN (SELECT event_id FROM ev_head WHERE error_ind NOT IN ('Y', 'N'))") for v in LINE_KEYS),
]))
_view("ev_raw_hits", ["ev_head", "ev_tender"], f"""
    SELECT event_id, {HIT_COLUMNS}, 'KEYS_MISSING' AS error_code, CAST(NULL AS BIGINT) AS key_value_1, CAST(NULL AS BIGINT) AS key_value_2,
      'tran_tax' AS orig_value, CAST(NULL AS VARCHAR) AS orig_cc_no, CAST(NULL AS VARCHAR) AS section
    FROM ev_head WHERE tran_no % 41 = 0
    UNION ALL
    SELECT DISTINCT event_id, {HIT_COLUMNS}, 'SCALE_GT_4', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT),
      CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
    FROM ev_tender WHERE tran_no % 43 = 0 AND tender_amt % 0.01 <> 0""")
_view("ev_filed_hits", ["ev_head"], f"""
    SELECT event_id, {HIT_COLUMNS}, 'PARTITION_MISMATCH' AS error_code, CAST(NULL AS BIGINT) AS key_value_1, CAST(NULL AS BIGINT) AS key_value_2,
      CAST(NULL AS VARCHAR) AS orig_value, CAST(NULL AS VARCHAR) AS orig_cc_no, CAST(NULL AS VARCHAR) AS section
    FROM ev_head WHERE store = 29""")
# every rule: 6 published faults and 21 invariants
_ALL = ["ev_hits", "ev_set_hits", "ev_raw_hits", "ev_filed_hits"]
_view("ev_all_hits", _ALL, " UNION ALL ".join(f"SELECT * FROM {v}" for v in _ALL))

# -- orders and line items ----------------------------------------------------
_view("o_head", [], """
    SELECT o_orderkey AS tran_no, o_custkey % 30 + 1 AS store,
      'TILL' || lpad(CAST(o_custkey // 30 % 4 + 1 AS VARCHAR), 2, '0') AS register,
      CAST(o_orderdate AS DATE) AS business_date,
      CASE o_orderstatus WHEN 'F' THEN 'SALE' WHEN 'O' THEN 'RETURN' ELSE 'PVOID' END AS tran_type,
      CAST(o_totalprice AS DECIMAL(20,4)) AS value,
      CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'POS' WHEN o_orderpriority[1] = '3' THEN 'OMS' ELSE 'MKT' END AS rtlog_orig_sys,
      o_custkey
    FROM orders""")
_view("o_item", [], """
    SELECT l_orderkey AS tran_no, CAST(l_linenumber AS BIGINT) AS item_seq_no, l_partkey, CAST(l_partkey AS VARCHAR) AS item,
      CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS DECIMAL(12,4)) AS qty,
      CAST(l_extendedprice AS DECIMAL(20,4)) AS unit_retail,
      CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'CUST' END AS return_reason_code
    FROM lineitem""")
_view("o_disc", [], """
    SELECT l_orderkey AS tran_no, CAST(l_linenumber AS BIGINT) AS item_seq_no, 500001 + l_suppkey % 5 AS promotion,
      CAST(l_quantity AS DECIMAL(12,4)) AS qty,
      CAST(CAST(l_extendedprice AS DECIMAL(20,4)) * CAST(l_discount AS DECIMAL(4,4)) AS DECIMAL(20,4)) AS unit_discount_amt
    FROM lineitem WHERE l_discount > 0""")
_view("o_tax", [], """
    SELECT l_orderkey AS tran_no, CAST(l_linenumber AS BIGINT) AS tax_seq_no,
      CAST(CAST(l_quantity AS DECIMAL(12,4)) * CAST(l_tax AS DECIMAL(4,4)) * CAST(l_extendedprice AS DECIMAL(20,4)) AS DECIMAL(20,4)) AS tax_amt
    FROM lineitem WHERE l_tax > 0""")
_view("o_tender", [], """
    SELECT l_orderkey AS tran_no, CAST(l_linenumber AS BIGINT) AS tender_seq_no, l_suppkey % 4 + 1 AS tender_type_id,
      CASE l_suppkey % 4 + 1 WHEN 1 THEN 'CASH' WHEN 3 THEN 'VOUCHER' ELSE 'CARD' END AS tender_type_group,
      CAST(l_extendedprice AS DECIMAL(20,4)) AS tender_amt,
      CASE WHEN l_suppkey % 4 + 1 IN (2, 4) THEN
        CASE WHEN l_returnflag = 'R' THEN '4' || lpad(CAST(l_partkey AS VARCHAR), 15, '0')
             ELSE '************' || lpad(CAST(l_partkey % 10000 AS VARCHAR), 4, '0') END END AS cc_no,
      CAST(l_extendedprice AS DECIMAL(20,4)) AS orig_curr_amt, CAST(l_shipdate AS DATE) AS business_date,
      (['AED', 'USD', 'INR', 'GBP', 'SGD'])[l_suppkey % 5 + 1] AS orig_currency
    FROM lineitem""")
_view("o_igtax", ["o_item"], """
    SELECT tran_no, item_seq_no, row_number() OVER (PARTITION BY tran_no ORDER BY item_seq_no, unit_retail, qty, a) AS igtax_seq_no,
      CASE a WHEN 1 THEN 'CGST' ELSE 'SGST' END AS tax_authority,
      CAST(qty * CAST(0.09 AS DECIMAL(4,4)) * unit_retail AS DECIMAL(20,4)) AS total_igtax_amt
    FROM o_item, generate_series(1, 2) g(a)""")
_view("stores", [], """
    SELECT CAST(n_nationkey + 1 AS BIGINT) AS store_no, n_name AS store_name, 10 + n_regionkey * 5 AS tills,
      r_name AS country, (['AED', 'USD', 'INR', 'GBP', 'SGD'])[n_regionkey + 1] AS local_currency,
      CAST(([3.67, 1.00, 84.50, 0.79, 1.35])[n_regionkey + 1] AS DECIMAL(10,4)) AS exchange_rate_to_usd
    FROM nation JOIN region ON n_regionkey = r_regionkey""")
_view("products", [], """
    SELECT CAST(p_partkey AS VARCHAR) AS sku, CAST(substring(p_brand, 7) AS BIGINT) AS dept, CAST(p_size AS BIGINT) AS class,
      CAST(p_retailprice AS DECIMAL(20,4)) AS base_price
    FROM part""")
_view("promos", [], """
    SELECT * FROM (VALUES (500001, CAST(0.10 AS DECIMAL(4,4))), (500002, CAST(0.15 AS DECIMAL(4,4))),
      (500003, CAST(0.05 AS DECIMAL(4,4))), (500004, CAST(0.20 AS DECIMAL(4,4)))) t(promo_id, disc_pct)""")
_view("rates", [], """
    SELECT (['AED', 'USD', 'INR', 'GBP', 'SGD'])[o_custkey % 5 + 1] AS currency, CAST(o_orderdate AS DATE) AS rate_date,
      CAST(min(CAST(o_totalprice AS DECIMAL(12,2))) * CAST(0.0001 AS DECIMAL(4,4)) AS DECIMAL(12,6)) AS rate
    FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2""")


def with_views(needs: list[str], body: str) -> str:
    """``WITH`` clause of the views and what they read, in order, then the body."""
    order: list[str] = []

    def add(name: str) -> None:
        for n in VIEWS[name][0]:
            add(n)
        if name not in order:
            order.append(name)

    for n in needs:
        add(n)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in order)
    return f"WITH {ctes}\n{body}" if order else body
