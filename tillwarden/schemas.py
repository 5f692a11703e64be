"""Fixed schemas: the nested till-log record and the canonical tables.

Schemas are never inferred.  Canonical types follow one mapping:
NUMERIC(p) -> BIGINT, NUMERIC(p,s) -> DECIMAL(p,s), VARCHAR(n) -> STRING,
Date -> TIMESTAMP (the business date is a DATE).
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# The nested till-log record (field names, order and types).
# --------------------------------------------------------------------------
HEAD_DDL = """
store BIGINT, business_date DATE, tran_seq_no STRING, tran_datetime STRING,
register STRING, tran_no BIGINT, cashier STRING, salesperson STRING,
tran_type STRING, status STRING, value DECIMAL(20,4), pos_tran_ind STRING,
error_ind STRING, banner_no BIGINT, rtlog_orig_sys STRING,
update_datetime STRING, update_id STRING, rev_no BIGINT, sub_tran_type STRING,
reason_code STRING, orig_tran_no BIGINT, orig_tran_type STRING,
orig_reg_no STRING, vendor_no STRING, vendor_invc_no STRING,
rounded_amt DECIMAL(20,4), rounded_off_amt DECIMAL(20,4), ref_no1 STRING,
ref_no2 STRING
"""

ITEM_DDL = """
item_seq_no BIGINT, item_status STRING, item_type STRING, item STRING,
dept BIGINT, class BIGINT, subclass BIGINT, qty DECIMAL(12,4),
unit_retail DECIMAL(20,4), selling_uom STRING, tax_ind STRING,
item_swiped_ind STRING, error_ind STRING, drop_ship_ind STRING,
unit_retail_vat_incl STRING, total_igtax_amt DECIMAL(20,4),
uom_quantity DECIMAL(12,4), return_reason_code STRING,
override_reason STRING, orig_unit_retail DECIMAL(20,4), cust_order_no STRING
"""

DISC_DDL = """
item_seq_no BIGINT, discount_seq_no BIGINT, rms_promo_type STRING,
promotion BIGINT, disc_type STRING, qty DECIMAL(12,4),
unit_discount_amt DECIMAL(20,4), error_ind STRING,
uom_quantity DECIMAL(12,4), coupon_no STRING, promo_comp BIGINT
"""

TENDER_DDL = """
tender_seq_no BIGINT, tender_type_group STRING, tender_type_id BIGINT,
tender_amt DECIMAL(20,4), error_ind STRING, cc_no STRING, cc_auth_no STRING,
cc_entry_mode STRING, orig_currency STRING, orig_curr_amt DECIMAL(20,4),
voucher_no STRING
"""

TAX_DDL = "tax_code STRING, tax_seq_no BIGINT, tax_amt DECIMAL(20,4), error_ind STRING"

# Rates are shares below one, so four decimals and no integer digits; this
# keeps price * quantity * rate inside 38 digits without loss.
IGTAX_DDL = """
item_seq_no BIGINT, igtax_seq_no BIGINT, tax_authority STRING,
igtax_code STRING, igtax_rate DECIMAL(4,4), total_igtax_amt DECIMAL(20,4),
error_ind STRING
"""

# child array -> (DDL of one element, columns that number its rows)
CHILDREN = {
    "tran_item": (ITEM_DDL, ["item_seq_no"]),
    "tran_disc": (DISC_DDL, ["item_seq_no", "discount_seq_no"]),
    "tran_tender": (TENDER_DDL, ["tender_seq_no"]),
    "tran_tax": (TAX_DDL, ["tax_seq_no"]),
    "tran_igtax": (IGTAX_DDL, ["item_seq_no", "igtax_seq_no"]),
}

RECORD_KEYS = ["rtlog_orig_sys", "tran_head", *CHILDREN]


def struct_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def rtlog_schema() -> T.StructType:
    """The nested record as it stands on one line of a till log."""
    schema = T.StructType().add("rtlog_orig_sys", T.StringType())
    schema = schema.add("tran_head", struct_of(HEAD_DDL))
    for name, (ddl, _) in CHILDREN.items():
        schema = schema.add(name, T.ArrayType(struct_of(ddl)))
    return schema


# --------------------------------------------------------------------------
# Canonical tables.  One column per entry, in table order:
#   name type[!][*]    "!" = part of the primary key, "*" = mandatory
# N(p), N(p,s), V(n), TS and DT stand for the types above; "ref_no5..8" is a
# run of columns.
# --------------------------------------------------------------------------
_TABLES = {
    "sa_store_day": """
        store_day_seq_no N(20)!*, business_date DT*, store N(10)*, day N(3)*,
        inv_bus_date_ind V(1)*, inv_store_ind V(1)*, store_status V(6)*,
        store_closed_datetime TS, data_status V(6)*, audit_status V(6)*,
        audit_changed_datetime TS, files_loaded N(10), oms_files_loaded N(10)
    """,
    "sa_tran_head": """
        store N(10)!*, day N(3)!*, tran_seq_no N(20)!*, rev_no N(3)*,
        store_day_seq_no N(20)*, tran_datetime TS*, register V(5), tran_no N(10),
        cashier V(10), salesperson V(10), tran_type V(6)*, sub_tran_type V(6),
        orig_tran_no N(10), orig_tran_type V(6), orig_reg_no V(5),
        ref_no1..4 V(30), reason_code V(6), vendor_no V(10),
        vendor_invc_no V(30), payment_ref_no V(16), proof_of_delivery_no V(30),
        status V(6)*, value N(20,4), pos_tran_ind V(1)*, update_datetime TS*,
        update_id V(30)*, error_ind V(1)*, banner_no N(4), rounded_amt N(20,4),
        rounded_off_amt N(20,4), credit_promotion_id N(10), ref_no25..27 V(30),
        rtlog_orig_sys V(3)*, tran_process_sys V(3)
    """,
    "sa_tran_item": """
        store N(10)!*, day N(3)!*, tran_seq_no N(20)!*, item_seq_no N(4)!*,
        item_status V(6)*, item_type V(6)*, item V(25), ref_item V(25),
        non_merch_item V(25), voucher_no V(25), dept N(4), class N(4),
        subclass N(4), qty N(12,4), unit_retail N(20,4), selling_uom V(4),
        override_reason V(6), orig_unit_retail N(20,4),
        standard_orig_unit_retail N(20,4), tax_ind V(1)*, item_swiped_ind V(1)*,
        error_ind V(1)*, drop_ship_ind V(1)*, waste_type V(6),
        waste_pct N(12,4), pump V(8), return_reason_code V(6),
        salesperson V(10), expiration_date TS, standard_qty N(12,4),
        standard_unit_retail N(20,4), standard_uom V(4), ref_no5..8 V(30),
        uom_quantity N(12,4)*, catchweight_ind V(1), selling_item V(25),
        customer_order_line_no N(6), media_id N(10), unit_retail_vat_incl V(1)*,
        total_igtax_amt N(20,4), unique_id V(128), cust_order_no V(48),
        cust_order_date TS, fulfill_order_no V(48), no_inv_ret_ind V(1),
        return_wh N(10), sales_type V(1), return_disposition V(10)
    """,
    "sa_tran_disc": """
        store N(10)!*, day N(3)!*, tran_seq_no N(20)!*, item_seq_no N(4)!*,
        discount_seq_no N(4)!*, rms_promo_type V(6)!*, promotion N(10),
        disc_type V(6), coupon_no V(40), coupon_ref_no V(16), qty N(12,4),
        unit_discount_amt N(20,4), standard_qty N(12,4),
        standard_unit_disc_amt N(20,4), ref_no13..16 V(30), error_ind V(1)*,
        uom_quantity N(12,4)*, catchweight_ind V(1), promo_comp N(10)
    """,
    "sa_tran_tender": """
        store N(10)!*, day N(3)!*, tran_seq_no N(20)!*, tender_seq_no N(4)!*,
        tender_type_group V(6)*, tender_type_id N(6)*, tender_amt N(20,4)*,
        cc_no V(40), cc_exp_date TS, cc_auth_no V(16), cc_auth_src V(6),
        cc_entry_mode V(6), cc_cardholder_verf V(6), cc_term_id V(5),
        cc_spec_cond V(6), voucher_no V(25), coupon_no V(40),
        coupon_ref_no V(16), ref_no9..12 V(30), error_ind V(1)*,
        check_acct_no V(30), check_no N(10), identi_method V(6),
        identi_id V(40), orig_currency V(3), orig_curr_amt N(20,4)
    """,
    "sa_tran_tax": """
        store N(10)!*, day N(3)!*, tran_seq_no N(20)!*, tax_code V(6)*,
        tax_seq_no N(4)!*, tax_amt N(20,4)*, error_ind V(1)*, ref_no17..20 V(30)
    """,
    "sa_tran_igtax": """
        store N(10)!*, day N(3)!*, tran_seq_no N(20)!*, item_seq_no N(4)!*,
        igtax_seq_no N(4)!*, tax_authority V(10)*, igtax_code V(6)*,
        igtax_rate N(20,4), total_igtax_amt N(20,4)*, standard_qty N(12,4),
        standard_unit_igtax_amt N(20,4), error_ind V(1)*, ref_no21..24 V(30)
    """,
    "sa_missing_tran": """
        miss_tran_seq_no N(20)!*, store_day_seq_no N(20)*, register V(5),
        tran_no N(10)*, status V(6)*, rtlog_orig_sys V(3)*
    """,
    # exactly one of the three *_seq_no references is set, so all are nullable
    "sa_error": """
        store N(10)!*, day N(3)!*, error_seq_no N(20)!*, store_day_seq_no N(20)*,
        bal_group_seq_no N(20), total_seq_no N(20), tran_seq_no N(20),
        error_code V(25)*, key_value_1 N(4), key_value_2 N(4), rec_type V(6)*,
        store_override_ind V(1)*, hq_override_ind V(1)*, update_id V(30)*,
        update_datetime TS*, orig_value V(70), orig_cc_no V(40)
    """,
    "sa_error_codes": """
        error_code V(25)!*, error_desc V(255)*, target_form V(6), target_tab V(6),
        rec_solution V(255), store_override_ind V(1)*, hq_override_ind V(1)*,
        required_ind V(1)*, short_desc V(40)*, mass_res_pop_up_type V(20),
        error_fix_table V(30), error_fix_column V(30)
    """,
    "sa_total_head": """
        total_id V(10)!*, total_rev_no N(3)!*, vr_id V(15), vr_rev_no N(3),
        total_desc V(255)*, total_type V(1)*, os_group V(1), os_operator V(1),
        comb_total_ind V(1)*, total_cat V(6)*, bal_level V(1)*,
        update_datetime TS*, update_id V(30)*, count_sum_ind V(1)*, pos_ind V(1)*,
        sys_calc_ind V(1)*, store_update_ind V(1)*, hq_update_ind V(1)*,
        req_ind V(1)*, wiz_ind V(1)*, start_business_date TS*,
        end_business_date TS, group_seq_no1 N(3), ref_label_code_1 V(6),
        group_seq_no2 N(3), ref_label_code_2 V(6), group_seq_no3 N(3),
        ref_label_code_3 V(6), total_parm_seq_no N(3)*, display_order V(6)*,
        status V(6)
    """,
}
# the revision table is the header table with the revision in its key
_TABLES["sa_tran_head_rev"] = _TABLES["sa_tran_head"].replace("rev_no N(3)*", "rev_no N(3)!*")

# by date: the day of the year alone would file two years together
PARTITION_COLUMNS = ["store", "business_date"]

# nested child array -> canonical table
CHILD_TABLES = {child: f"sa_{child}" for child in CHILDREN}


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    spark_type: str
    mandatory: bool
    primary_key: bool
    width: int | None  # declared length of a text column


_ENTRY = re.compile(r"(\w+?)(\d+)?(?:\.\.(\d+))?\s+(N|V|TS|DT)(?:\((\d+)(?:,(\d+))?\))?(!?)(\*?)$")


def _expand(entry: str) -> list[ColumnSpec]:
    stem, first, last, kind, size, scale, pk, mandatory = _ENTRY.match(entry).groups()
    if last:
        names = [f"{stem}{n}" for n in range(int(first), int(last) + 1)]
    else:
        names = [stem + (first or "")]
    if kind == "N":
        spark_type = f"decimal({size},{scale})" if scale else "bigint"
    else:
        spark_type = {"V": "string", "TS": "timestamp", "DT": "date"}[kind]
    width = int(size) if kind == "V" else None
    return [ColumnSpec(n, spark_type, bool(mandatory), bool(pk), width) for n in names]


@lru_cache(maxsize=None)
def table_columns(table: str) -> tuple[ColumnSpec, ...]:
    entries = re.split(r",(?![^(]*\))", " ".join(_TABLES[table].split()))
    return tuple(spec for entry in entries for spec in _expand(entry.strip()))


def table_names() -> list[str]:
    return list(_TABLES)


def primary_key(table: str) -> list[str]:
    return [c.name for c in table_columns(table) if c.primary_key]


def mandatory_columns(table: str) -> list[str]:
    return [c.name for c in table_columns(table) if c.mandatory]


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{c.name}` {c.spark_type}" for c in table_columns(table)))
