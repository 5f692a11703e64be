"""Small till-log records built by hand."""

from __future__ import annotations

import copy
import json

HEAD = {
    "store": 1, "business_date": "2024-03-15", "tran_seq_no": "STR001-TILL01-2024-03-15-000001",
    "tran_datetime": "2024-03-15T12:30:05+05:30", "register": "TILL01", "tran_no": 1,
    "cashier": "CASH1001", "salesperson": "SP0001", "tran_type": "SALE", "status": "IMPORTED",
    "value": 1598.0, "pos_tran_ind": "Y", "error_ind": "N", "banner_no": 1, "rtlog_orig_sys": "POS",
    "update_datetime": "2024-03-15T12:30:05+05:30", "update_id": "TILL", "rev_no": 0,
    "sub_tran_type": None, "reason_code": None, "orig_tran_no": None, "orig_tran_type": None,
    "orig_reg_no": None, "vendor_no": None, "vendor_invc_no": None, "rounded_amt": None,
    "rounded_off_amt": None, "ref_no1": None, "ref_no2": None,
}
ITEM = {
    "item_seq_no": 1, "item_status": "ACTIVE", "item_type": "ITM", "item": "APP-M-0001", "dept": 10,
    "class": 1, "subclass": 1, "qty": 2.0, "unit_retail": 799.0, "selling_uom": "EA", "tax_ind": "Y",
    "item_swiped_ind": "N", "error_ind": "N", "drop_ship_ind": "N", "unit_retail_vat_incl": "Y",
    "total_igtax_amt": 287.64, "uom_quantity": 2.0, "return_reason_code": None,
    "override_reason": None, "orig_unit_retail": None, "cust_order_no": None,
}
TENDER = {
    "tender_seq_no": 1, "tender_type_group": "CARD", "tender_type_id": 2, "tender_amt": 1598.0,
    "error_ind": "N", "cc_no": "************1234", "cc_auth_no": "A12345", "cc_entry_mode": "CHIP",
    "orig_currency": "INR", "orig_curr_amt": 1598.0, "voucher_no": None,
}
IGTAX = [
    {"item_seq_no": 1, "igtax_seq_no": 1, "tax_authority": "CGST", "igtax_code": "GST9",
     "igtax_rate": 0.09, "total_igtax_amt": 143.82, "error_ind": "N"},
    {"item_seq_no": 1, "igtax_seq_no": 2, "tax_authority": "SGST", "igtax_code": "GST9",
     "igtax_rate": 0.09, "total_igtax_amt": 143.82, "error_ind": "N"},
]


def record(tran_no: int = 1, **head) -> dict:
    """A clean sale; keyword arguments replace header fields."""
    h = dict(HEAD, tran_no=tran_no) | head
    if "tran_seq_no" not in head:
        h["tran_seq_no"] = f"STR{h['store']:03d}-{h['register']}-{h['business_date']}-{tran_no:06d}"
    return copy.deepcopy(
        {
            "rtlog_orig_sys": h["rtlog_orig_sys"], "tran_head": h, "tran_item": [ITEM], "tran_disc": [],
            "tran_tender": [TENDER], "tran_tax": [], "tran_igtax": IGTAX,
        }
    )


def bare(tran_no: int, tran_type: str, **head) -> dict:
    """A record without children (opening, closing, no-sale)."""
    r = record(tran_no, tran_type=tran_type, value=0.0, **head)
    for child in ("tran_item", "tran_disc", "tran_tender", "tran_tax", "tran_igtax"):
        r[child] = []
    return r


def land(records: list, root, lines_per_file: int | None = None) -> str:
    """Write records into store/date/hour folders as JSON lines; returns the folder."""
    folders: dict = {}
    for r in records:
        h = r["tran_head"]
        key = f"store={h['store']}/date={h['business_date']}/hour={h['tran_datetime'][11:13]}"
        folders.setdefault(key, []).append(json.dumps(r))
    for key, lines in folders.items():
        d = root / key
        d.mkdir(parents=True, exist_ok=True)
        n = lines_per_file or len(lines)
        for i in range(0, len(lines), n):
            (d / f"part{i}.json").write_text("\n".join(lines[i : i + n]) + "\n", encoding="utf-8")
    return str(root)


def frame(spark, records: list):
    """Records as a nested frame, through the fixed schema."""
    from tillwarden.schemas import rtlog_schema

    lines = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    from pyspark.sql import functions as F

    return lines.select(F.from_json("value", rtlog_schema()).alias("r")).select("r.*")
