"""Code lists, small dimensions, error codes and totals.

Everything in this file must equal the published business values for results
to be right.  All tables here have a fixed, small number of rows, so they may
always be broadcast.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# code type -> codes
CODE_LISTS = {
    "TRAT": ["SALE", "RETURN", "PVOID", "PAIDIN", "PAIDOUT", "NOSALE", "OPEN", "CLOSE"],
    "TRAS": [],
    "SASS": ["OPEN", "CLOSED"],
    "SAAS": ["UNAUDITED", "INPROGRESS", "AUDITED", "POSTED"],
    "SASI": ["ACTIVE", "VOIDED", "REFUNDED"],
    "SART": ["SART", "SABG", "SATT"],
}

CHANNELS = ["POS", "OMS", "MKT"]

# header workflow, in order of progress
HEAD_STATUSES = ["IMPORTED", "VALIDATED", "ERRORED", "APPROVED", "POSTED"]

# the numbers the till uses for its own opening and closing records
OPEN_TRAN_NO = 9000
CLOSE_TRAN_NO = 9999

DEFAULT_TILLS = 4
DEFAULT_CURRENCY = "INR"
DEFAULT_BANNER = 1
TENDER_TOLERANCE = "0.01"
OPENING_HOUR = 6
CLOSING_HOUR = 23
PRICE_BAND = 50

# expected share of each transaction type, per cent
TYPE_MIX = [("SALE", 85), ("RETURN", 7), ("PVOID", 3), ("PAIDIN", 1), ("PAIDOUT", 1), ("NOSALE", 2)]

# department, class, subclass, SKU prefix, description
PRODUCT_LINES = [
    (10, 1, 1, "APP-M-", "Mens Shirt"),
    (10, 1, 2, "APP-T-", "Mens Trousers"),
    (10, 2, 1, "APP-W-", "Womens Kurta"),
    (10, 2, 2, "APP-S-", "Womens Saree"),
    (10, 3, 1, "APP-K-", "Kids T-Shirt"),
    (20, 1, 1, "FTW-C-", "Casual Shoes"),
    (20, 1, 2, "FTW-F-", "Formal Shoes"),
    (20, 2, 1, "FTW-S-", "Sandals"),
    (30, 1, 1, "ELE-P-", "Phone Accessory"),
    (30, 1, 2, "ELE-C-", "Charger"),
    (30, 2, 1, "ELE-H-", "Headphones"),
    (40, 1, 1, "HOM-K-", "Kitchenware"),
    (40, 2, 1, "HOM-D-", "Decor"),
    (50, 1, 1, "BPC-S-", "Skincare"),
    (50, 1, 2, "BPC-H-", "Haircare"),
]
DEPT_BASE_PRICE = {10: 799, 20: 1299, 30: 999, 40: 499, 50: 349}
SKUS_PER_LINE = 5
SKU_PRICE_STEP = 200

# id, group, expected share per cent
TENDER_TYPES = [(1, "CASH", 30), (2, "CARD", 50), (3, "VOUCHER", 10), (4, "CARD", 10)]

# promotion, discount share, promotion type
PROMOTIONS = [
    (500001, "0.10", "PROMO"),
    (500002, "0.15", "PROMO"),
    (500003, "0.05", "PROMO"),
    (500004, "0.20", "PROMO"),
]

# authority, code, rate: tax contained in the price
IGTAX_AUTHORITIES = [("CGST", "GST9", "0.09"), ("SGST", "GST9", "0.09")]

# code, rate: tax added to the price
ADDITIVE_TAX = ("GSTTOT", "0.18")

# Monday..Sunday
DAY_FACTORS = ["1.0", "1.0", "1.0", "1.0", "1.2", "1.8", "1.6"]
BLACK_FRIDAY_FACTOR = "4.0"

# hour 00..23
HOUR_WEIGHTS = [
    "0.0", "0.0", "0.0", "0.0", "0.0", "0.0",
    "0.2", "0.5", "1.0", "1.5", "2.0", "2.5",
    "3.0", "2.5", "2.0", "2.0", "2.5", "3.0",
    "3.5", "3.0", "2.0", "1.5", "1.0", "0.5",
]

# error code, short text, blocks posting, store may override, head office may override
ERROR_CODES = [
    ("MISSING_TENDER", "Transaction has a value but no tender", "Y", "N", "Y"),
    ("TENDER_VAR_GT_01", "Tender total differs from the value", "Y", "N", "Y"),
    ("TRAN_NO_DUP", "Transaction number used more than once", "Y", "N", "Y"),
    ("VOID_OOH", "Post-void outside opening hours", "N", "N", "Y"),
    ("NEG_QTY_NO_REF", "Negative quantity on a sale, no reason", "Y", "Y", "Y"),
    ("CC_NOT_MASKED", "Card number is not masked", "Y", "N", "N"),
    ("CHANNEL_INVALID", "Channel unknown or inconsistent", "Y", "N", "Y"),
    ("PARTITION_MISMATCH", "Record filed in the wrong folder", "N", "N", "Y"),
    ("TRAN_SEQ_DUP", "Transaction id used more than once", "Y", "N", "Y"),
    ("CODE_INVALID", "Value is not in its code list", "Y", "N", "Y"),
    ("IND_INVALID", "Flag is neither Y nor N", "Y", "N", "Y"),
    ("SALE_NO_ITEM", "Sale without items", "Y", "Y", "Y"),
    ("ITEM_SEQ_GAP", "Item numbers are not 1..n in order", "N", "N", "Y"),
    ("RETAIL_NOT_POSITIVE", "Unit retail is not positive", "Y", "Y", "Y"),
    ("SCALE_GT_4", "Money with more than four decimals", "N", "N", "Y"),
    ("POS_DROP_SHIP", "Till item marked as drop shipment", "N", "Y", "Y"),
    ("TAX_MODE_MIX", "Both kinds of tax in one record", "N", "N", "Y"),
    ("VALUE_MISMATCH", "Value differs from items less discounts", "Y", "N", "Y"),
    ("IGTAX_ROLLUP", "Item tax differs from its tax lines", "N", "N", "Y"),
    ("DISC_RECALC", "Discount differs from price and promotion", "N", "Y", "Y"),
    ("PAIDIO_SHAPE", "Paid in/out record has the wrong shape", "N", "N", "Y"),
    ("SEQ_FORMAT", "Transaction id does not match the header", "N", "N", "Y"),
    ("BANNER_INVALID", "Unknown banner", "N", "N", "Y"),
    ("KEYS_MISSING", "Required keys are absent", "Y", "N", "N"),
    ("REF_INTEGRITY", "Child row without a header", "Y", "N", "N"),
    ("REF_DATA_INVALID", "Unknown SKU, promotion or tender type", "Y", "N", "Y"),
    ("CURR_AMT_MISMATCH", "Currency amount differs from the tender", "N", "N", "Y"),
]

# total, text, C = count / S = sum
TOTALS = [
    ("TNDCASH", "Cash tendered", "S"),
    ("TNDCARD", "Card tendered", "S"),
    ("TAXTOTAL", "Tax", "S"),
    ("DISCTOTAL", "Discounts", "S"),
    ("TRANCOUNT", "Transactions", "C"),
]


def _seed(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A fixed table as a local relation: its size is known to Catalyst, which broadcasts it."""
    names = [field.split()[0] for field in ddl.split(",")]
    columns = [list(c) for c in zip(*rows, strict=True)]
    df = spark.createDataFrame(pa.table(dict(zip(names, columns, strict=True))))
    return df.selectExpr(*[f"cast({f.split()[0]} as {f.split()[1]}) as {f.split()[0]}" for f in ddl.split(",")])


def code_detail(spark: SparkSession) -> DataFrame:
    rows = [(kind, code) for kind, codes in CODE_LISTS.items() for code in codes]
    return _seed(spark, rows, "code_type string, code string")


def products(spark: SparkSession) -> DataFrame:
    """SKUs: every product line has five, each step 200 dearer than the last."""
    rows = [
        (f"{prefix}{n:04d}", dept, cls, sub, desc, DEPT_BASE_PRICE[dept] + (n - 1) * SKU_PRICE_STEP)
        for dept, cls, sub, prefix, desc in PRODUCT_LINES
        for n in range(1, SKUS_PER_LINE + 1)
    ]
    df = _seed(
        spark, rows, "sku string, dept long, class long, subclass long, description string, base long"
    )
    return df.selectExpr(
        "sku", "dept", "class", "subclass", "description", "cast(base as decimal(20,4)) as base_price"
    )


def tender_types(spark: SparkSession) -> DataFrame:
    return _seed(
        spark, TENDER_TYPES, "tender_type_id long, tender_type_group string, expected_pct int"
    )


def promotions(spark: SparkSession) -> DataFrame:
    df = _seed(spark, PROMOTIONS, "promotion long, pct string, rms_promo_type string")
    return df.selectExpr("promotion", "cast(pct as decimal(4,4)) as disc_pct", "rms_promo_type")


def tax_authorities(spark: SparkSession) -> DataFrame:
    rows = [(n, *row) for n, row in enumerate(IGTAX_AUTHORITIES, start=1)]
    df = _seed(
        spark, rows, "authority_no int, tax_authority string, igtax_code string, rate string"
    )
    return df.selectExpr(
        "authority_no", "tax_authority", "igtax_code", "cast(rate as decimal(4,4)) as igtax_rate"
    )


def hour_weights(spark: SparkSession) -> DataFrame:
    rows = list(enumerate(HOUR_WEIGHTS))
    df = _seed(spark, rows, "hour int, w string")
    return df.selectExpr("hour", "cast(w as decimal(4,1)) as weight")


def type_mix(spark: SparkSession) -> DataFrame:
    return _seed(spark, TYPE_MIX, "tran_type string, expected_pct int")


def error_codes(spark: SparkSession) -> DataFrame:
    """The error-code lookup in canonical column order."""
    from tillwarden.operators.conform import conform_types

    df = _seed(
        spark,
        ERROR_CODES,
        "error_code string, short_desc string, required_ind string, "
        "store_override_ind string, hq_override_ind string",
    )
    return conform_types(df.withColumn("error_desc", df.short_desc), "sa_error_codes")


def total_heads(spark: SparkSession) -> DataFrame:
    """Definitions of the calculated totals in canonical column order."""
    from tillwarden.operators.conform import conform_types

    df = _seed(spark, TOTALS, "total_id string, total_desc string, count_sum_ind string")
    df = df.selectExpr(
        "*", "1L as total_rev_no", "'S' as total_type", "'N' as comb_total_ind",
        "'TOTAL' as total_cat", "'S' as bal_level", "timestamp'2024-01-01 00:00:00' as update_datetime",
        "'SYSTEM' as update_id", "'N' as pos_ind", "'Y' as sys_calc_ind", "'N' as store_update_ind",
        "'Y' as hq_update_ind", "'N' as req_ind", "'N' as wiz_ind",
        "timestamp'2024-01-01 00:00:00' as start_business_date", "1L as total_parm_seq_no",
        "total_id as display_order",
    )
    return conform_types(df, "sa_total_head")
