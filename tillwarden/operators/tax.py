"""Taxes and promotional discounts, recomputed from prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillwarden import reference as ref
from tillwarden.functions import money as M
from tillwarden.operators.joins import items_by_authority, lookup_promo
from tillwarden.operators.spread import with_row_number

TAX_MODES = ("IGTAX", "TAX", "BOTH")


def _numbered(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Running numbers in a transaction, by ranges of item numbers so that a long one is spread.

    Lines of one item number follow their price and quantity.
    """
    bucket = F.floor(F.coalesce("item_seq_no", F.lit(0)) / 4096)
    return with_row_number(rows, keys, [F.coalesce(c, F.lit(0)) for c in order], bucket)


def igtax_lines(items: DataFrame, keys: list[str], authorities: list[tuple] | None = None) -> DataFrame:
    """One row per item and authority, numbered through the whole transaction.

    Numbers are counted, not derived from item numbers, which may repeat or leave gaps.
    """
    rows = _numbered(items_by_authority(items, authorities), keys, ["item_seq_no", "unit_retail", "qty", "authority_no"])
    return rows.select(
        *keys,
        "item_seq_no",
        F.col("row_no").alias("igtax_seq_no"),
        "tax_authority",
        "igtax_code",
        "igtax_rate",
        M.rate_amount("qty", "unit_retail", F.col("igtax_rate")).alias("total_igtax_amt"),
        F.lit("N").alias("error_ind"),
    )


def additive_tax_lines(items: DataFrame, keys: list[str]) -> DataFrame:
    """One row per item, numbered through the whole transaction."""
    return _numbered(items, keys, ["item_seq_no", "unit_retail", "qty"]).select(
        *keys,
        F.lit(ref.ADDITIVE_TAX[0]).alias("tax_code"),
        F.col("row_no").alias("tax_seq_no"),
        M.additive_tax().alias("tax_amt"),
        F.lit("N").alias("error_ind"),
    )


def item_igtax_amount(authorities: list[tuple] | None = None) -> Column:
    """Tax contained in an item: sum of its authority lines, NULL when zero."""
    rows = authorities if authorities is not None else ref.IGTAX_AUTHORITIES
    total = M.money(0)
    for _, _, rate in rows:
        total = M.round4(total + M.rate_amount("qty", "unit_retail", rate))
    return F.nullif(total, M.money(0))


def item_igtax_total(igtax: DataFrame, keys: list[str]) -> DataFrame:
    """The same total from stored tax lines, one row per item."""
    return igtax.groupBy(*keys, "item_seq_no").agg(
        F.nullif(M.round4(F.sum("total_igtax_amt")), M.money(0)).alias("total_igtax_amt")
    )


def apply_tax_mode(
    items: DataFrame, keys: list[str], mode: str = "IGTAX"
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Items with the price flag set, tax lines and contained-tax lines of a mode."""
    if mode not in TAX_MODES:
        raise ValueError(f"tax mode must be one of {TAX_MODES}")
    contained = mode in ("IGTAX", "BOTH")
    flagged = items.withColumns(
        {
            "unit_retail_vat_incl": F.lit("Y" if contained else "N"),
            "total_igtax_amt": item_igtax_amount() if contained else F.lit(None).cast(M.MONEY),
        }
    )
    tax = additive_tax_lines(items, keys) if mode in ("TAX", "BOTH") else None
    igtax = igtax_lines(items, keys) if contained else None
    return flagged, tax, igtax


def promo_discounts(sale_items: DataFrame, promotions: DataFrame) -> DataFrame:
    """Unit discount of items that carry a promotion id (sales only)."""
    rows = lookup_promo(sale_items.filter(F.col("tran_type") == "SALE"), promotions)
    return rows.filter(F.col("disc_pct").isNotNull()).withColumns(
        {
            "disc_type": F.lit("PROMO"),
            "unit_discount_amt": M.promo_discount("unit_retail", F.col("disc_pct")),
        }
    )


def igtax_rollup_errors(items: DataFrame, igtax: DataFrame, keys: list[str]) -> DataFrame:
    """Items whose stored total differs from their tax lines.

    Tax lines are summed per item before they meet the items, so the join is
    one row to one row.
    """
    sums = item_igtax_total(igtax, keys).withColumnRenamed("total_igtax_amt", "lines_amt")
    joined = items.join(sums, [*keys, "item_seq_no"], "left")
    zero = M.money(0)
    return joined.filter(
        F.coalesce("total_igtax_amt", zero) != F.coalesce("lines_amt", zero)
    )


def igtax_line_errors(igtax: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """Tax lines that differ from price, quantity and rate of their item."""
    priced = items.select(*keys, "item_seq_no", "qty", "unit_retail")
    return (
        igtax.join(priced, [*keys, "item_seq_no"])
        .withColumn("expected_amt", M.rate_amount("qty", "unit_retail", F.col("igtax_rate")))
        .filter(F.col("expected_amt") != F.col("total_igtax_amt"))
    )


def discount_errors(
    disc: DataFrame, items: DataFrame, promotions: DataFrame, keys: list[str]
) -> DataFrame:
    """Discounts on other types than sales, or different from price times share."""
    priced = items.select(*keys, "item_seq_no", "unit_retail", "tran_type")
    return wrong_discounts(disc.join(priced, [*keys, "item_seq_no"]), promotions)


def wrong_discounts(priced: DataFrame, promotions: DataFrame) -> DataFrame:
    """The same for discounts that have the price of their item and the type of their transaction."""
    joined = lookup_promo(priced, promotions)
    expected = M.promo_discount("unit_retail", F.col("disc_pct"))
    return joined.withColumn("expected_amt", expected).filter(
        (F.col("tran_type") != "SALE")
        | F.col("disc_pct").isNull()
        | (F.col("expected_amt") != F.col("unit_discount_amt"))
    )
