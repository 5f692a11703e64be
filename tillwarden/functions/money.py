"""Money, quantities and taxes in exact decimals.

All amounts are DECIMAL(20,4) rounded half up; DOUBLE never takes part.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tillwarden import reference as ref

MONEY = "decimal(20,4)"
QTY = "decimal(12,4)"
RATE = "decimal(4,4)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(value) -> Column:
    """A money literal or cast."""
    if isinstance(value, Column):
        return value.cast(MONEY)
    return F.lit(Decimal(str(value))).cast(MONEY)


def round4(amount: Column | str) -> Column:
    """Half-up rounding to four decimals (half away from zero if negative)."""
    return _col(amount).cast(MONEY)


def line_amount(qty: Column | str = "qty", unit: Column | str = "unit_retail") -> Column:
    return _col(qty).cast(QTY) * _col(unit).cast(MONEY)


def disc_amount(qty: Column | str = "qty", unit: Column | str = "unit_discount_amt") -> Column:
    return line_amount(qty, unit)


def rate_amount(qty: Column | str, unit: Column | str, rate) -> Column:
    """``round4(unit * qty * rate)``, exact because the rate has no integer digits."""
    rate = rate.cast(RATE) if isinstance(rate, Column) else F.lit(Decimal(str(rate))).cast(RATE)
    # qty * rate first: DECIMAL(17,8), then * DECIMAL(20,4) fits 38 digits
    return round4(_col(qty).cast(QTY) * rate * _col(unit).cast(MONEY))


def additive_tax(qty: Column | str = "qty", unit: Column | str = "unit_retail") -> Column:
    return rate_amount(qty, unit, ref.ADDITIVE_TAX[1])


def promo_discount(unit: Column | str, pct: Column) -> Column:
    """Unit discount of a promotion: ``round4(unit_retail * pct)``."""
    return round4(_col(unit).cast(MONEY) * pct.cast(RATE))


def net_value(line_total: Column | str, disc_total: Column | str) -> Column:
    """Items less discounts, each rounded first, never below zero."""
    zero = money(0)
    lines = F.coalesce(round4(line_total), zero)
    discs = F.coalesce(round4(disc_total), zero)
    return F.greatest(round4(lines - discs), zero)


def array_total(array: Column | str, amount) -> Column:
    """Sum of ``amount(element)`` over an array, as DECIMAL(38,8); zero when empty."""
    start = F.lit(Decimal(0)).cast("decimal(38,8)")
    return F.aggregate(
        _col(array),
        start,
        lambda acc, x: (acc + F.coalesce(amount(x), F.lit(Decimal(0)))).cast("decimal(38,8)"),
    )


def to_usd(amount: Column | str, local_per_usd: Column | str) -> Column:
    """Local amount to US dollars; rates are quoted as local units per dollar."""
    return round4(_col(amount).cast(MONEY) / _col(local_per_usd))
