"""Trading-calendar columns."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tillwarden import reference as ref


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_black_friday(day: Column | str) -> Column:
    """Last Friday of November."""
    day = _col(day)
    last_friday = F.date_sub(F.next_day(F.last_day(day), "FRI"), 7)
    return (F.month(day) == 11) & (day == last_friday)


def day_factor(day: Column | str) -> Column:
    """Expected volume of a day against a plain weekday."""
    day = _col(day)
    factors = F.array(*[F.lit(Decimal(x)).cast("decimal(4,1)") for x in ref.DAY_FACTORS])
    base = F.element_at(factors, F.weekday(day) + 1)  # weekday: 0 = Monday
    peak = F.lit(Decimal(ref.BLACK_FRIDAY_FACTOR)).cast("decimal(4,1)")
    one = F.lit(Decimal("1.0")).cast("decimal(4,1)")
    return (base * F.when(is_black_friday(day), peak).otherwise(one)).cast("decimal(6,2)")
