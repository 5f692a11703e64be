"""Reusable predicates.  Each is TRUE or FALSE, never NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillwarden import reference as ref


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_yn(flag: Column | str) -> Column:
    return F.coalesce(_col(flag).isin("Y", "N"), F.lit(False))


def in_code_list(value: Column | str, code_type: str) -> Column:
    return F.coalesce(_col(value).isin(ref.CODE_LISTS[code_type]), F.lit(False))


def in_channels(value: Column | str) -> Column:
    return F.coalesce(_col(value).isin(ref.CHANNELS), F.lit(False))


def is_masked(cc_no: Column | str) -> Column:
    """No number at all, or one that starts with the mask."""
    return F.coalesce(F.startswith(_col(cc_no), F.lit("*")), F.lit(True))


def mask_pan(cc_no: Column | str) -> Column:
    """Twelve stars and the last four digits; the only form that may be stored."""
    cc_no = _col(cc_no)
    return F.when(cc_no.isNotNull(), F.concat(F.repeat(F.lit("*"), 12), F.right(cc_no, F.lit(4))))


def has_4dp(number_text: Column | str) -> Column:
    """At most four decimals in the text of a number, trailing zeros aside; NULL text passes."""
    exact = _col(number_text).cast("string").try_cast("decimal(38,18)")
    return F.coalesce(exact == exact.cast("decimal(24,4)"), F.lit(True))
