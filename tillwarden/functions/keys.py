"""Natural keys, surrogate keys and times."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tillwarden.schemas import RECORD_KEYS

SEQ_PATTERN = r"^STR(\d{3,})-(.+)-(\d{4}-\d{2}-\d{2})-(\d{6,})$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wall_hour_text(tran_datetime: Column | str) -> Column:
    """Two-digit hour on the till's clock.

    Taken from the text: converting to an instant and back would give the hour
    of the session's time zone, not of the till.
    """
    return F.lpad(F.substring(_col(tran_datetime), 12, 2), 2, "0")


def wall_hour(tran_datetime: Column | str) -> Column:
    return wall_hour_text(tran_datetime).cast("int")


def tran_instant(tran_datetime: Column | str) -> Column:
    """ISO text with offset to an instant; NULL when unreadable."""
    return F.try_to_timestamp(_col(tran_datetime))


def build_tran_seq_no(store, register, business_date, tran_no) -> Column:
    return F.format_string(
        "STR%03d-%s-%s-%06d",
        _col(store).cast("long"),
        _col(register),
        _col(business_date).cast("string"),  # a DATE would print as a day number
        _col(tran_no).cast("long"),
    )


def parse_tran_seq_no(seq: Column | str) -> Column:
    """Parts of the id as a struct; fields are NULL when the id has another shape."""
    seq = _col(seq)
    ok = seq.rlike(SEQ_PATTERN)

    def part(n):
        return F.when(ok, F.regexp_extract(seq, SEQ_PATTERN, n))

    return F.struct(
        part(1).cast("long").alias("store"),
        part(2).alias("register"),
        F.try_to_date(part(3)).alias("business_date"),
        part(4).cast("long").alias("tran_no"),
    )


def replace_seq_number(seq: Column | str, tran_no: Column | str) -> Column:
    """The same id with another number in its last part."""
    stem = F.regexp_replace(_col(seq), r"-[^-]*$", "")
    return F.concat(stem, F.format_string("-%06d", _col(tran_no).cast("long")))


def day_number(business_date: Column | str) -> Column:
    """DAY column: day of the year.  The hash behind it is not published; this is our choice."""
    return F.dayofyear(_col(business_date)).cast("long")


def surrogate(*parts: Column | str) -> Column:
    """Repeatable BIGINT key of a natural key; see ``surrogate_report`` for collisions."""
    return F.xxhash64(*[_col(p) for p in parts])


def record_key() -> Column:
    """SHA-256 of the whole record: equal only for byte-equal re-deliveries."""
    return F.sha2(F.to_json(F.struct(*RECORD_KEYS), {"ignoreNullFields": "false"}), 256)


def packed(key: Column | str) -> Column:
    """A text key as bytes, for rows on their way: 33 bytes for a SHA-256 in hex digits, other texts one byte longer."""
    key = _col(key)
    digest = F.unhex(key)
    is_digest = (F.length(key) == 64) & (F.lower(F.hex(digest)) == key)
    text = F.concat(F.lit(bytearray(b"\x00")), key.cast("binary"))
    return F.when(is_digest, F.concat(F.lit(bytearray(b"\x01")), digest)).otherwise(text)


def unpacked(key: Column | str) -> Column:
    """The text key that was ``packed``."""
    key = _col(key)
    rest = F.substring(key, 2, 2**31 - 1)
    return F.when(F.substring(key, 1, 1) == F.lit(bytearray(b"\x01")), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
