"""Checks on the raw text of a record.

A fixed-schema reader turns "key absent" and "key is null" into the same NULL,
and rounds money on the way in, so these look at the text itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from tillwarden.schemas import CHILDREN, HEAD_DDL, RECORD_KEYS, struct_of


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def section_keys(section: str) -> list[str]:
    """Keys one section must carry: '$' is the record, 'tran_head' the header."""
    if section == "$":
        return RECORD_KEYS
    return struct_of(HEAD_DDL if section == "tran_head" else CHILDREN[section][0]).fieldNames()


def _objects(raw: Column, section: str) -> Column:
    """The objects of a section as maps: one for the record or header, every element of an array."""
    if section == "$":
        return F.array(F.from_json(raw, "map<string,string>"))
    body = F.get_json_object(raw, f"$.{section}")
    if section == "tran_head":
        return F.when(body.isNotNull(), F.array(F.from_json(body, "map<string,string>")))
    return F.from_json(body, "array<map<string,string>>")


def present_keys(raw: Column | str, section: str = "$") -> Column:
    """Keys that every object of the section has; NULL when the section is absent or empty."""
    objects = _objects(_col(raw), section)
    keys = F.transform(objects, lambda m: F.map_keys(m))
    return F.aggregate(keys, F.get(keys, F.lit(0)), lambda a, b: F.array_intersect(a, b))


def absent_keys(raw: Column | str, section: str = "$") -> Column:
    """Keys that some object of the section lacks; NULL when the section itself is absent."""
    wanted = F.array(*[F.lit(k) for k in section_keys(section)])
    if section == "$":
        return F.array_except(wanted, F.json_object_keys(_col(raw)))  # names only, no values
    objects = _objects(_col(raw), section)
    lacking = F.transform(objects, lambda m: F.array_except(wanted, F.map_keys(m)))
    return F.array_distinct(F.flatten(lacking))


def null_keys(raw: Column | str, section: str = "$") -> Column:
    """Keys that are there with an explicit null in some object of the section."""
    objects = _objects(_col(raw), section)
    nulls = F.transform(objects, lambda m: F.map_keys(F.map_filter(m, lambda _, v: v.isNull())))
    return F.array_sort(F.array_distinct(F.flatten(nulls)))


def item_keys_ok(raw: Column | str) -> Column:
    """Every item has the key ``class`` (and not a renamed one)."""
    items = F.from_json(F.get_json_object(_col(raw), "$.tran_item"), "array<map<string,string>>")
    good = F.forall(
        items,
        lambda m: F.map_contains_key(m, "class") & ~F.map_contains_key(m, "class_"),
    )
    return F.coalesce(good, F.lit(True))


# money fields per section; the text of each must have at most four decimals
MONEY_FIELDS = {
    "tran_head": ["value", "rounded_amt", "rounded_off_amt"],
    "tran_item": ["unit_retail", "total_igtax_amt", "orig_unit_retail"],
    "tran_disc": ["unit_discount_amt"],
    "tran_tender": ["tender_amt", "orig_curr_amt"],
    "tran_tax": ["tax_amt"],
    "tran_igtax": ["total_igtax_amt"],
}


def _may_be_long(raw: Column) -> Column:
    """Whether a text can hold a number with more than four decimals at all.

    Such a number has a digit other than 0 behind the fourth decimal, or an exponent, or digits that are escaped or not
    ASCII.  Three plain patterns: put together as one alternation they took 28 times as long.
    """
    return (
        raw.rlike(r"\.[0-9]{4}[0-9]*[1-9]")
        | raw.rlike("[0-9.][eE][-+]?[0-9]")
        | raw.contains("\\u")
        | (F.octet_length(raw) != F.char_length(raw))
    )


def long_scale(raw: Column | str) -> Column:
    """TRUE when any money number of the record is written with more than four decimals.

    Numbers are compared as exact decimals, so ``1.50000`` and ``5E-4`` pass.  Only texts that look as if they held
    such a number are parsed.
    """
    raw = _col(raw)

    def too_long(text: Column) -> Column:
        exact = text.try_cast("decimal(38,18)")
        return F.coalesce(exact != exact.cast("decimal(24,4)"), F.lit(False))

    def any_too_long(rows: Column, names: list[str]) -> Column:
        hit = F.exists(rows, lambda m: reduce(lambda a, b: a | b, [too_long(F.element_at(m, n)) for n in names]))
        return F.coalesce(hit, F.lit(False))

    bad = F.lit(False)
    head = F.from_json(F.get_json_object(raw, "$.tran_head"), "map<string,string>")
    for name in MONEY_FIELDS["tran_head"]:
        bad = bad | too_long(F.element_at(head, name))
    for section in CHILDREN:
        rows = F.from_json(F.get_json_object(raw, f"$.{section}"), "array<map<string,string>>")
        bad = bad | any_too_long(rows, MONEY_FIELDS[section])
    return F.when(_may_be_long(raw), bad).otherwise(F.lit(False))
