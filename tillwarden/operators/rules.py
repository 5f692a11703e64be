"""Audit rules as Catalyst expressions over one row of facts per transaction.

``nested_facts`` takes the facts from the arrays of a nested record, without a
shuffle.  ``flat_facts`` takes the same facts from canonical tables, each child
summed before it is joined.  The same rules run on both.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, functions as F

from tillwarden import reference as ref
from tillwarden.functions import checks, keys as K, money as M
from tillwarden.functions.money import money
from tillwarden.operators.conform import with_keys
from tillwarden.schemas import CHILDREN

Get = Callable[[str], Column]


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def _bad_flags(*names: str) -> Callable[[Get], Column]:
    return lambda get: reduce(lambda a, b: a | b, [~checks.is_yn(get(n)) for n in names])


def _nothing(get: Get) -> Column:
    return F.lit(None)


@dataclass(frozen=True)
class LineTest:
    """A test on one child row, and what an error row shows of an offending one."""

    child: str
    test: Callable[[Get], Column]
    value: Callable[[Get], Column] = _nothing
    card: Callable[[Get], Column] = _nothing


# child -> columns that number its rows: KEY_VALUE_1 and KEY_VALUE_2 of an error
LINE_KEYS: dict[str, tuple[str, str | None]] = {
    "tran_item": ("item_seq_no", None),
    "tran_disc": ("item_seq_no", "discount_seq_no"),
    "tran_tender": ("tender_seq_no", None),
    "tran_tax": ("tax_seq_no", None),
    "tran_igtax": ("item_seq_no", "igtax_seq_no"),
}

LINE_TYPE = "array<struct<key_1: bigint, key_2: bigint, orig_value: string, orig_cc_no: string>>"


def _flag_test(child: str, *names: str) -> LineTest:
    """Indicators other than Y and N; the error shows them with their values."""

    def shown(get: Get) -> Column:
        marks = [
            F.when(~checks.is_yn(get(n)), F.concat(F.lit(f"{n}="), F.coalesce(get(n), F.lit("null")))) for n in names
        ]
        return F.concat_ws(",", *marks)

    return LineTest(child, _bad_flags(*names), shown)


# fact -> test.  The fact holds every offending row of the transaction, whether or not it has a number.
LINE_TESTS: dict[str, LineTest] = {
    "neg_items": LineTest(
        "tran_item",
        lambda get: (get("qty") < 0) & get("return_reason_code").isNull(),
        lambda get: get("qty"),
    ),
    "price_items": LineTest("tran_item", lambda get: ~_true(get("unit_retail") > 0), lambda get: get("unit_retail")),
    "ship_items": LineTest(
        "tran_item", lambda get: ~get("drop_ship_ind").eqNullSafe(F.lit("N")), lambda get: get("drop_ship_ind")
    ),
    "status_items": LineTest(
        "tran_item", lambda get: ~checks.in_code_list(get("item_status"), "SASI"), lambda get: get("item_status")
    ),
    "flag_items": _flag_test(
        "tran_item", "tax_ind", "item_swiped_ind", "error_ind", "drop_ship_ind", "unit_retail_vat_incl"
    ),
    "open_cards": LineTest(
        "tran_tender",
        lambda get: (get("tender_type_group") == "CARD") & ~checks.is_masked(get("cc_no")),
        card=lambda get: checks.mask_pan(get("cc_no")),
    ),
    "flag_tenders": _flag_test("tran_tender", "error_ind"),
    # the value is the line's currency: the rule keeps lines in the currency of the store
    "curr_tenders": LineTest(
        "tran_tender", lambda get: get("orig_curr_amt") != get("tender_amt"), lambda get: get("orig_currency")
    ),
    "noncash_tenders": LineTest("tran_tender", lambda get: ~get("tender_type_group").eqNullSafe(F.lit("CASH"))),
    "flag_discs": _flag_test("tran_disc", "error_ind"),
    "flag_taxes": _flag_test("tran_tax", "error_ind"),
    "flag_igtaxes": _flag_test("tran_igtax", "error_ind"),
}

COUNTS = {
    "n_items": "tran_item",
    "n_discs": "tran_disc",
    "n_tenders": "tran_tender",
    "n_taxes": "tran_tax",
    "n_igtaxes": "tran_igtax",
}

# fact -> (child, amount of one child row)
SUMS: dict[str, tuple[str, Callable[[Get], Column]]] = {
    "line_total": ("tran_item", lambda get: M.line_amount(get("qty"), get("unit_retail"))),
    "disc_total": ("tran_disc", lambda get: M.disc_amount(get("qty"), get("unit_discount_amt"))),
    "tender_total": ("tran_tender", lambda get: get("tender_amt")),
}


def nested_any(array: str, test: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.exists(array, test), F.lit(False))


def nested_all(array: str, test: Callable[[Column], Column]) -> Column:
    return F.coalesce(F.forall(array, test), F.lit(True))


def _array_sum(child: str, amount: Callable[[Get], Column]) -> Column:
    return M.array_total(child, lambda x: amount(lambda n: x[n]))


def _line(child: str, t: LineTest, get: Get) -> Column:
    first, second = LINE_KEYS[child]
    return F.struct(
        get(first).cast("long").alias("key_1"),
        (get(second) if second else F.lit(None)).cast("long").alias("key_2"),
        t.value(get).cast("string").alias("orig_value"),
        t.card(get).cast("string").alias("orig_cc_no"),
    )


def _no_lines() -> Column:
    return F.array().cast(LINE_TYPE)


def _nested_lines(t: LineTest) -> Column:
    """Offending rows of an array, in an order of their own, so that flat rows give the same."""
    hits = F.filter(t.child, lambda x: _true(t.test(lambda n: x[n])))
    lines = F.transform(hits, lambda x: _line(t.child, t, lambda n: x[n]))
    return F.coalesce(F.array_sort(lines), _no_lines())


@lru_cache(maxsize=4)
def _nested_fact_columns(app_id: str) -> tuple[Column, ...]:
    """Fact expressions over the arrays; built once per application."""
    facts = []
    for name, child in COUNTS.items():
        # size() of a NULL array is -1 or NULL depending on settings
        facts.append(F.when(F.col(child).isNull(), 0).otherwise(F.size(child)).cast("long").alias(name))
    for name, (child, amount) in SUMS.items():
        facts.append(M.round4(F.coalesce(_array_sum(child, amount), money(0))).alias(name))
    facts.extend(_nested_lines(t).alias(name) for name, t in LINE_TESTS.items())
    in_order = F.transform("tran_item", lambda x: x["item_seq_no"]).eqNullSafe(
        F.sequence(F.lit(1).cast("long"), F.size("tran_item").cast("long"))
    )
    facts.append(F.when(F.size("tran_item") > 0, in_order).otherwise(F.lit(True)).alias("items_in_order"))
    return tuple(facts)


def with_currency(facts: DataFrame, stores: DataFrame | None) -> DataFrame:
    """``local_currency`` of the store; without a registry, or for a store it does not have, the default one.

    The registry is small and its size is left to Catalyst's check.
    """
    default = F.lit(ref.DEFAULT_CURRENCY)
    if stores is None:
        return facts.withColumn("local_currency", default)
    # a store that is registered twice must not double its transactions
    known = stores.groupBy(F.col("store_no").alias("_s")).agg(F.min("local_currency").alias("_c"))
    joined = facts.join(known, F.col("store") == F.col("_s"), "left")
    return joined.withColumn("local_currency", F.coalesce("_c", default)).drop("_s", "_c")


def nested_facts(rtlog: DataFrame, stores: DataFrame | None = None) -> DataFrame:
    """One row of facts per nested record; no shuffle."""
    file_cols = {"store": "file_store", "date": "file_date", "hour": "file_hour"}
    files = [F.col(c).alias(a) for c, a in file_cols.items() if c in rtlog.columns]
    facts = with_keys(rtlog).select(
        "record_key",
        "day",
        "store_day_seq_no",
        "tran_seq_id",
        F.col("rtlog_orig_sys").alias("record_channel"),
        *files,
        "tran_head.*",
        *_nested_fact_columns(rtlog.sparkSession.sparkContext.applicationId),
    )
    return with_currency(facts, stores)


def flat_facts(
    head: DataFrame, child_rows: dict[str, DataFrame], keys: list[str], stores: DataFrame | None = None
) -> DataFrame:
    """The same facts from flat tables.

    Every child is aggregated on the transaction key (combining on the map
    side) and then joined one row to one row on that key.  Of the rows, only offending ones are kept one by one.
    """
    out = head
    if "record_channel" not in head.columns:
        out = out.withColumn("record_channel", F.col("rtlog_orig_sys"))
    for child, (_, numbering) in CHILDREN.items():
        counts = [n for n, c in COUNTS.items() if c == child]
        sums = [n for n, (c, _) in SUMS.items() if c == child]
        tests = {n: t for n, t in LINE_TESTS.items() if t.child == child}
        rows = child_rows.get(child)
        if rows is None:
            out = out.withColumns(
                {
                    **{n: F.lit(0).cast("long") for n in counts},
                    **{n: money(0) for n in sums},
                    **{n: _no_lines() for n in tests},
                    **({"items_in_order": F.lit(True)} if child == "tran_item" else {}),
                }
            )
            continue
        aggs = [F.count(F.lit(1)).alias(n) for n in counts]
        aggs += [M.round4(F.sum(SUMS[n][1](F.col))).alias(n) for n in sums]
        # collect_list leaves nulls out, so a row that passes costs nothing
        get = _column_or_null(rows)
        aggs += [F.array_sort(F.collect_list(F.when(t.test(get), _line(child, t, get)))).alias(n) for n, t in tests.items()]
        if child == "tran_item":
            # distinct numbers: a bit per number up to 62, which combines on the
            # map side, and a distinct count for the few numbers beyond
            seq = F.col("item_seq_no")
            small = seq.between(1, 62)
            aggs += [
                F.min(seq).alias("_lo"),
                F.max(seq).alias("_hi"),
                F.bit_or(F.when(small, F.expr("shiftleft(1L, cast(item_seq_no as int))"))).alias("_bits"),
                F.count_distinct(F.when(~small, seq)).alias("_beyond"),
            ]
        summed = rows.groupBy(*keys).agg(*aggs)
        out = out.join(summed, keys, "left").withColumns(
            {
                **{n: F.coalesce(n, F.lit(0)) for n in counts},
                **{n: F.coalesce(n, _no_lines()) for n in tests},
                **{n: F.coalesce(n, money(0)) for n in sums},
            }
        )
        if child == "tran_item":
            numbers = F.coalesce(F.bit_count("_bits"), F.lit(0)) + F.col("_beyond")
            ok = (F.col("_lo") == 1) & (F.col("_hi") == F.col("n_items")) & (numbers == F.col("n_items"))
            out = out.withColumn(
                "items_in_order", F.when(F.col("n_items") > 0, F.coalesce(ok, F.lit(False))).otherwise(True)
            ).drop("_lo", "_hi", "_bits", "_beyond")
    return with_currency(out, stores)


def _column_or_null(rows: DataFrame) -> Get:
    """Columns of a child; one that a table does not have is null."""
    have = set(rows.columns)
    return lambda n: F.col(n) if n in have else F.lit(None).cast("string")


@dataclass(frozen=True)
class Rule:
    """A row-local rule: users may pass their own.

    ``test`` is about the transaction and gives one error.  ``lines`` names facts of offending rows and gives one
    error for each row, with its numbers, if ``lines_when`` holds; ``line`` is a further test on such a row.
    """

    code: str
    test: Callable[[], Column] | None = None
    key_1: Callable[[], Column] = lambda: F.lit(None)
    orig_value: Callable[[], Column] = lambda: F.lit(None)
    orig_cc_no: Callable[[], Column] = lambda: F.lit(None)
    needs: tuple[str, ...] = ()  # facts that must be there for the rule to apply
    lines: tuple[str, ...] = ()
    lines_when: Callable[[], Column] | None = None
    line: Callable[[Column], Column] | None = None

    def offending(self, fact: str) -> Column:
        rows = F.col(fact) if self.line is None else F.filter(fact, self.line)
        return rows if self.lines_when is None else F.when(self.lines_when(), rows)

    def holds(self) -> Column:
        """Whether the rule reports anything of a transaction."""
        found = [F.size(self.offending(fact)) > 0 for fact in self.lines]
        if self.test is not None:
            found.append(self.test())
        return reduce(lambda a, b: a | b, [_true(f) for f in found])


def _rows(fact: str) -> Column:
    return F.size(fact) > 0


def _type(*types: str) -> Column:
    return F.col("tran_type").isin(*types)


def _value_text() -> Column:
    return F.col("value").cast("string")


def _off_by(total: Column) -> Column:
    """A header without a value agrees with no total."""
    return F.col("value").isNull() | (F.abs(total - F.col("value")) > money(ref.TENDER_TOLERANCE))


def void_out_of_hours(opening: int = ref.OPENING_HOUR, closing: int = ref.CLOSING_HOUR) -> Column:
    hour = K.wall_hour("tran_datetime")
    return _type("PVOID") & ((hour < opening) | (hour >= closing))


def missing_tender(strict: bool = False) -> Column:
    none = F.col("n_tenders") == 0
    # a sale with items but no value at all is not known to be free
    unpaid = F.coalesce(F.col("value") > 0, _type("SALE") & (F.col("n_items") > 0))
    return none if strict else none & unpaid


def seq_format_bad() -> Column:
    expected = K.build_tran_seq_no("store", "register", "business_date", "tran_no")
    return ~F.col("tran_seq_no").eqNullSafe(expected)


def _partition_bad() -> Column:
    return (
        ~F.col("file_store").eqNullSafe(F.col("store"))
        | ~F.col("file_date").eqNullSafe(F.col("business_date"))
        | ~F.lpad(F.col("file_hour").cast("string"), 2, "0").eqNullSafe(K.wall_hour_text("tran_datetime"))
    )


def _paid_shape_bad() -> Column:
    good = (
        (F.col("n_tenders") == 1)
        & ~_rows("noncash_tenders")
        & (F.col("tender_total") == F.col("value"))
        & (F.col("pos_tran_ind") == "N")
        & F.col("vendor_no").isNotNull()
        & (F.col("n_items") == 0)
    )
    return _type("PAIDIN", "PAIDOUT") & ~F.coalesce(good, F.lit(False))


def _head_flags() -> Column:
    marks = [
        F.when(~checks.is_yn(n), F.concat(F.lit(f"{n}="), F.coalesce(n, F.lit("null"))))
        for n in ("error_ind", "pos_tran_ind")
    ]
    return F.concat_ws(",", *marks)


def tax_mode_mix(mode: str | None = None) -> Column:
    """Wrong kind of tax for a mode; without a mode, both kinds in one record."""
    if mode == "IGTAX":
        return F.col("n_taxes") > 0
    if mode == "TAX":
        return F.col("n_igtaxes") > 0
    return (F.col("n_taxes") > 0) & (F.col("n_igtaxes") > 0)


ROW_RULES: list[Rule] = [
    Rule("MISSING_TENDER", missing_tender, orig_value=_value_text),
    Rule(
        "TENDER_VAR_GT_01",
        lambda: (F.col("n_tenders") > 0) & _off_by(F.col("tender_total")),
        orig_value=lambda: F.col("tender_total").cast("string"),
    ),
    Rule("VOID_OOH", void_out_of_hours, orig_value=lambda: F.substring("tran_datetime", 12, 8)),
    Rule("NEG_QTY_NO_REF", lines=("neg_items",), lines_when=lambda: _type("SALE")),
    Rule("CC_NOT_MASKED", lines=("open_cards",)),
    Rule(
        "CHANNEL_INVALID",
        lambda: ~F.col("record_channel").eqNullSafe(F.col("rtlog_orig_sys"))
        | ~checks.in_channels("record_channel"),
        orig_value=lambda: F.col("record_channel"),
    ),
    Rule("PARTITION_MISMATCH", _partition_bad, needs=("file_store", "file_date", "file_hour")),
    Rule(
        "CODE_INVALID",
        lambda: ~checks.in_code_list("tran_type", "TRAT")
        | ~F.coalesce(F.col("status").isin(ref.HEAD_STATUSES), F.lit(False)),
        orig_value=lambda: F.concat_ws("/", "tran_type", "status"),
        lines=("status_items",),
    ),
    Rule(
        "IND_INVALID",
        lambda: ~checks.is_yn("error_ind") | ~checks.is_yn("pos_tran_ind"),
        orig_value=_head_flags,
        lines=("flag_items", "flag_discs", "flag_tenders", "flag_taxes", "flag_igtaxes"),
    ),
    Rule("SALE_NO_ITEM", lambda: _type("SALE") & (F.col("n_items") == 0)),
    Rule("ITEM_SEQ_GAP", lambda: ~F.col("items_in_order")),
    Rule("RETAIL_NOT_POSITIVE", lines=("price_items",)),
    Rule("POS_DROP_SHIP", lines=("ship_items",), lines_when=lambda: F.col("rtlog_orig_sys") == "POS"),
    Rule("TAX_MODE_MIX", tax_mode_mix),
    Rule(
        "VALUE_MISMATCH",
        lambda: _type("SALE", "RETURN", "PVOID") & _off_by(M.net_value("line_total", "disc_total")),
        orig_value=_value_text,
    ),
    Rule("PAIDIO_SHAPE", _paid_shape_bad),
    Rule("SEQ_FORMAT", seq_format_bad, orig_value=lambda: F.col("tran_seq_no")),
    Rule(
        "BANNER_INVALID",
        lambda: ~F.col("banner_no").eqNullSafe(F.lit(ref.DEFAULT_BANNER).cast("long")),
        orig_value=lambda: F.col("banner_no").cast("string"),
    ),
    Rule(
        "CURR_AMT_MISMATCH",
        lines=("curr_tenders",),
        line=lambda x: x["orig_value"].isNull() | (x["orig_value"] == F.col("local_currency")),
    ),
]

RULES = {r.code: r for r in ROW_RULES}

ERROR_KEYS = ["record_key", "store", "business_date", "tran_seq_no", "rtlog_orig_sys"]


def _hit_struct(rule: Rule, key_1: Column, key_2: Column, value: Column, card: Column, section: str | None, line: Column) -> Column:
    return F.struct(
        F.lit(rule.code).alias("error_code"),
        key_1.cast("long").alias("key_value_1"),
        key_2.cast("long").alias("key_value_2"),
        value.cast("string").alias("orig_value"),
        card.cast("string").alias("orig_cc_no"),
        F.lit(section).cast("string").alias("section"),
        line.cast("int").alias("line"),
    )


def _rule_hits(rule: Rule) -> list[Column]:
    """Arrays of hits of one rule: that of the transaction, and those of its rows."""
    null = F.lit(None)
    found = []
    if rule.test is not None:
        whole = _hit_struct(rule, rule.key_1(), null, rule.orig_value(), rule.orig_cc_no(), None, null)
        found.append(F.when(rule.test(), F.array(whole)))
    return found + [_line_hits(rule, fact) for fact in rule.lines]


def _line_hits(rule: Rule, fact: str) -> Column:
    section = LINE_TESTS[fact].child
    return F.transform(
        rule.offending(fact),
        lambda x, i: _hit_struct(rule, x["key_1"], x["key_2"], x["orig_value"], x["orig_cc_no"], section, i + 1),
    )


@lru_cache(maxsize=64)
def _hits(app_id: str, rules: tuple[Rule, ...]) -> Column:
    parts = [part for rule in rules for part in _rule_hits(rule)]
    return F.inline(F.flatten(F.array_compact(F.array(*parts))))


def run_rules(
    facts: DataFrame, rules: list[Rule] | None = None, carry: list[str] | None = None
) -> DataFrame:
    """All row-local rules in one pass: the arrays of hits of a row put together and exploded once.

    A hit on a child row names the child (``section``) and which of its offending rows it is (``line``), so
    that rows without a number, or with a repeated one, stay apart.
    """
    have = set(facts.columns)
    active = tuple(r for r in (rules or ROW_RULES) if set(r.needs) <= have)
    keep = carry or [k for k in ERROR_KEYS if k in have]
    return facts.select(*keep, _hits(facts.sparkSession.sparkContext.applicationId, active))


def any_fault(rules: list[Rule] | None = None) -> Column:
    """TRUE for a record that any of the rules reports."""
    return reduce(
        lambda a, b: a | b, [r.holds() for r in rules or ROW_RULES]
    )
